"""Typed decode per target, error paths, defaults, encode and the JSON bridge."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recordlake.functions import values
from recordlake.functions.links import link_text, parse_link
from recordlake.functions.names import STYLES, field_name, variant_value
from recordlake.model import Custom, DecimalOf, FieldSpec, ListOf, MapOf, Newtype, RecordSpec, Scalar, SetOf
from recordlake.operators import codec
from recordlake.sources.tables import read_records


def records(spark, *bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body string").coalesce(1)
    return read_records(df, "body", F.col("id").cast("string"), "t")


def read_one(spark, body, target, **options):
    """('ok', value) or ('bad', path, code, expected, actual) of field ``v``."""
    spec = RecordSpec("r", (FieldSpec("v", target, **options),))
    row = codec.decode_columns(records(spark, body), spec).first()
    if row["errors"]:
        e = row["errors"][0]
        return ("bad", e["path"], e["code"], e["expected"], e["actual"])
    return ("ok", row["v"])


CASES = [
    ('{"v": "x"}', Scalar("string"), ("ok", "x")),
    ('{"v": 5}', Scalar("string"), ("bad", "v", "type_mismatch", "string", "int32")),
    ('{"v": "5"}', Scalar("i32"), ("bad", "v", "type_mismatch", "i32", "string")),
    ('{"v": "é"}', Scalar("char"), ("ok", "é")),
    ('{"v": "ab"}', Scalar("char"), ("bad", "v", "type_mismatch", "single-char string", "string")),
    ('{"v": true}', Scalar("bool"), ("ok", True)),
    ('{"v": 1}', Scalar("bool"), ("bad", "v", "type_mismatch", "bool", "int32")),
    ('{"v": 127}', Scalar("i8"), ("ok", 127)),
    ('{"v": 128}', Scalar("i8"), ("bad", "v", "type_mismatch", "i8", "int32")),
    ('{"v": -1}', Scalar("u32"), ("bad", "v", "type_mismatch", "u32", "int32")),
    ('{"v": 4294967295}', Scalar("u32"), ("ok", 4294967295)),
    ('{"v": 3000000000}', Scalar("i32"), ("bad", "v", "type_mismatch", "i32", "int64")),
    ('{"v": 1.5}', Scalar("i64"), ("bad", "v", "type_mismatch", "i64", "double")),
    ('{"v": 7}', Scalar("f64"), ("ok", 7.0)),
    ('{"v": 1.25}', Scalar("f32"), ("ok", 1.25)),
    ('{"v": "1.5"}', Scalar("f64"), ("bad", "v", "type_mismatch", "f64", "string")),
    ('{"v": "2024-01-02T03:04:05+02:00"}', Scalar("datetime"), ("ok", dt.datetime(2024, 1, 2, 1, 4, 5))),
    ('{"v": "2024-01-02"}', Scalar("datetime"), ("bad", "v", "conversion", None, None)),
    ('{"v": "2024-01-02T03:04:05Z"}', Scalar("date"), ("bad", "v", "type_mismatch", "date", "string")),
    ('{"v": [1, 255]}', Scalar("bytes"), ("ok", bytearray(b"\x01\xff"))),
    ('{"v": [1, 256]}', Scalar("bytes"), ("bad", "v", "type_mismatch", "u8", "list item")),
    ('{"v": []}', Scalar("bytes"), ("ok", bytearray(b""))),
    ('{"v": "#3:9"}', Scalar("link"), ("ok", (3, 9))),
    ('{"v": "3:9"}', Scalar("link"), ("bad", "v", "conversion", None, None)),
    ('{"v": "#3000000000:9"}', Scalar("link"), ("bad", "v", "conversion", None, None)),
    ('{"v": 12.34}', DecimalOf(2), ("ok", Decimal("12.34"))),
    ('{"v": 12.345}', DecimalOf(2), ("bad", "v", "conversion", None, None)),
    ('{"v": 5}', DecimalOf(2), ("bad", "v", "type_mismatch", "decimal", "int32")),
    ('{"v": 5000000000}', DecimalOf(0), ("ok", Decimal("5000000000"))),
    ('{"v": [1, 2]}', ListOf(Scalar("i8")), ("ok", [1, 2])),
    ('{"v": [1, 200, "x"]}', ListOf(Scalar("i8")), ("bad", "v.list[1]", "type_mismatch", "i8", "int32")),
    ('{"v": [1, "x"]}', ListOf(Scalar("i8")), ("bad", "v.list[1]", "type_mismatch", "i8", "string")),
    ('{"v": [1, 2.5]}', ListOf(Scalar("f64")), ("ok", [1.0, 2.5])),
    ('{"v": []}', ListOf(Scalar("i8")), ("ok", [])),
    ('{"v": {"a": 1}}', ListOf(Scalar("i8")), ("bad", "v", "type_mismatch", "list", "map")),
    ('{"v": [2, 1, 2]}', SetOf(Scalar("i64")), ("ok", [2, 1])),
    ('{"v": [2, "a"]}', SetOf(Scalar("i64")), ("bad", "v.set[1]", "type_mismatch", "i64", "string")),
    ('{"v": {"a": 1}}', MapOf(Scalar("i64")), ("ok", {"a": 1})),
    ('{"v": {"a": 1, "b": "x"}}', MapOf(Scalar("i64")), ("bad", "v.map[b]", "type_mismatch", "i64", "string")),
    ('{"v": {"a": [1, null]}}', MapOf(ListOf(Scalar("i64"))), ("bad", "v.map[a].list[1]", "type_mismatch", "i64", "null")),
    ('{"v": 4}', Newtype(Newtype(Scalar("u8"))), ("ok", 4)),
    ('{"v": "on"}', Custom(lambda v: F.when(F.try_variant_get(v, "$", "string") == "on", F.lit(True)), "boolean"), ("ok", True)),
    ('{"v": "off"}', Custom(lambda v: F.when(F.try_variant_get(v, "$", "string") == "on", F.lit(True)), "boolean"), ("bad", "v", "conversion", None, None)),
    ("{}", Scalar("i64"), ("bad", "v", "missing_field", None, None)),
    ('{"v": null}', Scalar("i64"), ("bad", "v", "type_mismatch", "i64", "null")),
    ("not json", Scalar("i64"), ("bad", "v", "missing_field", None, None)),
]


@pytest.mark.parametrize("body,target,want", CASES, ids=[f"{i}-{c[0]}" for i, c in enumerate(CASES)])
def test_targets(spark, body, target, want):
    got = read_one(spark, body, target)
    if got[0] == "ok" and isinstance(got[1], tuple):
        got = ("ok", tuple(got[1]))
    assert got == want


def test_optional_and_default(spark):
    assert read_one(spark, "{}", Scalar("i8"), optional=True) == ("ok", None)
    assert read_one(spark, '{"v": null}', Scalar("i8"), optional=True) == ("ok", None)
    assert read_one(spark, '{"v": 300}', Scalar("i8"), optional=True)[0] == "bad"
    assert read_one(spark, "{}", Scalar("i8"), default=9) == ("ok", 9)
    # An explicit null is not absent.
    assert read_one(spark, '{"v": null}', Scalar("i8"), default=9) == ("bad", "v", "type_mismatch", "i8", "null")


def test_article(spark):
    """A record with nested lists of records, a flattened part and its own rid."""
    section = RecordSpec("section", (FieldSpec("ref", Scalar("link")), FieldSpec("hint", optional=True)))
    base = RecordSpec("base", (FieldSpec("title"), FieldSpec("sections", ListOf(section)), FieldSpec("tags", ListOf(Scalar("string")), default=F.array())))
    spec = RecordSpec("scored", (FieldSpec("score", Scalar("f64")), FieldSpec("article", base, flatten=True), FieldSpec("rid", read_as="@rid", optional=True)))
    good = '{"title": "t", "score": 1, "sections": [{"ref": "#1:2"}, {"ref": "#1:3", "hint": "h"}]}'
    bad = '{"title": "t", "score": 1, "sections": [{"ref": "#1:2"}, {"ref": "x"}], "@rid": "#9:9"}'
    ok, wrong = codec.decode(records(spark, good, bad), spec)
    row = ok.first()
    assert row["rid"] == "0" and row["score"] == 1.0 and row["tags"] == []
    assert [(s["ref"]["pos"], s["hint"]) for s in row["sections"]] == [(2, None), (3, "h")]
    assert [(r["path"], r["code"]) for r in wrong.collect()] == [("sections.list[1].ref", "conversion")]


def test_failfast(spark):
    spec = RecordSpec("r", (FieldSpec("v", Scalar("i8")),))
    assert codec.decode(records(spark, '{"v": 1}'), spec, "failfast").count() == 1
    with pytest.raises(Exception, match="type_mismatch"):
        codec.decode(records(spark, '{"v": 1}', '{"v": "x"}'), spec, "failfast").collect()


def test_every_kind_round_trips(spark):
    row = spark.createDataFrame(
        [(1, 2, 3, 4, 1.5, 2.5, "s", True, bytearray(b"ab"), dt.datetime(2024, 1, 2, 3, 4, 5), [1, 2], {"a": 1.5}, Decimal("1.25"), None)],
        "a tinyint, b smallint, c int, d bigint, e float, f double, g string, h boolean, i binary, j timestamp, k array<bigint>, l map<string,double>, m decimal(10,2), n string")
    spec = RecordSpec("r", tuple(FieldSpec(n, t, optional=True) for n, t in {
        "a": Scalar("i8"), "b": Scalar("i16"), "c": Scalar("i32"), "d": Scalar("i64"), "e": Scalar("f32"), "f": Scalar("f64"), "g": Scalar("string"),
        "h": Scalar("bool"), "i": Scalar("bytes"), "j": Scalar("datetime"), "k": ListOf(Scalar("i64")), "l": MapOf(Scalar("f64")), "m": DecimalOf(2), "n": Scalar("string")}.items()))
    packed = codec.encode(row, spec)
    assert packed.select(F.size("properties").alias("n")).first()["n"] == 13  # the null is left out
    back = codec.decode(packed, spec, json_source=False)[0].drop("rid", "type").first()
    assert back == row.first()


def test_text_of_other_kinds(spark):
    row = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), Decimal("-0.05"))], "j timestamp, m decimal(10,2)")
    write = RecordSpec("r", (FieldSpec("j"), FieldSpec("m")))
    read = RecordSpec("r", (FieldSpec("j"), FieldSpec("m")))
    got = codec.decode(codec.encode(row, write), read, json_source=False)[0].first()
    assert (got["j"], got["m"]) == ("2024-01-02T03:04:05+00:00", "-5e-2")


def test_record_json_metadata_wins(spark):
    recs = records(spark, '{"@rid": "x", "n": 1}')
    assert codec.record_json(recs).first()["json"] in ('{"n":1,"@rid":"0","@type":"t"}', '{"@rid":"0","@type":"t","n":1}')


def test_links(spark):
    df = spark.createDataFrame([("#1:2",), ("#-1:2",), ("1:2",), ("#1:2:3",), ("#1:9223372036854775808",), ("# 1:2",), ("##1:2",), (None,)], "t string")
    assert [r[0] for r in df.select(link_text(parse_link(F.col("t")))).collect()] == ["#1:2"] + [None] * 7


def test_durations(spark):
    cases = {"90 DAYS": 90 * 86_400_000, "1 hours": 3_600_000, "30 Minute": 1_800_000, "5 SECOND": 5000, "5 WEEKS": None, "x DAYS": None, "5": None}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert {r["t"]: r["ms"] for r in df.select("t", values.duration_ms(F.col("t")).alias("ms")).collect()} == cases
    assert {c: values.duration_ms_of(c) for c in cases} == cases


def test_case_styles(spark):
    assert [field_name("user_id_2", s) for s in STYLES] == [
        "user_id_2", "USER_ID_2", "UserId2", "userId2", "user_id_2", "USER_ID_2", "user-id-2", "USER-ID-2"]
    row = spark.createDataFrame([("XMLFeed",)], "v string").select(*[variant_value(F.col("v"), s).alias(f"c{i}") for i, s in enumerate(STYLES)]).first()
    assert list(row) == ["xmlfeed", "XMLFEED", "XMLFeed", "xMLFeed", "x_m_l_feed", "X_M_L_FEED", "x-m-l-feed", "X-M-L-FEED"]
    with pytest.raises(ValueError):
        field_name("x", "Title Case")
