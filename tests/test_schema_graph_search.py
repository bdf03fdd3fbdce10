"""Schema comparison rules, constraint checks, graph jobs, series and search."""

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.model import (
    Constraints, FieldSpec, Index, ListOf, Property, RecordSpec, Scalar, TimeseriesSpec, TypeSet, TypeSpec)
from recordlake.operators import catalog, graph, quality, search, timeseries
from recordlake.sources import tables


def prop(name="p", type_name="STRING", **constraints):
    return Property(name, type_name, Constraints(**constraints))


def actions(spark, desired, actual, **options):
    frame = catalog.schema_diff(catalog.spec_columns(spark, desired), catalog.spec_columns(spark, actual), **options)
    return sorted((r["action"], r["type"], r["property"], r["detail"], r["value"]) for r in frame.collect())


def one(*props, **options):
    return [TypeSpec("t", properties=tuple(props), **options)]


def test_no_difference(spark):
    same = one(prop(mandatory=True, min="1", default="'x'"))
    assert actions(spark, same, same) == []


def test_bounds_are_set_but_never_unset(spark):
    assert actions(spark, one(prop(min="2")), one(prop(min="1", max="9", regexp="a"))) == [("alter_constraint", "t", "p", "min", "2")]


def test_flags_go_both_ways(spark):
    got = actions(spark, one(prop(mandatory=True)), one(prop(readonly=True)))
    assert got == [("alter_constraint", "t", "p", "mandatory", "true"), ("alter_constraint", "t", "p", "readonly", "false")]


def test_drops_and_renames_are_never_inferred(spark):
    assert actions(spark, one(prop("new")), one(prop("old"))) == [("create_property", "t", "new", "STRING", None)]
    assert actions(spark, one(prop()), one(prop()) + [TypeSpec("gone")]) == []
    assert actions(spark, one(prop()), one(prop()) + [TypeSpec("gone"), TypeSpec("kept")], drops=True, ignored=["kept"]) == [
        ("drop_type", "gone", None, "DOCUMENT", None)]


def snapshot(spark, source, resolved):
    return spark.createDataFrame([("t", "p", source, resolved)], "type string, property string, source_text string, resolved_text string")


def test_default_rules(spark):
    alter = [("alter_default", "t", "p", None, "42")]
    assert actions(spark, one(prop(default="42")), one(prop())) == alter
    assert actions(spark, one(prop()), one(prop(default="42"))) == [("alter_default", "t", "p", None, None)]
    # Both present: without a record of what was applied the stored one stays.
    assert actions(spark, one(prop(default="42")), one(prop(default="99"))) == []
    assert actions(spark, one(prop(default="42")), one(prop(default="99")), snapshot=snapshot(spark, "42", "42")) == alter
    assert actions(spark, one(prop(default="42")), one(prop(default="42")), snapshot=snapshot(spark, "42", "42")) == []
    # An expression compares by its source text only.
    now = one(prop(default="date()"))
    assert actions(spark, now, one(prop(default="date(1)")), snapshot=snapshot(spark, "date()", "x")) == []
    assert len(actions(spark, now, one(prop(default="date()")), snapshot=snapshot(spark, "date(2)", "x"))) == 1


def test_retype_and_kind_drift_are_reported(spark):
    assert actions(spark, one(prop(type_name="LONG")), one(prop())) == [("alter_type", "t", "p", "STRING", "LONG")]
    assert actions(spark, one(prop(), kind="VERTEX"), one(prop())) == [("kind_drift", "t", None, "DOCUMENT", "VERTEX")]


def test_series_types_are_left_alone(spark):
    got = actions(spark, one(prop("a"), kind="TIMESERIES"), one(prop("b"), kind="TIMESERIES"))
    assert got == []


def test_index_identity(spark):
    desired = [TypeSpec("t", properties=(prop(),), indexes=(Index(("a",), "UNIQUE", "i1"), Index(("b",), "UNIQUE"), Index(("c",), "UNIQUE", "i3"), Index(("d",), "NOTUNIQUE")))]
    actual = [TypeSpec("t", properties=(prop(),), indexes=(Index(("z",), "NOTUNIQUE", "i1"), Index(("b",), "UNIQUE", "auto"), Index(("c",), "UNIQUE"), Index(("d",), "UNIQUE")))]
    got = actions(spark, desired, actual, desired_indexes=catalog.spec_indexes(spark, desired), actual_indexes=catalog.spec_indexes(spark, actual))
    assert got == [("create_index", "t", "d", "NOTUNIQUE", None)]


def test_supers(spark):
    desired, actual = one(prop(), extends=("a", "b")), one(prop(), extends=("b", "c"))
    got = actions(spark, desired, actual, desired_types=catalog.spec_types(spark, desired), actual_types=catalog.spec_types(spark, actual))
    assert got == [("alter_supers", "t", None, "-c", "+a")]


def test_checksum(spark):
    specs = [TypeSpec("a", properties=(prop("x"), prop("y", min="1"))), TypeSpec("b", properties=(prop("z"),))]

    def checksum(s):
        return catalog.schema_checksum(catalog.spec_columns(spark, s)).first()["checksum"]

    assert checksum(specs) == checksum(specs[::-1])
    assert checksum(specs) != checksum([specs[1], TypeSpec("a", properties=(prop("x"), prop("y", min="2")))])


def test_catalog_from_tables(spark):
    table = spark.createDataFrame([(1, "a", [1.5])], "id bigint, s string, l array<double>")
    frame, warnings = catalog.catalog_columns(spark, {"t": table, "V": table, "odd": table}, {"odd": "QUEUE"})
    assert sorted((r["type"], r["property"], r["type_name"]) for r in frame.collect()) == [
        ("t", "id", "LONG"), ("t", "l", "LIST OF DOUBLE"), ("t", "s", "STRING")]
    assert warnings == ["type odd has unknown kind QUEUE; skipped"]


@pytest.mark.parametrize("expected,actual,ok", [
    ("LONG", "BYTE", True), ("FLOAT", "INTEGER", True), ("INTEGER", "DOUBLE", False), ("DATETIME", "STRING", True), ("STRING", "DATE", True),
    ("STRING", "LONG", False), ("LINK", "STRING", True), ("LIST OF DOUBLE", "ARRAY_OF_INTEGERS", True), ("LIST OF INTEGER", "ARRAY_OF_FLOATS", False),
    ("SET OF STRING", "LIST OF STRING", True), ("LIST OF STRING", "STRING", False), ("MAP", "EMBEDDEDMAP", True), ("GEOMETRY", "LONG", True),
    ("LIST OF LIST OF LONG", "STRING", True), ("BOOLEAN", "INTEGER", False)])
def test_type_compatibility(spark, expected, actual, ok):
    assert spark.range(1).select(quality.reads_as(F.lit(expected), F.lit(actual)).alias("ok")).first()["ok"] is ok


def test_observed_kinds_mix(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 1, "c": null}',), ('{"a": 2.5, "b": "x"}',), ('{"a": 3000000000}',)], "j string")
    got = {r["property"]: (r["type_name"], r["mandatory"], r["not_null"]) for r in catalog.observed_columns(tables.read_records(df, "j", type_name="t")).collect()}
    assert got == {"a": ("DOUBLE", True, True), "b": ("UNKNOWN", False, True), "c": ("UNKNOWN", False, False)}


def test_constraint_kinds(spark):
    df = spark.createDataFrame([(1, "abc", 5, [1, 2]), (2, "abcd", None, []), (3, None, 50, None)], "id int, s string, n int, l array<int>")
    spec = TypeSpec("t", properties=(prop("s", max="3", regexp="ab"), prop("n", not_null=True, max="10"), prop("l", min="1"), prop("gone", mandatory=True)))
    got = sorted((r["id"], r["property"], r["rule"]) for r in quality.check_constraints(df, spec, ["id"]).collect())
    assert got == [(1, "gone", "mandatory"), (1, "s", "regexp"), (2, "gone", "mandatory"), (2, "l", "min"), (2, "n", "notnull"),
                   (2, "s", "max"), (2, "s", "regexp"), (3, "gone", "mandatory"), (3, "n", "max")]


def test_defaults_leave_explicit_nulls(spark):
    df = tables.read_records(spark.createDataFrame([(1, "{}"), (2, '{"p": null}'), (3, '{"p": "x"}')], "id int, j string"), "j", F.col("id").cast("string"))
    out = quality.apply_defaults(df, TypeSpec("t", properties=(prop(default="'d'"),)), props="properties")
    assert {r["rid"]: r["v"] for r in out.select("rid", F.to_json(F.col("properties")["p"]).alias("v")).collect()} == {"1": '"d"', "2": "null", "3": '"x"'}


def test_type_closure():
    types = TypeSet().add(TypeSpec("a")).add(TypeSpec("b", extends=("a",))).add(TypeSpec("c", extends=("b",))).add(TypeSpec("d"))
    assert types.closure("a") == ["a", "b", "c"]
    with pytest.raises(KeyError):
        types.closure("x")


def test_bucket_scan_is_pruned(spark, tmp_path):
    tables.write_buckets(spark.range(1000), str(tmp_path / "b"), ["id"], 4)
    stored = spark.read.parquet(str(tmp_path / "b"))
    one_bucket = tables.scan_bucket(stored, 2)
    assert "PartitionFilters: [isnotnull(_bucket" in one_bucket._jdf.queryExecution().toString()
    assert sum(tables.scan_bucket(stored, b).count() for b in range(4)) == 1000


def test_bound_query(spark):
    df = spark.range(10)
    got = tables.query_bound(spark, "SELECT id FROM {t} WHERE id > :low AND array_contains(:ids, id)", {"low": 3, "ids": F.array(F.lit(2), F.lit(4), F.lit(8))}, limit=5, t=df)
    assert sorted(r["id"] for r in got.collect()) == [4, 8]


# ---- graph ----------------------------------------------------------------------------------

GRAPH = "seq bigint, kind string, type string, temp_id string, from_ref string, to_ref string"


def test_graph_load_failures(spark):
    rows = [(1, "vertex", "v", "a", None, None), (2, "vertex", "v", "b", None, None), (3, "vertex", "v", "a", None, None), (4, "vertex", "v", None, None, None),
            (5, "edge", "e", None, "a", "b"), (6, "edge", "e", None, "a", "nope"), (7, "edge", "e", None, "#9:9", "b")]
    loaded = graph.graph_load(spark.createDataFrame(rows, GRAPH), spark.createDataFrame([("#9:9",)], "rid string"))
    got = {r["seq"]: (r["action"], r["code"]) for r in loaded.outcome.collect()}
    assert got == {1: ("created", None), 2: ("created", None), 3: ("failed", "duplicate_temp_id"), 4: ("created", None), 5: ("created", None),
                   6: ("failed", "unresolved_ref"), 7: ("created", None)}
    assert loaded.vertices.select("rid").distinct().count() == 3 and loaded.id_map.count() == 2
    with pytest.raises(ValueError):
        graph.graph_load(spark.createDataFrame([rows[4], (9, "vertex", "v", "c", None, None)], GRAPH))


def test_edge_without_properties_is_a_no_op(spark):
    base = spark.createDataFrame([("a", "b", 1)], "out string, in string, w int")
    inc = spark.createDataFrame([(0, "a", "b", None), (1, "b", "a", None)], "row_index int, out string, in string, w int")
    assert sorted(map(tuple, graph.upsert_edges(base, inc).snapshot.collect()), key=repr) == [("a", "b", 1), ("b", "a", None)]
    bare = graph.upsert_edges(base, inc.drop("w"))
    assert sorted(map(tuple, bare.snapshot.collect()), key=repr) == [("a", "b", 1), ("b", "a", None)]


def test_create_edges_refuses_two_large_sides(spark):
    a, b = spark.range(30).withColumnRenamed("id", "rid"), spark.range(40).withColumnRenamed("id", "rid")
    with pytest.raises(ValueError):
        graph.create_edges(a, b, limit=20)
    assert graph.create_edges(a, b, limit=30).count() == 1200


@pytest.mark.parametrize("large", [False, True])
def test_traverse_equals_brute_force(spark, monkeypatch, large):
    rnd = random.Random(3)
    pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(90)] + [(0, i) for i in range(1, 15)]
    if large:
        monkeypatch.setattr(graph, "MAX_BROADCAST_FRONTIER", 0)
    got = {r["rid"]: r["depth"] for r in graph.traverse(spark.createDataFrame([(0,)], "rid bigint"), spark.createDataFrame(pairs, "out bigint, in bigint"), 4).collect()}
    want, frontier = {0: 0}, {0}
    for depth in range(1, 5):
        frontier = {b for a, b in pairs if a in frontier} - set(want)
        want.update(dict.fromkeys(frontier, depth))
    assert got == want


def test_expand_list(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"]), (3, [])], "id int, refs array<string>")
    target = spark.createDataFrame([("a", 10), ("b", 20)], "rid string, v int")
    assert sorted((r["id"], r["refs"], r["v"]) for r in graph.expand(df, "refs", target).collect()) == [(1, "a", 10), (1, "b", 20)]


# ---- series and search ----------------------------------------------------------------------


def test_compact_keeps_rows_and_sorts(spark):
    spec = TimeseriesSpec("ts", ("tag",), ("v",), compaction="1 HOURS")
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), "hot" if i % 3 else f"t{i}", float(i)) for i in range(300)]
    out = timeseries.ts_compact(spark.createDataFrame(rows, "ts timestamp, tag string, v double"), spec)
    assert sorted(r["v"] for r in out.collect()) == [float(i) for i in range(300)]
    parts = out.withColumn("p", F.spark_partition_id()).collect()
    for _, group in itertools.groupby(parts, key=lambda r: r["p"]):
        keys = [(r["compacted"], r["tag"], r["ts"]) for r in group]
        assert keys == sorted(keys)


def test_downsample_before_epoch(spark):
    row = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 30),)], "ts timestamp").select(timeseries.interval_start(F.col("ts"), "1 HOURS").alias("w")).first()
    assert row["w"] == dt.datetime(1969, 12, 31, 23)


def test_bm25(spark):
    docs = {1: "the cat sat", 2: "the dog", 3: "cat cat CAT!", 4: "", 5: "none of it here at all"}
    got = [(r["doc_id"], r["score"], r["rank"]) for r in search.full_text(spark.createDataFrame(list(docs.items()), "doc_id int, text string"), ["cat", "The"], 10).collect()]
    words = {i: t.lower().replace("!", "").split() for i, t in docs.items()}
    mean = sum(map(len, words.values())) / 5
    scores = {}
    for i, ws in words.items():
        s = 0.0
        for q in ("cat", "the"):
            df = sum(q in w for w in words.values())
            tf = ws.count(q)
            s += math.log(1 + (5 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))
        if s:
            scores[i] = round(s, 6)
    assert [(i, s) for i, s, _ in got] == sorted(scores.items(), key=lambda x: (-x[1], x[0])) and [r for *_, r in got] == [1, 2, 3]


def test_dense_in_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    vecs, queries = rng.normal(size=(80, 8)), rng.normal(size=(7, 8))
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(vecs)], "vec_id int, embedding array<float>").repartition(5)
    q = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(queries)], "query_id int, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in search.dense_neighbors(v, q, 4).collect())
    vecs = vecs.astype(np.float32).astype(float)
    cosine = np.round((vecs / np.linalg.norm(vecs, axis=1, keepdims=True)) @ (queries / np.linalg.norm(queries, axis=1, keepdims=True)).T, 6)
    want = [(j, n + 1, i) for j in range(7) for n, i in enumerate(sorted(range(80), key=lambda i: (-cosine[i, j], i))[:4])]
    assert got == sorted(want)


def test_fuse_ranks_by_score(spark):
    a = spark.createDataFrame([(1, 9.0), (2, 8.0)], "doc_id int, score double")
    b = spark.createDataFrame([(2, 0.5), (3, 0.1)], "doc_id int, score double")
    got = [(r["doc_id"], r["score"]) for r in search.fuse([a, b]).collect()]
    assert got == [(2, round(1 / 62 + 1 / 61, 9)), (1, round(1 / 61, 9)), (3, round(1 / 62, 9))]


def test_dense_scorers_give_at_most_k_rows_per_query_and_task(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(i, [round(float(x), 1) for x in rng.normal(size=4)]) for i in range(3000)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    ids, matrix = list(range(1024)), rng.normal(size=(1024, 4))
    scorer = search._block_scorer(ids, matrix, 10, "vec_id", "embedding")
    assert vectors.mapInPandas(scorer, "query_id bigint, vec_id bigint, score double").count() <= 10 * 1024 * 3
    queries = spark.createDataFrame([(i, [float(x) for x in matrix[i]]) for i in range(40)], "query_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in search.dense_neighbors(vectors, queries, 10).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    for q in range(40):
        scores = np.round(x @ (matrix[q] / np.linalg.norm(matrix[q])), 6)
        want = sorted(range(3000), key=lambda i: (-scores[i], i))[:10]
        assert [got[q, r + 1][0] for r in range(10)] == want


def test_regexp_holds_for_the_whole_value(spark):
    spec = TypeSpec("t", properties=(Property("v", constraints=Constraints(regexp="A")),))
    df = spark.createDataFrame([("A",), ("A\n",), ("AB",)], "v string")
    assert quality.check_constraints(df, spec, ["v"]).count() == 2


def test_nanosecond_series_keep_their_values(spark):
    from recordlake.operators import timeseries

    df = spark.createDataFrame([("2024-01-01 00:00:00.123456",), (None,)], "t string").select(F.to_timestamp("t").alias("ts"), F.lit("a").alias("tag"), F.lit(1.0).alias("v"))
    spec = TimeseriesSpec("ts", ("tag",), ("v",), precision="NANOSECOND")
    assert timeseries.ts_ingest(df, spec).select(F.unix_micros("ts") % 1_000_000).collect()[0][0] == 123456
    assert [r["code"] for r in timeseries.ts_rejected(df, spec).collect()] == ["null_timestamp"]
