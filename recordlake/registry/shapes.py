"""Record shaping, typed decode and encode, the JSON bridge."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.functions import values
from recordlake.functions.names import STYLES, variant_value
from recordlake.functions.links import link_text, parse_link
from recordlake.model import Custom, DecimalOf, FieldSpec, ListOf, MapOf, Newtype, RecordSpec, Scalar, SetOf
from recordlake.operators import codec, shape
from recordlake.registry.base import Group, table
from recordlake.sources.tables import read_records

G = Group()


def records(spark, folder):
    """Events as dynamic records: rid, type, properties from the JSON text."""
    rid = F.concat(F.lit("#3:"), F.col("event_id").cast("string"))
    return read_records(table(spark, folder, "events"), "props", rid, F.col("event_type"))


LINE = RecordSpec("line", (
    FieldSpec("l_orderkey", Scalar("i64")), FieldSpec("qty", Scalar("f64"), read_as="l_quantity", write_as="quantity"),
    FieldSpec("note", skip_read=True, skip_write=True), FieldSpec("l_returnflag", Scalar("char")),
))


@G.add("p1_select_wires", "SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def p1(spark, folder):
    return shape.select_wires(table(spark, folder, "lineitem"), LINE)


@G.add("p2_rename_columns", 'SELECT o_orderkey AS "OOrderkey", o_totalprice AS "OTotalprice" FROM orders')
def p2(spark, folder):
    return shape.rename_all(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "PascalCase")


def _cased(style: str, value: str) -> str:
    snake = rf"lower(regexp_replace({value}, '([A-Z])', '_\1', 'g'))[2:]"
    return {
        "lowercase": f"lower({value})", "UPPERCASE": f"upper({value})", "PascalCase": value,
        "camelCase": f"lower({value}[1]) || {value}[2:]", "snake_case": snake, "SCREAMING_SNAKE_CASE": f"upper({snake})",
        "kebab-case": f"replace({snake}, '_', '-')", "SCREAMING-KEBAB-CASE": f"replace(upper({snake}), '_', '-')",
    }[style]


PASCAL_SQL = "(SELECT event_id, 'Event' || upper(event_type[1]) || event_type[2:] AS v FROM events)"


@G.add("p2_rename_variants", "SELECT event_id, " + ", ".join(f'{_cased(s, "v")} AS "{i}_style"' for i, s in enumerate(STYLES)) + f" FROM {PASCAL_SQL}")
def p2_variants(spark, folder):
    pascal = F.concat(F.lit("Event"), F.initcap("event_type"))
    return table(spark, folder, "events").select("event_id", *[variant_value(pascal, s).alias(f"{i}_style") for i, s in enumerate(STYLES)])


@G.add("p3_rename_two_sided", "SELECT l_orderkey, l_quantity AS quantity, l_returnflag FROM lineitem")
def p3(spark, folder):
    return shape.write_names(shape.read_names(table(spark, folder, "lineitem"), LINE), LINE)


# Rows with more than one property: the event's own columns folded into its JSON.
WIDE_SQL = """(SELECT event_id, event_type, CASE event_type WHEN 'view' THEN '{"k": ' || (props->>'$.k') || ', "user": ' || user_id || ', "score": ' || value || '}'
 WHEN 'click' THEN '{"k": ' || (CAST(props->>'$.k' AS BIGINT) * 4) || '}' WHEN 'signup' THEN '{"user": ' || user_id || ', "k": null}'
 WHEN 'purchase' THEN '{"k": "' || (props->>'$.k') || '"}' ELSE '[' || user_id || ']' END AS body FROM events)"""


def wide(spark, folder):
    """Good rows and four kinds of bad ones: too large for i8, null, text, not an object."""
    k, user, score = F.get_json_object("props", "$.k"), F.col("user_id").cast("string"), F.col("value").cast("string")
    body = (
        F.when(F.col("event_type") == "view", F.concat(F.lit('{"k": '), k, F.lit(', "user": '), user, F.lit(', "score": '), score, F.lit("}")))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"k": '), (k.cast("bigint") * 4).cast("string"), F.lit("}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"user": '), user, F.lit(', "k": null}')))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"k": "'), k, F.lit('"}')))
        .otherwise(F.concat(F.lit("["), user, F.lit("]")))
    )
    return table(spark, folder, "events").select("event_id", "event_type", body.alias("body"))


def wide_records(spark, folder):
    return read_records(wide(spark, folder), "body", F.col("event_id").cast("string"), F.col("event_type"))


@G.add("p4_flatten_rest", f"SELECT rid, k.key AS key FROM (SELECT CAST(event_id AS VARCHAR) AS rid, body FROM {WIDE_SQL} WHERE event_type <> 'error'), unnest(json_keys(body)) AS k(key) WHERE k.key <> 'k'")
def p4(spark, folder):
    rest = shape.flatten_rest(wide_records(spark, folder), ["k"])
    return rest.select("rid", F.explode(F.map_keys("rest")).alias("key"))


@G.add("p4_flatten_struct", "SELECT o_orderkey, o_custkey, c_name, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey")
def p4_struct(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", F.struct(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal").alias("who"))
    joined = table(spark, folder, "orders").select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    return shape.flatten_struct(joined, "who", taken=["o_custkey"])


@G.add("p5_with_defaults", f"SELECT event_id, CASE event_type WHEN 'view' THEN body->>'$.k' WHEN 'click' THEN body->>'$.k' WHEN 'signup' THEN NULL WHEN 'purchase' THEN body->>'$.k' END AS k, coalesce(CASE WHEN event_type <> 'error' THEN body->>'$.user' END, '-1') AS person FROM {WIDE_SQL}")
def p5(spark, folder):
    props = F.col("properties")
    missing = F.lit("-1").cast("variant")
    out = read_records(wide(spark, folder), "body", F.col("event_id").cast("string"))

    def text(c):
        return F.try_variant_get(c, "$", "string")

    return out.select(
        F.col("rid").cast("bigint").alias("event_id"),
        text(shape.with_default(props, "k", F.lit(None).cast("variant"))).alias("k"),
        text(shape.with_default(props, "user", missing)).alias("person"))


@G.add("p6_skip_if", "SELECT o_orderkey, count(*) AS n FROM (SELECT o_orderkey, unnest(['o_orderkey', 'o_custkey']) FROM orders UNION ALL SELECT o_orderkey, 'o_orderpriority' FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY 1")
def p6(spark, folder):
    """Skipped fields, and fields skipped when a predicate holds, leave no key in the record."""
    spec = RecordSpec("order", (
        FieldSpec("o_orderkey", Scalar("i64"), key=True), FieldSpec("o_custkey", Scalar("i64")), FieldSpec("o_totalprice", Scalar("f64"), skip_write=True),
        FieldSpec("o_orderpriority", skip_write_if=lambda c: c == "5-LOW")))
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    packed = codec.encode(rows, spec)
    return packed.select(F.try_variant_get(F.col("properties")["o_orderkey"], "$", "bigint").alias("o_orderkey"), F.size("properties").cast("bigint").alias("n"))


@G.add("p7_intrinsics", "SELECT event_id, CASE WHEN event_type = 'view' THEN '#7:' || user_id ELSE '#3:' || event_id END AS rid, CASE WHEN event_type = 'click' THEN 'click!' ELSE event_type END AS kind FROM events")
def p7(spark, folder):
    props = F.map_filter(
        F.create_map(F.lit("@rid"), F.when(F.col("event_type") == "view", F.concat(F.lit("#7:"), F.col("user_id"))),
                     F.lit("@type"), F.when(F.col("event_type") == "click", F.lit("click!"))), lambda k, v: v.isNotNull())
    recs = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("#3:"), F.col("event_id")).alias("rid"), F.col("event_type").alias("type"), props.alias("properties"))
    return shape.intrinsics(recs).select("event_id", F.col("`@rid`").alias("rid"), F.col("`@type`").alias("kind"))


@G.add("p8_tag_dispatch", """SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS amount, CASE WHEN event_type = 'click' THEN user_id END AS clicker,
 CASE WHEN event_type = 'error' THEN 'missing_field' WHEN event_type IN ('purchase', 'click') THEN NULL ELSE 'unknown_variant' END AS code FROM events""")
def p8(spark, folder):
    events = table(spark, folder, "events").withColumn("tag", F.when(F.col("event_type") != "error", F.col("event_type")))
    out = shape.dispatch(events, "tag", {"purchase": ["value"], "click": ["user_id", "ts"]})
    return out.select("event_id", F.col("purchase.value").alias("amount"), F.col("click.user_id").alias("clicker"), "code")


@G.add("p9_enum_decode", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low' END AS variant, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN NULL ELSE 'unknown_variant' END AS code FROM orders")
def p9(spark, folder):
    return shape.enum_decode(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                             {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}).drop("o_orderpriority")


def _linked(spark, folder, encoding):
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"))
    return shape.encode_links(orders, "customer", table(spark, folder, "customer").select("c_custkey", "c_name"), "c_custkey", encoding)


@G.add("p10_link", "SELECT o_orderkey, o_custkey AS customer FROM orders")
def p10_link(spark, folder):
    return _linked(spark, folder, "LINK")


@G.add("p10_map", "SELECT o_orderkey, c_custkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def p10_map(spark, folder):
    return _linked(spark, folder, "MAP").select("o_orderkey", "customer.c_custkey", "customer.c_name")


@G.add("p10_json", """SELECT o_orderkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS customer FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def p10_json(spark, folder):
    return _linked(spark, folder, "JSON")


@G.add("p10_soft_limit", """SELECT event_id, r // 500 AS batch_no, CAST(coalesce(sum(length(props)) OVER (PARTITION BY r // 500 ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 3000 AS part_no
 FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS r FROM events)""")
def p10_soft(spark, folder):
    from recordlake.operators.read import number_batches

    batches = number_batches(table(spark, folder, "events").select("event_id", "props"), ["event_id"], 500)
    return shape.soft_limit(batches, "batch_no", "event_id", 3000, F.length("props")).select("event_id", "batch_no", "part_no")


# ---- decode ---------------------------------------------------------------------------------
BODY = RecordSpec("body", (FieldSpec("k", Scalar("i8")), FieldSpec("user", Scalar("i32"), optional=True), FieldSpec("score", Scalar("f64"), default=0.0)))
KIND = "CASE WHEN event_type = 'click' THEN 'int32' WHEN event_type = 'signup' THEN 'null' ELSE 'string' END"


@G.add("d1_decode_good", f"SELECT CAST(event_id AS VARCHAR) AS rid, event_type AS type, CAST(body->>'$.k' AS TINYINT) AS k, CAST(body->>'$.user' AS INTEGER) AS \"user\", coalesce(CAST(body->>'$.score' AS DOUBLE), 0) AS score FROM {WIDE_SQL} WHERE event_type = 'view' OR (event_type = 'click' AND CAST(body->>'$.k' AS BIGINT) <= 127)")
def d1_good(spark, folder):
    return codec.decode(wide_records(spark, folder), BODY)[0]


@G.add("d1_decode_bad", f"SELECT CAST(event_id AS VARCHAR) AS rid, 'k' AS path, CASE WHEN event_type = 'error' THEN 'missing_field' ELSE 'type_mismatch' END AS code, CASE WHEN event_type <> 'error' THEN 'i8' END AS expected, CASE WHEN event_type <> 'error' THEN {KIND} END AS actual FROM {WIDE_SQL} WHERE NOT (event_type = 'view' OR (event_type = 'click' AND CAST(body->>'$.k' AS BIGINT) <= 127))")
def d1_bad(spark, folder):
    return codec.decode(wide_records(spark, folder), BODY)[1].select("rid", "path", "code", "expected", "actual")


@G.add("s10_stream_rows", "SELECT CAST(event_id AS VARCHAR) AS rid, event_type AS type, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def s10(spark, folder):
    recs = read_records(table(spark, folder, "events"), "props", F.col("event_id").cast("string"), F.col("event_type"))
    return codec.decode(recs, RecordSpec("props", (FieldSpec("k", Scalar("i32")),)), mode="failfast")


def _json_rows(spark, folder, name, key, *parts):
    """A table's columns as JSON text, read back as dynamic records."""
    source = table(spark, folder, name)
    text = F.to_json(F.struct(*parts))
    return read_records(source.select(F.col(key).cast("string").alias("id"), text.alias("body")), "body", F.col("id"))


def _decoded(name, sql, source, spec, select):
    def good(spark, folder):
        return codec.decode(source(spark, folder), spec)[0].selectExpr(*select)

    G.add(name, sql)(good)


def _order_rows(spark, folder):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    return _json_rows(
        spark, folder, "orders", "o_orderkey", F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        iso.alias("placed"), F.concat(F.lit("#12:"), F.col("o_custkey")).alias("customer"), F.array(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_custkey")).alias("ids"),
        (F.col("o_totalprice") > 250000).alias("large"), F.col("o_orderpriority").alias("priority"))


_decoded("d2_string", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, o_orderpriority AS priority FROM orders", _order_rows, RecordSpec("o", (FieldSpec("priority"),)), ["rid", "priority"])
_decoded("d3_char", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, o_orderstatus AS status FROM orders", _order_rows, RecordSpec("o", (FieldSpec("status", Scalar("char")),)), ["rid", "status"])
_decoded("d4_bool", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, o_totalprice > 250000 AS large FROM orders", _order_rows, RecordSpec("o", (FieldSpec("large", Scalar("bool")),)), ["rid", "large"])
_decoded("d5_i16", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(o_orderkey AS SMALLINT) AS key FROM orders WHERE o_orderkey <= 32767", _order_rows, RecordSpec("o", (FieldSpec("key", Scalar("i16")),)), ["rid", "key"])
_decoded("d5_u8", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(o_orderkey AS SMALLINT) AS key FROM orders WHERE o_orderkey <= 255", _order_rows, RecordSpec("o", (FieldSpec("key", Scalar("u8")),)), ["rid", "key"])
_decoded("d6_f64", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(o_orderkey AS DOUBLE) AS key, o_totalprice AS price FROM orders", _order_rows, RecordSpec("o", (FieldSpec("key", Scalar("f64")), FieldSpec("price", Scalar("f64")))), ["rid", "key", "price"])
_decoded("d7_datetime", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(epoch(o_orderdate) - 7200 AS BIGINT) AS placed FROM orders", _order_rows, RecordSpec("o", (FieldSpec("placed", Scalar("datetime")),)), ["rid", "unix_timestamp(placed) AS placed"])
_decoded("d10_list", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, o_custkey || ',' || o_orderkey || ',' || o_custkey AS ids FROM orders", _order_rows, RecordSpec("o", (FieldSpec("ids", ListOf(Scalar("i64"))),)), ["rid", "array_join(ids, ',') AS ids"])
_decoded("d10_set", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CASE WHEN o_custkey = o_orderkey THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || ',' || o_orderkey END AS ids FROM orders", _order_rows, RecordSpec("o", (FieldSpec("ids", SetOf(Scalar("i64"))),)), ["rid", "array_join(ids, ',') AS ids"])
_decoded("d12_decimal", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders", _order_rows, RecordSpec("o", (FieldSpec("price", DecimalOf(2)),)), ["rid", "CAST(price AS DECIMAL(18,2)) AS price"])
_decoded("d13_link", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(12 AS INTEGER) AS bucket, o_custkey AS pos FROM orders", _order_rows, RecordSpec("o", (FieldSpec("customer", Scalar("link")),)), ["rid", "customer.bucket", "customer.pos"])
_decoded("d14_custom", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'", _order_rows,
         RecordSpec("o", (FieldSpec("level", Custom(lambda v: F.when(~F.try_variant_get(v, "$", "string").endswith("SPECIFIED"), F.substring(F.try_variant_get(v, "$", "string"), 1, 1)), "int"), read_as="priority"),)), ["rid", "level"])
_decoded("d16_newtype", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, o_orderkey AS key FROM orders", _order_rows, RecordSpec("o", (FieldSpec("key", Newtype(Scalar("i64"))),)), ["rid", "key"])


@G.add("d8_date", "SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day FROM lineitem")
def d8(spark, folder):
    """Dates come from timestamps only, so the records are built from typed columns."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("timestamp").alias("day"))
    spec = RecordSpec("line", (FieldSpec("l_orderkey", Scalar("i64")), FieldSpec("day", Scalar("date"))))
    return codec.decode(codec.encode(lines, spec), spec, json_source=False)[0].select("l_orderkey", "day")


@G.add("d8_date_from_text", "SELECT count(*) AS bad FROM orders")
def d8_text(spark, folder):
    spec = RecordSpec("o", (FieldSpec("placed", Scalar("date")),))
    return codec.decode(_order_rows(spark, folder), spec)[1].where("code = 'type_mismatch' AND actual = 'string'").agg(F.count(F.lit(1)).alias("bad"))


@G.add("d9_bytes", "SELECT CAST(event_id AS VARCHAR) AS rid, upper(printf('%02x%02x', CAST(props->>'$.k' AS INTEGER), user_id % 200)) AS hex FROM events")
def d9(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    recs = _json_rows(spark, folder, "events", "event_id", F.array(k, (F.col("user_id") % 200).cast("int")).alias("blob"))
    return codec.decode(recs, RecordSpec("e", (FieldSpec("blob", Scalar("bytes")),)))[0].select("rid", F.hex("blob").alias("hex"))


@G.add("d10_list_error", "SELECT CAST(o_orderkey AS VARCHAR) AS rid, 'ids.list[1]' AS path, 'i8' AS expected FROM orders WHERE o_custkey <= 127 AND o_orderkey > 127 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'ids.list[0]', 'i8' FROM orders WHERE o_custkey > 127")
def d10_error(spark, folder):
    return codec.decode(_order_rows(spark, folder), RecordSpec("o", (FieldSpec("ids", ListOf(Scalar("i8"))),)))[1].select("rid", "path", "expected")


@G.add("d11_map", "SELECT c_custkey, k AS key, v AS value FROM (SELECT c_custkey, unnest(['nation', 'id']) AS k, unnest([CAST(c_nationkey AS BIGINT), c_custkey]) AS v FROM customer)")
def d11(spark, folder):
    entries = F.create_map(F.lit("nation"), F.col("c_nationkey").cast("bigint"), F.lit("id"), F.col("c_custkey"))
    recs = _json_rows(spark, folder, "customer", "c_custkey", entries.alias("ids"))
    good = codec.decode(recs, RecordSpec("c", (FieldSpec("ids", MapOf(Scalar("i64"))),)))[0]
    return good.select(F.col("rid").cast("bigint").alias("c_custkey"), F.explode("ids").alias("key", "value"))


@G.add("d13_bad_link", "SELECT '#' || l_suppkey || '-' || l_partkey AS text, count(*) AS n FROM lineitem GROUP BY 1")
def d13_bad(spark, folder):
    """Texts close to the link form are rejected as a whole."""
    text = F.concat(F.lit("#"), F.col("l_suppkey"), F.lit("-"), F.col("l_partkey"))
    return table(spark, folder, "lineitem").select(text.alias("text")).where(parse_link(F.col("text")).isNull()).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@G.add("d15_nested", "SELECT CAST(c_custkey AS VARCHAR) AS rid, c_name AS name, c_nationkey AS nation FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'who.nation', NULL FROM customer WHERE c_acctbal < 0")
def d15(spark, folder):
    nation = F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).otherwise(F.lit('"x"'))
    body = F.concat(F.lit('{"who":{"name":"'), F.col("c_name"), F.lit('","nation":'), nation, F.lit("}}"))
    source = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("id"), body.alias("body"))
    inner = RecordSpec("who", (FieldSpec("name"), FieldSpec("nation", Scalar("i32"))))
    good, bad = codec.decode(read_records(source, "body", F.col("id")), RecordSpec("c", (FieldSpec("who", inner),)))
    return good.select("rid", "who.name", "who.nation").unionByName(bad.select("rid", F.col("path").alias("name"), F.lit(None).cast("int").alias("nation")))


@G.add("e1_encode", """SELECT * FROM (SELECT p_partkey, unnest(['p_partkey', 'p_size', 'price']) AS key, unnest([CAST(p_partkey AS VARCHAR), CAST(p_size AS VARCHAR),
 CASE WHEN p_size <= 25 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END]) AS value FROM part) WHERE value IS NOT NULL""")
def e1(spark, folder):
    spec = RecordSpec("part", (FieldSpec("p_partkey", Scalar("i64")), FieldSpec("p_size", Scalar("i16")), FieldSpec("price", Scalar("i64"), optional=True)))
    price = F.when(F.col("p_size") <= 25, F.floor("p_retailprice").cast("bigint"))
    rows = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("smallint").alias("p_size"), price.alias("price"))
    packed = codec.encode(rows, spec).select(F.try_variant_get(F.col("properties")["p_partkey"], "$", "bigint").alias("p_partkey"), F.explode("properties").alias("key", "v"))
    return packed.select("p_partkey", "key", F.try_variant_get("v", "$", "string").alias("value"))


@G.add("e2_to_json", """SELECT event_id, '{"event_id":' || event_id || ',"ts":"' || strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00","raw":[' || ascii(event_type[1]) || ',' || ascii(event_type[2]) || '],"who":"#5:' || user_id || '","amount":"' || CAST(round(value * 100) AS BIGINT) || 'e-2"}' AS json FROM events""")
def e2(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"), F.substring("event_type", 1, 2).cast("binary").alias("raw"),
        F.struct(F.lit(5).alias("bucket"), F.col("user_id").alias("pos")).alias("who"), F.col("value").cast("decimal(18,2)").alias("amount"))
    return codec.rows_json(rows).select("event_id", "json")


@G.add("e3_from_json", "SELECT o_orderkey, CASE WHEN o_orderkey * 400000 < 2147483648 THEN 'int32' ELSE 'int64' END AS whole, 'double' AS wide, 'double' AS part, true AS gone FROM orders")
def e3(spark, folder):
    big = (F.col("o_orderkey") * 400000).cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey", values.number_kind(big).alias("whole"), values.number_kind(F.concat(F.lit("9"), F.lpad("o_orderkey", 19, "9"))).alias("wide"),
        values.number_kind(F.concat(F.col("o_orderkey"), F.lit(".25"))).alias("part"), values.parse_value(F.when(F.col("o_orderkey") >= 0, F.lit("null"))).isNull().alias("gone"))


@G.add("e4_record_json", """SELECT event_id, CASE WHEN event_type = 'view' THEN '{"k":' || (props->>'$.k') || ',"@rid":"#3:' || event_id || '"}' ELSE '{"k":' || (props->>'$.k') || ',"@rid":"#3:' || event_id || '","@type":"' || event_type || '"}' END AS json FROM events""")
def e4(spark, folder):
    """Metadata wins over a property of the same name; empty metadata is left out."""
    body = F.concat(F.lit('{"@rid":"x",'), F.substring("props", F.lit(2), F.length("props")))
    source = table(spark, folder, "events").withColumn("body", body)
    recs = read_records(source.select("event_id", "body", "event_type"), "body", F.concat(F.lit("#3:"), F.col("event_id")),
                        F.when(F.col("event_type") != "view", F.col("event_type")).otherwise(F.lit("")))
    return codec.record_json(recs).select(F.substring_index("rid", ":", -1).cast("bigint").alias("event_id"), "json")


@G.add("e5_duration_ms", "SELECT event_id, CASE event_type WHEN 'view' THEN user_id * 86400000 WHEN 'click' THEN user_id * 3600000 WHEN 'error' THEN user_id * 60000 WHEN 'signup' THEN user_id * 1000 END AS ms FROM events")
def e5(spark, folder):
    unit = (F.when(F.col("event_type") == "view", F.lit("DAYS")).when(F.col("event_type") == "click", F.lit("hours"))
            .when(F.col("event_type") == "error", F.lit("Minute")).when(F.col("event_type") == "signup", F.lit("SECOND")).otherwise(F.lit("WEEKS")))
    return table(spark, folder, "events").select("event_id", values.duration_ms(F.concat_ws(" ", F.col("user_id"), unit)).alias("ms"))


@G.add("d13_link_round_trip", "SELECT '#' || l_suppkey || ':' || l_partkey AS rid, count(*) AS n FROM lineitem GROUP BY 1")
def d13_round_trip(spark, folder):
    text = F.concat(F.lit("#"), F.col("l_suppkey"), F.lit(":"), F.col("l_partkey"))
    return table(spark, folder, "lineitem").select(link_text(parse_link(text)).alias("rid")).groupBy("rid").agg(F.count(F.lit(1)).alias("n"))
