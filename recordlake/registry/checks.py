"""Constraints, uniqueness, links, schema comparison, rebuilds."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.model import Constraints, Property, TypeSpec
from recordlake.operators import catalog, quality
from recordlake.plans import rebuild as plans
from recordlake.registry.base import Group, table
from recordlake.registry.shapes import WIDE_SQL, wide_records
from recordlake.session import work_path
from recordlake.sources import snapshots

G = Group()

LINE = TypeSpec("line", properties=(
    Property("l_quantity", "DOUBLE", Constraints(not_null=True, min="2", max="45")),
    Property("l_discount", "DOUBLE", Constraints(min="0.02")),
    Property("l_returnflag", "STRING", Constraints(regexp="[AN]", max="1")),
    Property("l_shipdate", "DATETIME", Constraints(min="1996-01-01 00:00:00")),
))


@G.add("k1_check_constraints", """SELECT l_orderkey, l_linenumber, property, rule, count(*) AS n FROM (
 SELECT l_orderkey, l_linenumber, 'l_quantity' AS property, 'min' AS rule FROM lineitem WHERE l_quantity < 2 UNION ALL SELECT l_orderkey, l_linenumber, 'l_quantity', 'max' FROM lineitem WHERE l_quantity > 45
 UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', 'min' FROM lineitem WHERE l_discount < 0.02 UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', 'regexp' FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
 UNION ALL SELECT l_orderkey, l_linenumber, 'l_shipdate', 'min' FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01') GROUP BY ALL""")
def k1(spark, folder):
    found = quality.check_constraints(table(spark, folder, "lineitem"), LINE, ["l_orderkey", "l_linenumber"])
    return found.groupBy("l_orderkey", "l_linenumber", "property", "rule").agg(F.count(F.lit(1)).alias("n"))


@G.add("k1_regexp_whole_value", r"SELECT page_id, url AS value FROM pages WHERE NOT regexp_full_match(url, 'https://[^?#]+')")
def k1_regexp(spark, folder):
    spec = TypeSpec("page", properties=(Property("url", constraints=Constraints(regexp="https://[^?#]+")),))
    return quality.check_constraints(table(spark, folder, "pages"), spec, ["page_id"]).select("page_id", "value")


@G.add("k1_dynamic_constraints", f"""SELECT CAST(event_id AS VARCHAR) AS rid, property, rule FROM (
 SELECT event_id, 'user' AS property, 'mandatory' AS rule FROM {WIDE_SQL} WHERE event_type NOT IN ('view', 'signup')
 UNION ALL SELECT event_id, 'k', 'notnull' FROM {WIDE_SQL} WHERE event_type = 'signup'
 UNION ALL SELECT event_id, 'k', 'max' FROM {WIDE_SQL} WHERE event_type IN ('view', 'click', 'purchase') AND CAST(body->>'$.k' AS DOUBLE) > 90)""")
def k1_dynamic(spark, folder):
    """MANDATORY on dynamic records is about the key being present; an explicit null is NOTNULL's business."""
    spec = TypeSpec("event", properties=(
        Property("user", "LONG", Constraints(mandatory=True)), Property("k", "LONG", Constraints(not_null=True, max="90"))))
    return quality.check_constraints(wide_records(spark, folder), spec, ["rid"], props="properties").select("rid", "property", "rule")


@G.add("k1_dynamic_lengths", """SELECT * FROM (SELECT conv_id, turn, unnest([CASE WHEN length(text) < 40 THEN 'text min' END, CASE WHEN length(text) > 200 THEN 'text max' END,
 CASE WHEN len(string_split(text, ' ')) > 30 THEN 'words max' END, CASE WHEN turn > 3 THEN 'turn max' END]) AS v FROM conversations) WHERE v IS NOT NULL""")
def k1_lengths(spark, folder):
    """MIN and MAX on dynamic records: a text's length, a list's size, a number's value."""
    body = F.to_json(F.struct("text", F.split("text", " ").alias("words"), "turn"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", F.try_variant_get(F.try_parse_json(body), "$", "map<string,variant>").alias("p"))
    spec = TypeSpec("turn", properties=(
        Property("text", "STRING", Constraints(min="40", max="200")), Property("words", "LIST", Constraints(max="30")), Property("turn", "LONG", Constraints(max="3"))))
    found = quality.check_constraints(rows, spec, ["conv_id", "turn"], props="p")
    return found.select("conv_id", "turn", F.concat_ws(" ", "property", "rule").alias("v"))


@G.add("k3_check_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def k3(spark, folder):
    return quality.check_unique(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@G.add("k4_apply_defaults", "SELECT d.doc_id, coalesce(quality, 7) AS quality, lower(lang) || '!' AS label FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def k4(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang").join(table(spark, folder, "labels").select("doc_id", "quality"), ["doc_id"], "left")
    spec = TypeSpec("doc", properties=(
        Property("quality", "INTEGER", Constraints(default="7")), Property("label", "STRING", Constraints(default="concat(lower(lang), '!')"))))
    return quality.apply_defaults(docs, spec).select("doc_id", "quality", "label")


@G.add("k5_check_links", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def k5(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return quality.check_links(lines, "l_orderkey", table(spark, folder, "orders").where("o_orderstatus <> 'P'"), "o_orderkey")


# ---- schema, taken from all dynamic records -------------------------------------------------
OBSERVED_SQL = f"""(WITH seen AS (SELECT event_type AS type, k.key AS property, json_type(body, '$.' || k.key) AS jt FROM {WIDE_SQL}, unnest(json_keys(body)) AS k(key) WHERE event_type <> 'error'),
 total AS (SELECT event_type AS type, count(*) AS total FROM events GROUP BY 1)
 SELECT seen.type, property, CASE WHEN count(*) FILTER (WHERE jt <> 'NULL') = 0 THEN 'UNKNOWN' WHEN bool_or(jt = 'VARCHAR') THEN 'STRING' WHEN bool_or(jt = 'DOUBLE') THEN 'DOUBLE' ELSE 'INTEGER' END AS type_name,
 count(*) = any_value(total) AS mandatory, count(*) FILTER (WHERE jt = 'NULL') = 0 AS not_null FROM seen JOIN total ON seen.type = total.type GROUP BY 1, 2)"""

DESIRED = (
    TypeSpec("view", "DOCUMENT", properties=(
        Property("k", "INTEGER", Constraints(mandatory=True, not_null=True)), Property("user", "LONG", Constraints(mandatory=True)),
        Property("score", "DOUBLE", Constraints(mandatory=True, not_null=True, max="500")), Property("note", "STRING"))),
    TypeSpec("click", "VERTEX", properties=(Property("k", "INTEGER", Constraints(mandatory=True, not_null=True)),)),
    TypeSpec("signup", "DOCUMENT", properties=(Property("user", "INTEGER", Constraints(mandatory=True, not_null=True, default="0")),)),
    TypeSpec("refund", "DOCUMENT", properties=(Property("amount", "DOUBLE"),)),
)
DESIRED_SQL = """(SELECT * FROM (VALUES ('view', 'DOCUMENT', 'k', 'INTEGER', true, true, NULL, NULL), ('view', 'DOCUMENT', 'user', 'LONG', true, false, NULL, NULL), ('view', 'DOCUMENT', 'score', 'DOUBLE', true, true, '500', NULL),
 ('view', 'DOCUMENT', 'note', 'STRING', false, false, NULL, NULL), ('click', 'VERTEX', 'k', 'INTEGER', true, true, NULL, NULL), ('signup', 'DOCUMENT', 'user', 'INTEGER', true, true, NULL, '0'),
 ('refund', 'DOCUMENT', 'amount', 'DOUBLE', false, false, NULL, NULL)) v(type, kind, property, type_name, mandatory, not_null, max, dflt))"""


@G.add("k6_observed_columns", f"SELECT * FROM {OBSERVED_SQL}")
def k6(spark, folder):
    return catalog.observed_columns(wide_records(spark, folder)).select("type", "property", "type_name", "mandatory", "not_null")


@G.add("k7_schema_diff", f"""WITH d AS (SELECT * FROM {DESIRED_SQL}), a AS (SELECT * FROM {OBSERVED_SQL}), m AS (SELECT d.*, a.type_name AS have_type, a.mandatory AS have_m, a.not_null AS have_n FROM d JOIN a ON d.type = a.type AND d.property = a.property)
 SELECT DISTINCT 'create_type' AS action, type, NULL AS property, kind AS detail, NULL AS value FROM d WHERE type NOT IN (SELECT type FROM a)
 UNION ALL SELECT DISTINCT 'kind_drift', type, NULL, 'DOCUMENT', kind FROM d WHERE type IN (SELECT type FROM a) AND kind <> 'DOCUMENT'
 UNION ALL SELECT 'create_property', type, property, type_name, NULL FROM d WHERE (type, property) NOT IN (SELECT (type, property) FROM a)
 UNION ALL SELECT 'alter_type', type, property, have_type, type_name FROM m WHERE have_type <> type_name
 UNION ALL SELECT 'alter_constraint', type, property, 'mandatory', CAST(mandatory AS VARCHAR) FROM m WHERE mandatory <> have_m
 UNION ALL SELECT 'alter_constraint', type, property, 'notnull', CAST(not_null AS VARCHAR) FROM m WHERE not_null <> have_n
 UNION ALL SELECT 'alter_constraint', type, property, 'max', max FROM m WHERE max IS NOT NULL
 UNION ALL SELECT 'alter_default', type, property, NULL, dflt FROM m WHERE dflt IS NOT NULL
 UNION ALL SELECT DISTINCT 'drop_type', type, NULL, 'DOCUMENT', NULL FROM a WHERE type NOT IN (SELECT type FROM d)""")
def k7(spark, folder):
    return catalog.schema_diff(catalog.spec_columns(spark, DESIRED), catalog.observed_columns(wide_records(spark, folder)), drops=True)


NEEDED_SQL = "(SELECT * FROM (VALUES ('view', 'k', 'LONG'), ('view', '@rid', 'STRING'), ('view', 'score', 'INTEGER'), ('view', 'gone', 'STRING'), ('purchase', 'k', 'DATETIME'), ('signup', 'user', 'FLOAT'), ('nothing', 'x', 'LONG')) v(type, property, type_name))"


def _needed(spark):
    rows = [("view", "k", "LONG"), ("view", "@rid", "STRING"), ("view", "score", "INTEGER"), ("view", "gone", "STRING"),
            ("purchase", "k", "DATETIME"), ("signup", "user", "FLOAT"), ("nothing", "x", "LONG")]
    return spark.createDataFrame(rows, "type string, property string, type_name string")


@G.add("k12_missing_columns", f"SELECT * FROM {NEEDED_SQL} WHERE property NOT LIKE '@%' AND (type, property) NOT IN (SELECT (type, property) FROM {OBSERVED_SQL})")
def k12(spark, folder):
    return quality.missing_columns(_needed(spark), catalog.observed_columns(wide_records(spark, folder)))


@G.add("k13_type_drift", f"SELECT n.type, n.property, n.type_name AS expected, o.type_name AS actual FROM {NEEDED_SQL} n JOIN {OBSERVED_SQL} o ON n.type = o.type AND n.property = o.property WHERE n.type_name = 'INTEGER' AND o.type_name = 'DOUBLE'")
def k13(spark, folder):
    return quality.type_drift(_needed(spark), catalog.observed_columns(wide_records(spark, folder)))


@G.add("k15_schema_checksum", f"""SELECT sha256(string_agg(h, ',' ORDER BY h)) AS checksum FROM (SELECT sha256(concat_ws(chr(1), chr(0), 'false', 'DOCUMENT', CAST(mandatory AS VARCHAR), chr(0), chr(0),
 CAST(not_null AS VARCHAR), property, 'false', chr(0), type, type_name)) AS h FROM {OBSERVED_SQL})""")
def k15(spark, folder):
    return catalog.schema_checksum(catalog.observed_columns(wide_records(spark, folder)))


@G.add("k16_drift_since", f"""SELECT 'extra_property' AS action, type, property, NULL AS detail, NULL AS value FROM {OBSERVED_SQL} WHERE type = 'purchase' OR (type, property) IN (('signup', 'k'))
 UNION ALL SELECT 'drop_type', 'purchase', NULL, 'DOCUMENT', NULL UNION ALL SELECT 'lost_property', 'view', 'old', NULL, NULL UNION ALL SELECT 'alter_type', 'view', 'k', 'INTEGER', 'STRING'""")
def k16(spark, folder):
    full = Constraints(mandatory=True, not_null=True)
    recorded = (
        TypeSpec("view", properties=(Property("k", "STRING", full), Property("user", "INTEGER", full), Property("score", "DOUBLE", full), Property("old", "STRING"))),
        TypeSpec("click", properties=(Property("k", "INTEGER", full),)), TypeSpec("signup", properties=(Property("user", "INTEGER", full),)))
    return catalog.drift_since(catalog.spec_columns(spark, recorded), catalog.observed_columns(wide_records(spark, folder)))


# ---- rebuild --------------------------------------------------------------------------------


def _convert(df):
    return df.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(14,2)")).withColumn("o_orderstatus", F.lower("o_orderstatus"))


def _rebuilt(spark, folder):
    root = work_path(spark, "orders")
    snapshots.commit(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), root)
    return root, plans.rebuild(spark, root, _convert, ["o_orderkey"])


@G.add("r1_rebuild", "SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice FROM orders")
def r1(spark, folder):
    root, _ = _rebuilt(spark, folder)
    return snapshots.read_current(spark, root)


@G.add("r1_rebuild_catch_up", """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN 'late' ELSE lower(o_orderstatus) END AS o_orderstatus, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice
 FROM orders WHERE o_orderkey % 50 <> 0 UNION ALL SELECT o_orderkey + 1000000000, lower(o_orderstatus), CAST(o_totalprice AS DECIMAL(14,2)) FROM orders WHERE o_orderkey % 50 = 2""")
def r1_catch_up(spark, folder):
    """While the copy runs, a writer publishes a version with changed, removed and new orders."""
    root = work_path(spark, "orders")
    first = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    snapshots.commit(first, root)
    key, written = F.col("o_orderkey"), []

    def convert(df):
        if not written:
            written.append(True)
            changed = first.where(key % 50 != 0).withColumn("o_orderstatus", F.when(key % 50 == 1, F.lit("LATE")).otherwise(F.col("o_orderstatus")))
            snapshots.commit(changed.unionByName(first.where(key % 50 == 2).withColumn("o_orderkey", key + 1000000000)), root)
        return _convert(df)

    plans.rebuild(spark, root, convert, ["o_orderkey"])
    return snapshots.read_current(spark, root)


@G.add("r2_verify_copy", "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS missing_keys, true AS verified FROM orders")
def r2(spark, folder):
    return _rebuilt(spark, folder)[1]


@G.add("r3_resumed_rebuild", "SELECT count(*) AS source_rows, count(*) AS target_rows, CAST(0 AS BIGINT) AS missing_keys, true AS verified FROM orders")
def r3(spark, folder):
    """A rebuild that was finished before gives its own verification row again, and copies nothing."""
    root, _ = _rebuilt(spark, folder)
    return plans.rebuild(spark, root, lambda df: df.where("false"), ["o_orderkey"])


@G.add("r2_filtered_copy", "SELECT count(*) AS source_rows, count(*) FILTER (WHERE o_orderstatus <> 'P') AS target_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS missing_keys, false AS verified FROM orders")
def r2_filtered(spark, folder):
    """A copy that filters rows away does not verify."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return plans.verify_copy(orders.agg(F.count(F.lit(1)).alias("n")), orders.where("o_orderstatus <> 'P'"), orders, ["o_orderkey"])


@G.add("r4_seed", "SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN coalesce(c_mktsegment, '') ELSE c_mktsegment END AS c_mktsegment FROM customer")
def r4(spark, folder):
    base = table(spark, folder, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", F.lit("old").alias("c_mktsegment"))
    rows = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return plans.seed(plans.seed(base, rows, ["c_custkey"]).snapshot, rows, ["c_custkey"]).snapshot
