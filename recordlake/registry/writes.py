"""Update algebra, bulk load and change capture."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.functions.predicates import Where
from recordlake.model import Constraints, FieldSpec, Property, RecordSpec, TypeSpec
from recordlake.operators import change, load, read, update
from recordlake.operators.update import Set
from recordlake.registry.base import Group, table
from recordlake.session import work_path
from recordlake.sources.ranged import RangedTable

G = Group()

ALL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def orders(spark, folder):
    return table(spark, folder, "orders").select(*ALL.split(", "))


def open_orders() -> Where:
    return Where().eq("o_orderstatus", "O")


def _updated(name: str, where, sets, sql: str) -> None:
    def run(spark, folder):
        return update.update_where(orders(spark, folder), where(), sets())

    G.add(name, sql)(run)


_updated("u1_set", open_orders, lambda: Set().set("o_orderpriority", "first").set("o_orderpriority", "last"),
         "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN 'last' ELSE o_orderpriority END AS o_orderpriority FROM orders")
_updated("u2_set_opt", open_orders, lambda: Set().set_opt("o_orderpriority", None).set_opt("o_custkey", F.when(F.col("o_totalprice") > 250000, F.lit(-1))),
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 250000 THEN -1 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
_updated("u3_set_when", open_orders, lambda: Set().set_when(True, "o_custkey", 5).set_when(False, "o_orderpriority", "x"),
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 5 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
_updated("u4_set_raw", open_orders, lambda: Set().set_raw("o_orderpriority", "concat(o_orderpriority, :tail)", tail="-it's"),
         "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority || '-it''s' ELSE o_orderpriority END AS o_orderpriority FROM orders")
_updated("u5_set_expr", open_orders, lambda: Set().set_expr("o_custkey", "o_custkey + 1").set_expr("o_orderkey", "o_orderkey + o_custkey"),
         "SELECT CASE WHEN o_orderstatus = 'O' THEN o_orderkey + o_custkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
_updated("u7_set_or_null", open_orders, lambda: Set().set_or_null("o_orderpriority", None).set_or_null("o_custkey", 3),
         "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 3 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")
_updated("u9_update_where", lambda: Where().between("o_totalprice", 100000, 200000).like("o_orderpriority", "?-H%"),
         lambda: Set().set("o_orderstatus", "X").set_expr("o_custkey", "-o_custkey"),
         "SELECT o_orderkey, CASE WHEN h THEN -o_custkey ELSE o_custkey END AS o_custkey, CASE WHEN h THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderpriority FROM (SELECT *, o_totalprice BETWEEN 100000 AND 200000 AND o_orderpriority LIKE '_-H%' AS h FROM orders)")

# A list column with real nulls: the labels of a document.
TAGS_SQL = "(SELECT d.doc_id, CASE WHEN quality IS NOT NULL THEN ['q' || quality, 't' || toxic] END AS tags, lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def tagged(spark, folder):
    labels = table(spark, folder, "labels").select(
        "doc_id", F.array(F.concat(F.lit("q"), F.col("quality")), F.concat(F.lit("t"), F.col("toxic"))).alias("tags"))
    return table(spark, folder, "documents").select("doc_id", "lang").join(labels, ["doc_id"], "left")


def _tags(name: str, sets, sql: str) -> None:
    def run(spark, folder):
        out = update.update_where(tagged(spark, folder), Where().eq("lang", "en"), sets())
        return out.select("doc_id", F.array_join("tags", ",").alias("tags"))

    G.add(name, f"SELECT doc_id, array_to_string({sql}, ',') AS tags FROM {TAGS_SQL}")(run)


_tags("u6_append", lambda: Set().append("tags", "a").append("tags", "b"),
      "CASE WHEN lang = 'en' THEN list_concat(coalesce(tags, []), ['a', 'b']) ELSE tags END")
_tags("u8_append_if_absent", lambda: Set().append_if_absent("tags", "q1"),
      "CASE WHEN lang = 'en' AND NOT coalesce(list_contains(tags, 'q1'), false) THEN list_concat(coalesce(tags, []), ['q1']) ELSE tags END")
_tags("u12_remove_item", lambda: Set().remove_item("tags", "t0"),
      "CASE WHEN lang = 'en' THEN list_filter(tags, lambda x: x <> 't0') ELSE tags END")
_tags("u12_remove", lambda: Set().remove("tags"), "CASE WHEN lang = 'en' THEN NULL ELSE tags END")


@G.add("u10_upsert_where", f"SELECT {ALL} FROM orders UNION ALL SELECT -1, 42, 'N', NULL, NULL")
def u10(spark, folder):
    return update.upsert_where(orders(spark, folder), {"o_orderkey": -1}, Set().set("o_custkey", 42).set("o_orderstatus", "N"))


@G.add("u10_upsert_where_hit", "SELECT o_orderkey, CASE WHEN o_orderkey = 17 THEN 42 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def u10_hit(spark, folder):
    return update.upsert_where(orders(spark, folder), {"o_orderkey": 17}, Set().set("o_custkey", 42))


@G.add("u11_return_before", f"SELECT {ALL} FROM orders WHERE o_orderstatus = 'O'")
def u11_before(spark, folder):
    return update.update_where(orders(spark, folder), open_orders(), Set().set("o_custkey", 0), returning="before")


@G.add("u11_return_after", "SELECT o_orderkey, CAST(0 AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'O'")
def u11_after(spark, folder):
    return update.update_where(orders(spark, folder), open_orders(), Set().set("o_custkey", 0), returning="after")


@G.add("u11_return_count", "SELECT count(*) AS affected FROM orders WHERE o_orderstatus = 'O'")
def u11_count(spark, folder):
    return update.update_where(orders(spark, folder), open_orders(), Set().set("o_custkey", 0), returning="count")


# Per-customer order facts: an incoming table that covers most, not all, customers.
FACTS_SQL = "(SELECT o_custkey AS c_custkey, max(o_totalprice) AS c_acctbal, CASE WHEN count(*) > 9 THEN 'FREQUENT' END AS c_mktsegment FROM orders GROUP BY 1)"
CUST = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]


def facts(spark, folder):
    return table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_totalprice").alias("c_acctbal"), F.when(F.count(F.lit(1)) > 9, F.lit("FREQUENT")).alias("c_mktsegment"))


@G.add("u13_content", f"SELECT c.c_custkey, CASE WHEN f.c_custkey IS NULL THEN c.c_name END AS c_name, CASE WHEN f.c_custkey IS NULL THEN c.c_acctbal ELSE f.c_acctbal END AS c_acctbal, CASE WHEN f.c_custkey IS NULL THEN c.c_mktsegment ELSE f.c_mktsegment END AS c_mktsegment FROM customer c LEFT JOIN {FACTS_SQL} f ON c.c_custkey = f.c_custkey")
def u13(spark, folder):
    return update.replace_content(table(spark, folder, "customer").select(*CUST), facts(spark, folder), ["c_custkey"])


@G.add("u14_merge", """SELECT c.c_custkey, k AS key, v AS value FROM (SELECT c_custkey, unnest(['segment', 'name']) AS k, unnest([c_mktsegment, c_name]) AS v FROM customer) c
 LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON o_custkey = c_custkey WHERE NOT (k = 'segment' AND o_custkey IS NOT NULL)
 UNION ALL SELECT o_custkey, 'segment', 'orders' FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1
 UNION ALL SELECT o_custkey, 'last', CAST(max(o_orderkey) AS VARCHAR) FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def u14(spark, folder):
    base = table(spark, folder, "customer").select(
        "c_custkey", F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name")).alias("properties"))
    patch = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.create_map(F.lit("segment"), F.lit("orders"), F.lit("last"), F.max("o_orderkey").cast("string")).alias("properties"))
    return update.merge_record(base, patch, ["c_custkey"]).select("c_custkey", F.explode("properties").alias("key", "value"))


@G.add("u15_update_partial", f"SELECT c.c_custkey, c_name, coalesce(f.c_acctbal, c.c_acctbal) AS c_acctbal, coalesce(f.c_mktsegment, c.c_mktsegment) AS c_mktsegment FROM customer c LEFT JOIN {FACTS_SQL} f ON c.c_custkey = f.c_custkey")
def u15(spark, folder):
    return update.update_partial(table(spark, folder, "customer").select(*CUST), facts(spark, folder), "c_custkey").snapshot


@G.add("u15_update_listed", f"SELECT c.c_custkey, c_name, c.c_acctbal AS c_acctbal, CASE WHEN f.c_custkey IS NULL THEN c.c_mktsegment ELSE f.c_mktsegment END AS c_mktsegment FROM customer c LEFT JOIN {FACTS_SQL} f ON c.c_custkey = f.c_custkey")
def u15_listed(spark, folder):
    patch = facts(spark, folder).withColumn("given", F.array(F.lit("c_mktsegment")))
    return update.update_partial(table(spark, folder, "customer").select(*CUST), patch, "c_custkey", present="given").snapshot


@G.add("u15_outcome", "SELECT l.doc_id, d.doc_id IS NOT NULL AS updated FROM labels l LEFT JOIN (SELECT * FROM documents WHERE lang = 'en') d ON l.doc_id = d.doc_id")
def u15_outcome(spark, folder):
    base = table(spark, folder, "documents").where("lang = 'en'").select("doc_id", "source")
    patch = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("string").alias("source"))
    return update.update_partial(base, patch, "doc_id").outcome


@G.add("u16_delete_by_rid", "SELECT d.doc_id, lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL")
def u16(spark, folder):
    return update.delete_by_rid(table(spark, folder, "documents").select("doc_id", "lang"), table(spark, folder, "labels"), "doc_id").snapshot


@G.add("u16_outcome", "SELECT e.user_id AS rid, c_custkey IS NOT NULL AS deleted FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'BUILDING') ON user_id = c_custkey")
def u16_outcome(spark, folder):
    base = table(spark, folder, "customer").where("c_acctbal > 0 AND c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("rid"))
    return update.delete_by_rid(base, table(spark, folder, "events").select(F.col("user_id").alias("rid"))).outcome


@G.add("u17_delete_where", "SELECT doc_id, quality FROM (SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE quality IS NULL OR quality <> 0")
def u17(spark, folder):
    base = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels").select("doc_id", "quality"), ["doc_id"], "left")
    return update.delete_where(base, Where().eq("quality", 0)).snapshot


@G.add("u18_create_records", "SELECT count(*) AS n, count(*) AS rids, CAST(0 AS BIGINT) AS gaps FROM orders")
def u18(spark, folder):
    """Every rid is distinct and positions inside a bucket have no gap."""
    created = load.assign_rids(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 8)
    parts = F.split(F.substring_index("rid", "#", -1), ":")
    per_bucket = created.groupBy(parts[0].alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.max(parts[1].cast("bigint")).alias("top"))
    distinct = created.select("rid").distinct().agg(F.count(F.lit(1)).alias("rids")).scalar()
    return per_bucket.agg(F.sum("n").alias("n"), F.sum(F.col("top") + 1 - F.col("n")).alias("gaps")).withColumn("rids", distinct).select("n", "rids", "gaps")


@G.add("u19_write_returning", "SELECT o_orderkey, 'done' AS o_orderstatus FROM orders WHERE o_orderkey = 17")
def u19(spark, folder):
    after = update.update_where(orders(spark, folder), Where().eq("o_orderkey", 17), Set().set("o_orderstatus", "done"), returning="after")
    return update.write_returning(after.select("o_orderkey", "o_orderstatus"), strict=True)


# ---- bulk load ------------------------------------------------------------------------------
# Stored: orders before 1998. Incoming: all orders, and pending ones a second time; the second copy
# has no priority, and open orders carry no customer.
BASE_SQL = f"(SELECT {ALL} FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"
INC_SQL = """(SELECT o_orderkey * 2 AS row_index, o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderpriority FROM orders
 UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, o_custkey, 'again', o_totalprice + 2, NULL FROM orders WHERE o_orderstatus = 'P')"""
# The same rule told row by row: rank in key, and whether the key is stored.
STEP_SQL = f"""(SELECT i.*, row_number() OVER (PARTITION BY i.o_orderkey ORDER BY row_index) AS rk, b.o_orderkey IS NOT NULL AS stored
 FROM {INC_SQL} i LEFT JOIN {BASE_SQL} b ON i.o_orderkey = b.o_orderkey)"""


def base_orders(spark, folder):
    return table(spark, folder, "orders").where(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))).select(*ALL.split(", "))


def incoming_orders(spark, folder):
    first = table(spark, folder, "orders").select(
        (F.col("o_orderkey") * 2).alias("row_index"), "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority")
    again = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") * 2 + 1).alias("row_index"), "o_orderkey", "o_custkey", F.lit("again").alias("o_orderstatus"),
        (F.col("o_totalprice") + 2).alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority"))
    return first.unionByName(again)


def _loaded(spark, folder, mode, **options):
    return load.bulk_load(base_orders(spark, folder), incoming_orders(spark, folder), ["o_orderkey"], mode, **options)


@G.add("w1_bulk_insert", f"SELECT {ALL} FROM {BASE_SQL} UNION ALL SELECT {ALL} FROM {STEP_SQL} WHERE rk = 1 AND NOT stored")
def w1(spark, folder):
    return _loaded(spark, folder, "IGNORE").snapshot


@G.add("w1_outcome", f"SELECT row_index, CASE WHEN rk = 1 AND NOT stored THEN 'inserted' ELSE 'ignored' END AS status FROM {STEP_SQL}")
def w1_outcome(spark, folder):
    return _loaded(spark, folder, "IGNORE").outcome.select("row_index", "status")


COLLAPSED_SQL = f"""(SELECT o_orderkey, arg_max(o_custkey, row_index) FILTER (WHERE o_custkey IS NOT NULL) AS o_custkey, arg_max(o_orderstatus, row_index) AS o_orderstatus,
 arg_max(o_totalprice, row_index) AS o_totalprice, arg_max(o_orderpriority, row_index) FILTER (WHERE o_orderpriority IS NOT NULL) AS o_orderpriority,
 arg_min(o_orderstatus, row_index) AS first_status FROM {INC_SQL} GROUP BY 1)"""


@G.add("w2_bulk_upsert", f"""SELECT coalesce(b.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(i.o_custkey, b.o_custkey) AS o_custkey, coalesce(i.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
 coalesce(i.o_totalprice, b.o_totalprice) AS o_totalprice, coalesce(i.o_orderpriority, b.o_orderpriority) AS o_orderpriority FROM {BASE_SQL} b FULL JOIN {COLLAPSED_SQL} i ON b.o_orderkey = i.o_orderkey""")
def w2(spark, folder):
    return _loaded(spark, folder, "UPDATE").snapshot


@G.add("w2_ranged_upsert", f"""SELECT coalesce(b.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(i.o_custkey, b.o_custkey) AS o_custkey, coalesce(i.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
 coalesce(i.o_totalprice, b.o_totalprice) AS o_totalprice, coalesce(i.o_orderpriority, b.o_orderpriority) AS o_orderpriority FROM {BASE_SQL} b FULL JOIN {COLLAPSED_SQL} i ON b.o_orderkey = i.o_orderkey""")
def w2_ranged(spark, folder):
    """The same upsert into a stored table in key order: the first rows of all keys, then the repeats."""
    stored_orders, incoming = _ranged_orders(spark, folder), incoming_orders(spark, folder)
    for i in range(2):
        load.ranged_load(stored_orders, incoming.where(F.col("row_index") % 2 == i))
    return stored_orders.read()


def _ranged_orders(spark, folder):
    base = base_orders(spark, folder)
    made = RangedTable(spark, work_path(spark, "orders"), ["o_orderkey"], base.schema, rows_per_file=20_000)
    made.create(base)
    return made


@G.add("w2_ranged_files", f"""SELECT o_orderkey, o_orderstatus, o_totalprice FROM {BASE_SQL} WHERE o_orderkey > (SELECT max(o_orderkey) // 4 FROM orders)
 UNION ALL SELECT o_orderkey, 'new', o_totalprice FROM {BASE_SQL} WHERE o_orderkey <= (SELECT max(o_orderkey) // 4 FROM orders)""")
def w2_files(spark, folder):
    """A batch of the lowest quarter of the keys: read from the files that kept their names and those that did not."""
    stored_orders = _ranged_orders(spark, folder)
    first = table(spark, folder, "orders").agg(F.floor(F.max("o_orderkey") / 4).alias("k")).first()["k"]
    batch = base_orders(spark, folder).where(F.col("o_orderkey") <= first).select(F.col("o_orderkey").alias("row_index"), "o_orderkey", F.lit("new").alias("o_orderstatus"))
    load.ranged_load(stored_orders, batch)
    return stored_orders.read().select("o_orderkey", "o_orderstatus", "o_totalprice")


@G.add("w2_update_columns", f"""SELECT coalesce(b.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN f.o_custkey ELSE b.o_custkey END AS o_custkey,
 CASE WHEN b.o_orderkey IS NULL THEN i.first_status ELSE b.o_orderstatus END AS o_orderstatus, coalesce(i.o_totalprice, b.o_totalprice) AS o_totalprice,
 CASE WHEN b.o_orderkey IS NULL THEN f.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority
 FROM {BASE_SQL} b FULL JOIN {COLLAPSED_SQL} i ON b.o_orderkey = i.o_orderkey LEFT JOIN {STEP_SQL} f ON f.o_orderkey = i.o_orderkey AND f.rk = 1""")
def w2_columns(spark, folder):
    return _loaded(spark, folder, "UPDATE", update_cols=["o_totalprice"]).snapshot


@G.add("w2_outcome", f"SELECT row_index, CASE WHEN rk = 1 AND NOT stored THEN 'inserted' ELSE 'updated' END AS status FROM {STEP_SQL}")
def w2_outcome(spark, folder):
    return _loaded(spark, folder, "UPDATE").outcome.select("row_index", "status")


@G.add("w3_error_mode", f"SELECT row_index, CASE WHEN rk = 1 AND NOT stored THEN 'inserted' ELSE 'failed' END AS status, CASE WHEN rk = 1 AND NOT stored THEN NULL ELSE 'duplicate_key' END AS code, CASE WHEN rk = 1 AND NOT stored THEN NULL ELSE 'o_orderkey' END AS field FROM {STEP_SQL}")
def w3(spark, folder):
    return _loaded(spark, folder, "ERROR").outcome.select("row_index", "status", "code", "field")


@G.add("w4_abort_mode", f"SELECT {ALL} FROM {BASE_SQL}")
def w4(spark, folder):
    return _loaded(spark, folder, "ABORT").snapshot


@G.add("w4_outcome", f"SELECT status, code, count(*) AS n FROM (SELECT 'failed' AS status, CASE WHEN rk = 1 AND NOT stored THEN 'aborted' ELSE 'duplicate_key' END AS code FROM {STEP_SQL}) GROUP BY 1, 2")
def w4_outcome(spark, folder):
    return _loaded(spark, folder, "ABORT").outcome.groupBy("status", "code").agg(F.count(F.lit(1)).alias("n"))


@G.add("w5_validate_only", f"SELECT count(*) AS received, count(*) FILTER (WHERE rk = 1 AND NOT stored) AS inserted, count(*) FILTER (WHERE rk > 1 OR stored) AS updated, CAST(0 AS BIGINT) AS ignored, CAST(0 AS BIGINT) AS failed FROM {STEP_SQL}")
def w5(spark, folder):
    return load.tallies(_loaded(spark, folder, "UPDATE", validate_only=True).outcome)


NULL_SQL = "(SELECT event_id AS row_index, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type, value FROM events)"


@G.add("a3_tallies", f"""SELECT event_type, count(*) AS received, count(*) FILTER (WHERE s = 'inserted') AS inserted, CAST(0 AS BIGINT) AS updated, count(*) FILTER (WHERE s = 'ignored') AS ignored, count(*) FILTER (WHERE s = 'failed') AS failed FROM
 (SELECT event_type, CASE WHEN user_id IS NULL THEN 'failed' WHEN row_number() OVER (PARTITION BY user_id, event_type ORDER BY row_index) = 1 THEN 'inserted' ELSE 'ignored' END AS s FROM {NULL_SQL}) GROUP BY 1""")
def a3(spark, folder):
    """Few keys with very many rows each, and a part of the rows without a key."""
    inc = table(spark, folder, "events").select(
        F.col("event_id").alias("row_index"), F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_type", "value")
    base = inc.drop("row_index").limit(0)
    outcome = load.bulk_load(base, inc, ["user_id", "event_type"], "IGNORE").outcome
    return load.tallies(outcome.join(inc.select("row_index", "event_type"), "row_index"), by=["event_type"])


@G.add("w6_keyed_records", f"SELECT status, count(*) AS n FROM (SELECT CASE WHEN rk = 1 AND NOT stored THEN 'inserted' ELSE 'updated' END AS status FROM {STEP_SQL}) GROUP BY 1")
def w6(spark, folder):
    spec = RecordSpec("order", (FieldSpec("o_orderkey", key=True), FieldSpec("o_custkey"), FieldSpec("o_totalprice")))
    return load.load_records(base_orders(spark, folder), incoming_orders(spark, folder), spec).outcome.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@G.add("w8_insert_select", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def w8(spark, folder):
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    return load.insert_select(base, table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


def _moved(spark, folder):
    source = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return load.move_records(source, source.limit(0), Where().eq("o_orderstatus", "F"), {"o_totalprice": F.col("o_totalprice") * 2})


@G.add("w9_move_target", "SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def w9_target(spark, folder):
    return _moved(spark, folder)[1]


@G.add("w9_move_source", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'")
def w9_source(spark, folder):
    return _moved(spark, folder)[0]


@G.add("a4_update_stats", f"""SELECT (SELECT count(*) FROM customer) AS nodes_created, CAST(0 AS BIGINT) AS nodes_deleted, (SELECT count(*) FROM orders) AS edges_created,
 CAST(0 AS BIGINT) AS edges_deleted, CAST((SELECT count(*) * 2 FROM customer) + (SELECT count(*) FROM orders) AS BIGINT) AS properties_set""")
def a4(spark, folder):
    vertices = table(spark, folder, "customer").select(F.lit("vertex").alias("kind"), F.lit("created").alias("action"), F.lit(2).alias("properties_set"))
    edges = table(spark, folder, "orders").select(F.lit("edge").alias("kind"), F.lit("created").alias("action"), F.lit(1).alias("properties_set"))
    return read.update_stats(vertices.unionByName(edges))


# ---- change capture -------------------------------------------------------------------------
NEW_SQL = "(SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 450000 THEN 'V' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus = 'F' THEN upper(o_orderpriority) || '!' ELSE o_orderpriority END AS o_orderpriority FROM orders)"
DIFF_SQL = f"""SELECT n.o_orderkey, n.o_custkey, n.o_orderstatus, n.o_totalprice, n.o_orderpriority, concat_ws(',', CASE WHEN n.o_custkey IS NOT NULL AND n.o_custkey IS DISTINCT FROM o.o_custkey THEN 'o_custkey' END,
 CASE WHEN n.o_orderstatus IS NOT NULL AND n.o_orderstatus IS DISTINCT FROM o.o_orderstatus THEN 'o_orderstatus' END, CASE WHEN n.o_totalprice IS NOT NULL AND n.o_totalprice IS DISTINCT FROM o.o_totalprice THEN 'o_totalprice' END,
 CASE WHEN n.o_orderpriority IS NOT NULL AND n.o_orderpriority IS DISTINCT FROM o.o_orderpriority THEN 'o_orderpriority' END) AS changed FROM {NEW_SQL} n JOIN orders o ON n.o_orderkey = o.o_orderkey"""


def new_orders(spark, folder):
    return orders(spark, folder).select(
        "o_orderkey", "o_custkey", F.when(F.col("o_totalprice") > 450000, F.lit("V")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.upper("o_orderpriority"), F.lit("!"))).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))


def _diff(spark, folder):
    return change.snapshot_diff(orders(spark, folder), new_orders(spark, folder), ["o_orderkey"])


@G.add("c1_snapshot_diff", f"SELECT * FROM ({DIFF_SQL}) WHERE changed <> ''")
def c1(spark, folder):
    return _diff(spark, folder).withColumn("changed", F.array_join("changed", ","))


@G.add("c1_digest_diff", f"SELECT * FROM ({DIFF_SQL}) WHERE changed <> ''")
def c1_digest(spark, folder):
    """The same changes, of which only the key buckets that differ are joined."""
    return change.digest_diff(orders(spark, folder), new_orders(spark, folder), ["o_orderkey"]).withColumn("changed", F.array_join("changed", ","))


@G.add("c2_changed_params", f"SELECT o_orderkey, unnest(string_split(changed, ',')) AS name, unnest(list_transform(string_split(changed, ','), lambda c: CASE c WHEN 'o_orderstatus' THEN o_orderstatus ELSE o_orderpriority END)) AS value FROM ({DIFF_SQL}) WHERE changed <> ''")
def c2(spark, folder):
    params = change.changed_params(_diff(spark, folder), ["o_orderkey"])
    return params.select("o_orderkey", F.explode("params").alias("name", "v")).select("o_orderkey", "name", F.try_variant_get("v", "$", "string").alias("value"))


@G.add("c3_apply_changes", f"SELECT n.o_orderkey, n.o_custkey, n.o_orderstatus, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, n.o_orderpriority FROM {NEW_SQL} n JOIN orders o ON n.o_orderkey = o.o_orderkey")
def c3(spark, folder):
    return change.apply_changes(orders(spark, folder), _diff(spark, folder), ["o_orderkey"]).snapshot


@G.add("k2_check_readonly", "SELECT o_orderkey, 'o_orderstatus' AS property FROM orders WHERE o_totalprice > 450000 AND o_orderstatus <> 'V'")
def k2(spark, folder):
    from recordlake.operators.quality import check_readonly

    spec = TypeSpec("order", properties=(
        Property("o_orderstatus", constraints=Constraints(readonly=True)), Property("o_custkey", "LONG", Constraints(readonly=True)),
        Property("o_orderpriority")))
    return check_readonly(orders(spark, folder), new_orders(spark, folder), ["o_orderkey"], spec)


# ---- predicates against tables of values, and repeated patches --------------------------------
RICH_SQL = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0)"


def _rich(spark, folder):
    return table(spark, folder, "customer").where("c_mktsegment = 'BUILDING' AND c_acctbal > 0").select("c_custkey")


@G.add("u9_update_in_table", f"SELECT o_orderkey, CASE WHEN o_custkey IN {RICH_SQL} AND o_orderstatus <> 'P' THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def u9_in_table(spark, folder):
    base = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    where = Where().in_list("o_custkey", _rich(spark, folder)).ne("o_orderstatus", "P")
    return update.update_where(base, where, Set().set("o_orderstatus", "X")).select("o_orderkey", "o_orderstatus")


@G.add("u17_delete_in_table", f"SELECT o_orderkey FROM orders WHERE o_custkey IN {RICH_SQL}")
def u17_in_table(spark, folder):
    """Deletes what is not in the table; a second delete names 3 000 keys, most of which are gone."""
    base = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    left = update.delete_where(base, Where().not_in("o_custkey", _rich(spark, folder))).snapshot
    return update.delete_where(left, Where().in_list("o_orderkey", range(-3000, 0))).snapshot.select("o_orderkey")


@G.add("u15_repeated_patch", "SELECT c_custkey, coalesce(p.last_price, c_acctbal) AS c_acctbal, coalesce(p.last_status, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS last_price, arg_max(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS last_status FROM orders GROUP BY 1) p ON o_custkey = c_custkey")
def u15_repeated(spark, folder):
    """Every order patches its customer; patches of one customer are applied in order, each property's last one counts."""
    patches = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("c_mktsegment"), "o_orderkey")
    base = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return update.update_partial(base, patches, "c_custkey", order="o_orderkey").snapshot
