"""Scans, lookups, batches, bound queries, aggregates, order and limit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.functions.predicates import Where
from recordlake.model import TypeSet, TypeSpec
from recordlake.operators import read
from recordlake.registry.base import Group, table
from recordlake.session import work_path
from recordlake.sources import tables as src

G = Group()

PARTY_SQL = """SELECT 'customer' AS type, c_custkey AS party_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
 c_mktsegment AS segment FROM customer
 UNION ALL SELECT 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""


def party(spark, folder) -> TypeSet:
    """An abstract type over two tables; only customers have a segment."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"))
    return (
        TypeSet().add(TypeSpec("party", "VERTEX"))
        .add(TypeSpec("customer", "VERTEX", ("party",)), customer)
        .add(TypeSpec("supplier", "VERTEX", ("party",)), supplier)
    )


@G.add("s1_scan_type", PARTY_SQL)
def s1(spark, folder):
    return src.scan_type(party(spark, folder), "party")


@G.add("s2_scan_bucket", "SELECT o_orderkey % 8 AS bucket, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1")
def s2(spark, folder):
    """A table written by bucket; each bucket is scanned alone (partition pruned), then put side by side."""
    path = work_path(spark, "buckets")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    src.write_buckets(orders, path, ["o_orderkey"], 8, bucket_of=F.pmod("o_orderkey", F.lit(8)))
    stored = spark.read.parquet(path)
    parts = [
        src.scan_bucket(stored, b).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
        .select(F.lit(b).cast("bigint").alias("bucket"), "n", "low", "high")
        for b in range(8)
    ]
    return reduce(DataFrame.unionByName, parts)


@G.add("s3_scan_type_bound", f"SELECT * FROM ({PARTY_SQL}) WHERE balance > 5000 AND nation BETWEEN 3 AND 17")
def s3(spark, folder):
    return src.scan_type(party(spark, folder), "party", Where().gt("balance", 5000).between("nation", 3, 17))


@G.add("s4_lookup_by_key", """SELECT k.l_orderkey, k.l_linenumber, l.price, l.l_orderkey IS NOT NULL AS found FROM
 (SELECT DISTINCT o_orderkey AS l_orderkey, CAST(n_regionkey + 1 AS INTEGER) AS l_linenumber FROM orders
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) k
 LEFT JOIN (SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2) l
 ON k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber""")
def s4(spark, folder):
    """A composite-key lookup for one line of every order."""
    keys = (
        table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("o_orderkey").alias("l_orderkey"), (F.col("n_regionkey") + 1).cast("int").alias("l_linenumber"))
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    return read.lookup_by_key(lines, keys, ["l_orderkey", "l_linenumber"], order="price")


@G.add("s5_lookup_by_rid", """WITH r AS (SELECT '#1:' || c_custkey AS rid, c_name AS name FROM customer)
 SELECT a.rid, r.name, r.rid IS NOT NULL AS found FROM
 (SELECT '#1:' || user_id AS rid FROM events UNION ALL SELECT '#2:' || user_id FROM events) a LEFT JOIN r ON a.rid = r.rid""")
def s5(spark, folder):
    def rid(bucket, c):
        return F.concat(F.lit(f"#{bucket}:"), F.col(c).cast("string")).alias("rid")

    people = table(spark, folder, "customer").select(rid(1, "c_custkey"), F.col("c_name").alias("name"))
    events = table(spark, folder, "events")
    return read.lookup_by_rid(people, events.select(rid(1, "user_id")).union(events.select(rid(2, "user_id"))))


@G.add("s6_count_type", f"SELECT count(*) AS n FROM ({PARTY_SQL})")
def s6(spark, folder):
    return src.count_type(party(spark, folder), "party")


@G.add("s7_query_scalar", "SELECT max(o_totalprice) AS top FROM orders")
def s7(spark, folder):
    return read.query_scalar(table(spark, folder, "orders").agg(F.max("o_totalprice").alias("top")))


@G.add("s8_fetch_one", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def s8(spark, folder):
    best = table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return read.fetch_one(best)


BATCH_SQL = """WITH n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_no FROM events),
 b AS (SELECT row_no // 1000 AS batch_no, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS v FROM n GROUP BY 1),
 s AS (SELECT min(batch_no) AS stop_at FROM b WHERE v > 51000)"""


def _batches(spark, folder):
    stop = F.sum(F.col("value").cast("decimal(18,2)")) > 51000
    return read.consume_batches(table(spark, folder, "events").select("event_id", "value"), ["event_id"], 1000, stop, unique=True)


@G.add("s9_consume_batches", BATCH_SQL + """ SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) AS BIGINT) AS running_total,
 max(batch_no) = (SELECT max(batch_no) FROM b) AS is_last, (SELECT stop_at FROM s) IS NOT NULL AS truncated
 FROM b WHERE batch_no <= coalesce((SELECT stop_at FROM s), 1000000000000)""")
def s9(spark, folder):
    return _batches(spark, folder)[1]


@G.add("s9_batch_rows", BATCH_SQL + """ SELECT batch_no, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM
 (SELECT row_no // 1000 AS batch_no, event_id FROM n) WHERE batch_no <= coalesce((SELECT stop_at FROM s), 1000000000000) GROUP BY 1""")
def s9_rows(spark, folder):
    return _batches(spark, folder)[0].groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@G.add("s11_cursor", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s11(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@G.add("s12_materialize_all", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s12(spark, folder):
    return read.materialized(table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


@G.add("s13_keyset_page", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 250")
def s13(spark, folder):
    return read.read_pages(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 250, last=5000)


@G.add("s13_offset_page", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 250 OFFSET 500")
def s13_offset(spark, folder):
    return read.read_pages(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 250, mode="offset", page=2)


@G.add("s14_read_records", "SELECT '#3:' || event_id AS rid, event_type AS type, k.key AS key, json_extract_string(props, '$.' || k.key) AS value FROM events, unnest(json_keys(props)) AS k(key)")
def s14(spark, folder):
    rid = F.concat(F.lit("#3:"), F.col("event_id").cast("string"))
    records = src.read_records(table(spark, folder, "events"), "props", rid, F.col("event_type"))
    return records.select("rid", "type", F.explode("properties").alias("key", "v")).select(
        "rid", "type", "key", F.try_variant_get("v", "$", "string").alias("value"))


REVENUE = """SELECT n_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
 count(DISTINCT o_orderkey) AS orders FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
 JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = {segment} AND o_orderdate >= CAST({start} AS TIMESTAMP)
 AND o_orderdate < CAST({stop} AS TIMESTAMP) GROUP BY n_name"""


@G.add("q1_query_bound", REVENUE.format(segment="'BUILDING'", start="'1996-01-01'", stop="'1998-01-01'"))
def q1(spark, folder):
    """Revenue per nation for a bound market segment and date range."""
    text = REVENUE.format(segment=":segment", start=":start", stop=":stop")
    for name in ("customer", "orders", "lineitem", "nation"):
        text = text.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    frames = {n: table(spark, folder, n) for n in ("customer", "orders", "lineitem", "nation")}
    return src.query_bound(spark, text, {"segment": "BUILDING", "start": "1996-01-01", "stop": "1998-01-01"}, **frames)


@G.add("a1_count", "SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10")
def a1(spark, folder):
    return Where().eq("l_returnflag", "R").gte("l_quantity", 10).apply(table(spark, folder, "lineitem")).agg(F.count(F.lit(1)).alias("n"))


@G.add("a2_scalar_bounds", "SELECT min(l_shipdate) AS low, max(l_shipdate) AS high FROM lineitem")
def a2(spark, folder):
    return read.scalar_bounds(table(spark, folder, "lineitem"), "l_shipdate")


@G.add("l1_order_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def l1(spark, folder):
    return read.order_limit(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20)


@G.add("l2_limit_skip", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def l2(spark, folder):
    return read.order_limit(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 20, skip=40)


@G.add("l2_deep_skip", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 500 OFFSET (SELECT count(*) // 2 FROM lineitem)")
def l2_deep(spark, folder):
    """Half the table down: only the range around the place is sorted."""
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    order = [read.By("l_extendedprice", descending=True), "l_orderkey", "l_linenumber"]
    return read.rows_at(rows, order, rows.count() // 2, 500, most=2000)


@G.add("s9_ranged_stop", BATCH_SQL + """ SELECT batch_no, count(*) AS n, min(event_id) AS low, max(event_id) AS high FROM
 (SELECT row_no // 1000 AS batch_no, event_id FROM n) WHERE batch_no <= coalesce((SELECT stop_at FROM s), 1000000000000) GROUP BY 1""")
def s9_ranged(spark, folder):
    """Batches of 1000 rows from ranges of about 1500."""
    stop = F.sum(F.col("value").cast("decimal(18,2)")) > 51000
    rows = table(spark, folder, "events").select("event_id", "value")
    taken = read.consume_batches(rows, ["event_id"], 1000, stop, unique=True, rows_per_range=1500)[0]
    return taken.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"), F.max("event_id").alias("high"))


@G.add("l3_latest_row", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def l3(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return read.latest_row(events, ["user_id", "event_type"], "ts", "event_id").drop("ts")


@G.add("s13_all_pages", "SELECT o_custkey % 50 AS k, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def s13_all(spark, folder):
    """All pages together are all rows, on a key with few values of which one is null."""
    orders = table(spark, folder, "orders").select(F.nullif(F.col("o_custkey") % 50, F.lit(7)).alias("k"), "o_orderkey")
    pages = list(read.iterate_pages(orders, "k", max(1, orders.count() // 3)))
    whole = pages[0]
    for page in pages[1:]:
        whole = whole.union(page)
    return whole.groupBy(F.coalesce("k", F.lit(7)).cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
