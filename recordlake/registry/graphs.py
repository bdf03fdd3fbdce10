"""Graph load, edges, neighbours, patterns, traversal."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.operators import graph
from recordlake.registry.base import Group, table
from recordlake.session import work_path
from recordlake.sources.ranged import RangedTable

G = Group()

RECORDS_SQL = """(SELECT CAST(n_nationkey AS BIGINT) AS seq, 'vertex' AS kind, 'n' || n_nationkey AS temp_id, NULL AS from_ref, NULL AS to_ref FROM nation
 UNION ALL SELECT 1000 + c_custkey, 'vertex', 'c' || c_custkey, NULL, NULL FROM customer
 UNION ALL SELECT 1000000000000 + c_custkey, 'edge', NULL, 'c' || c_custkey, 'n' || c_nationkey FROM customer
 UNION ALL SELECT 2000000000000 + o_orderkey, 'edge', NULL, 'c' || o_custkey, 'o' || o_orderkey FROM orders)"""


def graph_records(spark, folder):
    """Nations and customers as vertices, membership edges, and edges to orders that were not loaded."""
    def text(prefix, c):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    def rows(df, seq, kind, type_name, temp=None, start=None, end=None):
        none = F.lit(None).cast("string")
        return df.select(seq.cast("bigint").alias("seq"), F.lit(kind).alias("kind"), F.lit(type_name).alias("type"),
                         (temp if temp is not None else none).alias("temp_id"), (start if start is not None else none).alias("from_ref"),
                         (end if end is not None else none).alias("to_ref"))

    nation, customer, orders = (table(spark, folder, n) for n in ("nation", "customer", "orders"))
    return (
        rows(nation, F.col("n_nationkey"), "vertex", "nation", text("n", "n_nationkey"))
        .unionByName(rows(customer, F.col("c_custkey") + 1000, "vertex", "customer", text("c", "c_custkey")))
        .unionByName(rows(customer, F.col("c_custkey") + 1000000000000, "edge", "member", None, text("c", "c_custkey"), text("n", "c_nationkey")))
        .unionByName(rows(orders, F.col("o_orderkey") + 2000000000000, "edge", "placed", None, text("c", "o_custkey"), text("o", "o_orderkey")))
    )


@G.add("g1_graph_load", "SELECT 'c' || c_custkey AS source, 'n' || c_nationkey AS target FROM customer")
def g1(spark, folder):
    """Loaded edges, with their rids taken back to the temporary ids."""
    loaded = graph.graph_load(graph_records(spark, folder))
    back = loaded.id_map
    edges = graph.expand(loaded.edges.select("out", "in"), "out", back.select("rid", F.col("temp_id").alias("source")))
    return graph.expand(edges, "in", back.select("rid", F.col("temp_id").alias("target"))).select("source", "target")


@G.add("g1_outcome", f"SELECT kind, CASE WHEN seq >= 2000000000000 THEN 'failed' ELSE 'created' END AS action, CASE WHEN seq >= 2000000000000 THEN 'unresolved_ref' END AS code, count(*) AS n FROM {RECORDS_SQL} GROUP BY ALL")
def g1_outcome(spark, folder):
    return graph.graph_load(graph_records(spark, folder)).outcome.groupBy("kind", "action", "code").agg(F.count(F.lit(1)).alias("n"))


EDGE_SQL = "(SELECT event_id AS row_index, user_id AS \"out\", CAST(props->>'$.k' AS BIGINT) AS \"in\", CASE WHEN event_type <> 'error' THEN value END AS weight, CASE WHEN event_type = 'click' THEN event_type END AS label FROM events)"
VIEW_SQL = "(SELECT user_id AS \"out\", CAST(props->>'$.k' AS BIGINT) AS \"in\", max(value) AS weight, 'seen' AS label FROM events WHERE event_type = 'view' GROUP BY 1, 2)"


def user_edges(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("row_index"), F.col("user_id").alias("out"), F.get_json_object("props", "$.k").cast("bigint").alias("in"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("weight"), F.when(F.col("event_type") == "click", F.col("event_type")).alias("label"))


@G.add("g2_upsert_edge", f"""SELECT coalesce(b."out", i."out") AS "out", coalesce(b."in", i."in") AS "in", coalesce(i.weight, b.weight) AS weight, coalesce(i.label, b.label) AS label FROM {VIEW_SQL} b FULL JOIN
 (SELECT "out", "in", arg_max(weight, row_index) FILTER (WHERE weight IS NOT NULL) AS weight, arg_max(label, row_index) FILTER (WHERE label IS NOT NULL) AS label FROM {EDGE_SQL} GROUP BY 1, 2) i ON b."out" = i."out" AND b."in" = i."in" """)
def g2(spark, folder):
    views = table(spark, folder, "events").where("event_type = 'view'")
    base = views.groupBy(F.col("user_id").alias("out"), F.get_json_object("props", "$.k").cast("bigint").alias("in")).agg(
        F.max("value").alias("weight"), F.lit("seen").alias("label"))
    return graph.upsert_edges(base, user_edges(spark, folder)).snapshot


@G.add("g2_ranged_edges", f"""SELECT coalesce(b."out", i."out") AS "out", coalesce(b."in", i."in") AS "in", coalesce(i.weight, b.weight) AS weight, coalesce(i.label, b.label) AS label FROM {VIEW_SQL} b FULL JOIN
 (SELECT "out", "in", arg_max(weight, row_index) FILTER (WHERE weight IS NOT NULL) AS weight, arg_max(label, row_index) FILTER (WHERE label IS NOT NULL) AS label FROM {EDGE_SQL} GROUP BY 1, 2) i ON b."out" = i."out" AND b."in" = i."in" """)
def g2_ranged(spark, folder):
    """The same edges upserted into a stored table in the order of their ends."""
    views = table(spark, folder, "events").where("event_type = 'view'")
    base = views.groupBy(F.col("user_id").alias("out"), F.get_json_object("props", "$.k").cast("bigint").alias("in")).agg(
        F.max("value").alias("weight"), F.lit("seen").alias("label"))
    edges = RangedTable(spark, work_path(spark, "edges"), ["out", "in"], base.schema, rows_per_file=20_000)
    edges.create(base)
    graph.upsert_stored_edges(edges, user_edges(spark, folder))
    return edges.read()


@G.add("g3_create_edges", "SELECT c_custkey AS \"out\", r_regionkey AS \"in\" FROM customer, region")
def g3(spark, folder):
    return graph.create_edges(table(spark, folder, "customer"), table(spark, folder, "region"), "c_custkey", "r_regionkey")


def placed(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_custkey").alias("out"), F.col("o_orderkey").alias("in"))


def building(spark, folder):
    return table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("rid"))


@G.add("g4_out", "SELECT o_custkey AS source, o_orderkey AS neighbour, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def g4_out(spark, folder):
    target = table(spark, folder, "orders").select(F.col("o_orderkey").alias("rid"), "o_totalprice")
    return graph.out(building(spark, folder), placed(spark, folder), target)


@G.add("g4_in", "SELECT o_orderkey AS source, o_custkey AS neighbour FROM orders WHERE o_totalprice > 300000")
def g4_in(spark, folder):
    large = table(spark, folder, "orders").where("o_totalprice > 300000").select(F.col("o_orderkey").alias("rid"))
    return graph.in_(large, placed(spark, folder))


SUPPLY_SQL = "(SELECT DISTINCT 's' || l_suppkey AS \"out\", 'p' || l_partkey AS \"in\" FROM lineitem)"


def supply(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("out"), F.concat(F.lit("p"), F.col("l_partkey")).alias("in")).distinct()


CHOSEN_SQL = "(SELECT 's' || s_suppkey FROM supplier WHERE s_acctbal > 5000 UNION ALL SELECT 'p' || p_partkey FROM part WHERE p_brand = 'Brand#2')"


@G.add("g4_both", f"SELECT \"out\" AS source, \"in\" AS neighbour FROM {SUPPLY_SQL} WHERE \"out\" IN {CHOSEN_SQL} UNION ALL SELECT \"in\", \"out\" FROM {SUPPLY_SQL} WHERE \"in\" IN {CHOSEN_SQL}")
def g4_both(spark, folder):
    suppliers = table(spark, folder, "supplier").where("s_acctbal > 5000").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("rid"))
    parts = table(spark, folder, "part").where("p_brand = 'Brand#2'").select(F.concat(F.lit("p"), F.col("p_partkey")).alias("rid"))
    return graph.both(suppliers.unionByName(parts), supply(spark, folder))


@G.add("g5_out_e", "SELECT o_custkey AS \"out\", o_orderkey AS \"in\" FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def g5(spark, folder):
    return graph.out_e(building(spark, folder), placed(spark, folder))


@G.add("g5_expand", "SELECT l_orderkey, l_partkey AS part, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey")
def g5_expand(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_partkey").alias("part"))
    return graph.expand(lines, "part", table(spark, folder, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey").select("l_orderkey", "part", "p_name", "p_brand")


@G.add("g6_delete_incident", "SELECT o_custkey AS \"out\", o_orderkey AS \"in\" FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'")
def g6(spark, folder):
    """Order ids share numbers with customer ids here, so both ends carry a prefix."""
    edges = placed(spark, folder).select(F.concat(F.lit("c"), F.col("out")).alias("out"), F.concat(F.lit("o"), F.col("in")).alias("in"))
    gone = building(spark, folder).select(F.concat(F.lit("c"), F.col("rid")).alias("rid"))
    kept = graph.delete_incident(edges, gone).snapshot
    return kept.select(F.substring_index("out", "c", -1).cast("bigint").alias("out"), F.substring_index("in", "o", -1).cast("bigint").alias("in"))


@G.add("g7_match_path", """SELECT c_custkey AS a_rid, o_orderkey AS o_rid, p_partkey AS p_rid, p_name, l_quantity AS p_e_qty FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
 JOIN part ON l_partkey = p_partkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F' AND p_brand = 'Brand#2' AND l_quantity > 25""")
def g7(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("rid"), F.col("o_orderstatus").alias("status"))
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("rid"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    contains = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("out"), F.col("l_partkey").alias("in"), F.col("l_quantity").alias("qty"))
    paths = graph.match_path(building(spark, folder), [
        graph.Hop(placed(spark, folder), "out", orders, "o", where=F.col("status") == "F"),
        graph.Hop(contains, "out", parts, "p", where=F.col("brand") == "Brand#2", edge_where=F.col("qty") > 25)])
    return paths.select("a_rid", "o_rid", "p_rid", "p_name", "p_e_qty")


@G.add("g8_traverse", f"""WITH e AS (SELECT "out" AS a, "in" AS b FROM {SUPPLY_SQL} UNION ALL SELECT "in", "out" FROM {SUPPLY_SQL}), d0 AS (SELECT 's1' AS rid, 0 AS depth),
 d1 AS (SELECT DISTINCT b AS rid, 1 AS depth FROM e JOIN d0 ON a = d0.rid WHERE b NOT IN (SELECT rid FROM d0)), v1 AS (SELECT * FROM d0 UNION ALL SELECT * FROM d1),
 d2 AS (SELECT DISTINCT b AS rid, 2 AS depth FROM e JOIN d1 ON a = d1.rid WHERE b NOT IN (SELECT rid FROM v1)), v2 AS (SELECT * FROM v1 UNION ALL SELECT * FROM d2),
 d3 AS (SELECT DISTINCT b AS rid, 3 AS depth FROM e JOIN d2 ON a = d2.rid WHERE b NOT IN (SELECT rid FROM v2)) SELECT * FROM v2 UNION ALL SELECT * FROM d3""")
def g8(spark, folder):
    return graph.traverse(spark.createDataFrame([("s1",)], "rid string"), supply(spark, folder), 3, direction="both")


@G.add("g9_bidirectional", f"SELECT \"out\", \"in\", 'out' AS direction FROM {SUPPLY_SQL} UNION ALL SELECT \"in\", \"out\", 'in' FROM {SUPPLY_SQL}")
def g9(spark, folder):
    return graph.bidirectional(supply(spark, folder))
