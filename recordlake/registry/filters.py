"""One registered query per predicate."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlake.functions.predicates import Where
from recordlake.registry.base import Group, table

G = Group()


def _simple(name: str, source: str, columns: list[str], build, where_sql: str) -> None:
    cols = ", ".join(columns)

    def run(spark, folder):
        return build(spark, folder).apply(table(spark, folder, source)).select(*columns)

    G.add(name, f"SELECT {cols} FROM {source} WHERE {where_sql}")(run)


ORDER = ["o_orderkey", "o_totalprice"]
_simple("f1_eq", "orders", ORDER, lambda s, d: Where().eq("o_orderstatus", "F"), "o_orderstatus = 'F'")
_simple("f2_ne", "orders", ORDER, lambda s, d: Where().ne("o_orderstatus", "F"), "o_orderstatus <> 'F'")
_simple("f3_lt", "orders", ORDER, lambda s, d: Where().lt("o_totalprice", 100000), "o_totalprice < 100000")
_simple("f4_lte", "orders", ORDER, lambda s, d: Where().lte("o_totalprice", 150000), "o_totalprice <= 150000")
_simple("f5_gt", "orders", ORDER, lambda s, d: Where().gt("o_totalprice", 400000), "o_totalprice > 400000")
_simple("f6_gte", "orders", ORDER, lambda s, d: Where().gte("o_totalprice", 350000), "o_totalprice >= 350000")
_simple("f7_between", "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"], lambda s, d: Where().between("l_quantity", 10, 20), "l_quantity BETWEEN 10 AND 20")
_simple("f10_in_list", "part", ["p_partkey", "p_brand"], lambda s, d: Where().in_list("p_brand", ["Brand#2", "Brand#11", "Brand#17"]), "p_brand IN ('Brand#2', 'Brand#11', 'Brand#17')")
_simple("f11_not_in", "part", ["p_partkey", "p_brand"], lambda s, d: Where().not_in("p_brand", ["Brand#2", "Brand#11", "Brand#17"]), "p_brand NOT IN ('Brand#2', 'Brand#11', 'Brand#17')")
_simple("f10_in_table", "events", ["event_id"], lambda s, d: Where().in_list("user_id", table(s, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")),
        "user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
_simple("f11_not_in_table", "events", ["event_id"], lambda s, d: Where().not_in("user_id", table(s, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")),
        "user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
_simple("f17_like", "part", ["p_partkey", "p_name"], lambda s, d: Where().like("p_name", "r?d%"), "p_name LIKE 'r_d%'")
_simple("f18_ilike", "part", ["p_partkey", "p_type"], lambda s, d: Where().ilike("p_type", "?co%y"), "p_type ILIKE '_co%y'")
_simple("f19_raw", "lineitem", ["l_orderkey", "l_linenumber"], lambda s, d: Where().filter("l_tax > l_discount AND l_quantity < 25"), "l_tax > l_discount AND l_quantity < 25")
_simple("f20_filter_when", "orders", ORDER, lambda s, d: Where().eq("o_orderstatus", "O").filter_when(True, "o_totalprice > 200000").filter_when(False, "o_orderkey < 0"),
        "o_orderstatus = 'O' AND o_totalprice > 200000")
_simple("f21_apply_if", "orders", ORDER, lambda s, d: Where().apply_if("P", lambda w, v: w.eq("o_orderstatus", v).gt("o_totalprice", 1000)).apply_if(None, lambda w, v: w.eq("o_orderkey", v)),
        "o_orderstatus = 'P' AND o_totalprice > 1000")

# A column with real nulls: the quality label, known for part of the documents only.
LABELLED = "(SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def _labelled(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "lang").join(
        table(spark, folder, "labels").select("doc_id", "quality"), ["doc_id"], "left")


@G.add("f8_is_null", f"SELECT doc_id, lang FROM {LABELLED} WHERE quality IS NULL")
def f8(spark, folder):
    return Where().is_null("quality").apply(_labelled(spark, folder)).select("doc_id", "lang")


@G.add("f9_is_not_null", f"SELECT doc_id, quality FROM {LABELLED} WHERE quality IS NOT NULL")
def f9(spark, folder):
    return Where().is_not_null("quality").apply(_labelled(spark, folder)).select("doc_id", "quality")


@G.add("f11_not_in_nulls", f"SELECT doc_id FROM {LABELLED} WHERE quality NOT IN (1, 7)")
def f11_nulls(spark, folder):
    return Where().not_in("quality", [1, 7]).apply(_labelled(spark, folder)).select("doc_id")


# Collections: the words of every turn; a set: the same without repeats.
WORDS = r"(SELECT conv_id, turn, role, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS words FROM conversations)"
WANTED = ["the", "of", "and"]


def _turns(spark, folder, distinct: bool = False):
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", (F.array_distinct(words) if distinct else words).alias("words"))


def _collection(name: str, build, test_sql: str, distinct: bool = False) -> None:
    def run(spark, folder):
        return build(Where()).apply(_turns(spark, folder, distinct)).select("conv_id", "turn")

    G.add(name, f"SELECT conv_id, turn FROM {WORDS} WHERE {test_sql}")(run)


_collection("f12_contains", lambda w: w.contains("words", "the"), "list_contains(words, 'the')")
_collection("f13_contains_all", lambda w: w.contains_all("words", WANTED), "list_has_all(words, ['the', 'of', 'and'])")
_collection("f14_contains_any", lambda w: w.contains_any("words", WANTED), "list_has_any(words, ['the', 'of', 'and'])")
_collection("f15_not_contains_any", lambda w: w.not_contains_any("words", WANTED), "NOT list_has_any(words, ['the', 'of', 'and'])")
_collection("f16_set_contains_all", lambda w: w.contains_all("words", WANTED), "list_has_all(list_distinct(words), ['the', 'of', 'and'])", distinct=True)
_collection("f16_set_contains_any", lambda w: w.contains_any("words", WANTED), "list_has_any(list_distinct(words), ['the', 'of', 'and'])", distinct=True)


@G.add("f12_contains_nested", "SELECT doc_id FROM documents WHERE (lang = 'en' AND source = 'src7') OR (source = 'en' AND lang = 'src7')")
def f12_nested(spark, folder):
    """A list on the right is one nested element: [lang, source] inside a list of lists."""
    pairs = F.array(F.array("lang", "source"), F.array("source", "lang"))
    docs = table(spark, folder, "documents").select("doc_id", pairs.alias("pairs"))
    return Where().contains("pairs", ["en", "src7"]).apply(docs).select("doc_id")


@G.add("f22_intrinsics", "SELECT '#9:' || l_orderkey AS \"@out\", '#8:' || l_partkey AS \"@in\", l_quantity FROM lineitem WHERE l_partkey <> 7 AND l_quantity > 25")
def f22(spark, folder):
    """Intrinsic columns are ordinary filter columns."""
    edges = table(spark, folder, "lineitem").select(
        F.concat(F.lit("#9:"), F.col("l_orderkey").cast("string")).alias("@out"),
        F.concat(F.lit("#8:"), F.col("l_partkey").cast("string")).alias("@in"), "l_quantity")
    return Where().is_not_null("@out").ne("@in", "#8:7").gt("l_quantity", 25).apply(edges)


def _null_list(spark, folder, wanted: bool, length: int):
    """A list with a null follows one rule at any length; the values beyond 7 are in no row."""
    values = [None, 1, 7, *range(100, 100 + length)]
    where = Where().in_list("quality", values) if wanted else Where().not_in("quality", values)
    rows = where.apply(_labelled(spark, folder)).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.lit("in" if wanted else "not in").alias("form"), F.lit(length).cast("bigint").alias("more"), "n")


@G.add("f11_not_in_null_list", f"SELECT f.form, m.more, CASE WHEN f.form = 'in' THEN n_in ELSE n_out END AS n FROM (VALUES ('in'), ('not in')) f(form), (VALUES (CAST(5 AS BIGINT)), (1500)) m(more), (SELECT count(*) FILTER (WHERE quality IN (1, 7, NULL)) AS n_in, count(*) FILTER (WHERE quality NOT IN (1, 7, NULL)) AS n_out FROM {LABELLED})")
def f11_null_list(spark, folder):
    parts = [_null_list(spark, folder, wanted, length) for wanted in (True, False) for length in (5, 1500)]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@G.add("f11_not_in_null_table", f"SELECT doc_id FROM {LABELLED} WHERE quality NOT IN (SELECT CASE WHEN l_linenumber > 1 THEN l_linenumber END FROM lineitem)")
def f11_null_table(spark, folder):
    """A null in a table of values lets no row through either."""
    values = table(spark, folder, "lineitem").select(F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("v"))
    return Where().not_in("quality", values).apply(_labelled(spark, folder)).select("doc_id")
