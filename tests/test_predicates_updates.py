import pytest
from pyspark.sql import functions as F

from recordlake.functions.predicates import Where, like_pattern
from recordlake.operators import load, read, update
from recordlake.operators.update import Set


@pytest.fixture
def base(spark):
    return spark.createDataFrame(
        [(1, "a_b", ["x"], 10), (2, "aXb", None, None), (3, "a%b", ["x", "y"], 30), (4, None, [], 40), (5, "a\\b", ["z"], 50)],
        "id int, name string, tags array<string>, n int")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_like_wildcards(base):
    assert like_pattern("a_?%\\") == "a\\__%\\\\"
    assert ids(Where().like("name", "a_b").apply(base)) == [1]
    assert ids(Where().like("name", "a?b").apply(base)) == [1, 2, 3, 5]
    assert ids(Where().like("name", "a\\b").apply(base)) == [5]
    assert ids(Where().ilike("name", "A?B").apply(base)) == [1, 2, 3, 5]


def test_null_rules(base):
    assert ids(Where().not_in("n", [10]).apply(base)) == [3, 4, 5]
    assert ids(Where().not_contains_any("tags", ["x"]).apply(base)) == [4, 5]
    assert ids(Where().contains_all("tags", []).apply(base)) == [1, 3, 4, 5]
    assert ids(Where().between("n", 10, 30).apply(base)) == [1, 3]


def test_empty_builder_and_apply_if(base):
    assert Where().is_empty()
    assert ids(Where().apply_if(None, lambda w, v: w.eq("id", v)).apply(base)) == [1, 2, 3, 4, 5]
    assert ids(Where().apply_if(3, lambda w, v: w.eq("id", v)).apply(base)) == [3]


def test_lists_of_any_length(base, no_broadcast):
    many = list(range(2, 4000))
    assert ids(Where().in_list("id", many).apply(base)) == [2, 3, 4, 5]
    assert ids(Where().not_in("n", [v for v in range(11, 5000)]).apply(base)) == [1]
    assert ids(Where().in_list("id", []).apply(base)) == []


def test_set_rules(base):
    out = update.update_where(base, Where().lte("id", 2), Set().set("n", 1).set("n", 2).append("tags", "p").append("tags", "q"))
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["tags"] == ["x", "p", "q"] and rows[2]["tags"] == ["p", "q"] and rows[2]["n"] == 2
    assert rows[3]["tags"] == ["x", "y"] and rows[3]["n"] == 30
    with pytest.raises(ValueError):
        Set().set("tags", None).append("tags", "p").assignments()


def test_set_opt_keeps_and_set_or_null_clears(base):
    assert Set().set_opt("n", None).is_empty()
    out = {r["id"]: r["n"] for r in update.update_where(base, Where(), Set().set_or_null("n", None)).collect()}
    assert set(out.values()) == {None}


def test_assignments_see_the_old_row(base):
    out = update.update_where(base, Where().eq("id", 1), Set().set_expr("id", "n").set_expr("n", "id"), returning="after").first()
    assert (out["id"], out["n"]) == (10, 1)


def test_append_if_absent_is_idempotent(base):
    step = Set().append_if_absent("tags", "x")
    once = update.update_where(base, Where(), step)
    twice = update.update_where(once, Where(), step)
    assert {r["id"]: r["tags"] for r in once.collect()} == {r["id"]: r["tags"] for r in twice.collect()}


def test_delete_keeps_unknown_rows(base):
    assert ids(update.delete_where(base, Where().gt("n", 0)).snapshot) == [2]
    with pytest.raises(ValueError):
        update.delete_where(base, Where())


def test_upsert_where_needs_a_key(base):
    with pytest.raises(ValueError):
        update.upsert_where(base, {}, Set().set("n", 1))


def test_fetch_and_scalar(base):
    assert read.fetch_one(base.where("id = 3")).first()["name"] == "a%b"
    assert read.fetch_one(base.where("id = 99"), strict=False).count() == 0
    with pytest.raises(Exception, match="no row"):
        read.fetch_one(base.where("id = 99")).collect()
    with pytest.raises(ValueError):
        read.query_scalar(base)
    assert read.query_scalar(base.where("id = 99").select("id")).count() == 0


def test_lookup_needs_a_key(base):
    with pytest.raises(ValueError):
        read.lookup_by_key(base, {})
    assert read.lookup_by_key(base, {"id": 2}).count() == 1


def test_batches_count_the_stopping_one(spark):
    df = spark.range(10).select("id", F.lit(1).alias("v"))
    rows, summary = read.consume_batches(df, ["id"], 3, F.max("id") >= 4)
    s = summary.first()
    assert (s["batches"], s["rows"], s["is_last"], s["truncated"]) == (2, 6, False, True)
    assert rows.count() == 6
    _, whole = read.consume_batches(df, ["id"], 3, F.lit(False) & (F.max("id") > 99))
    w = whole.first()
    assert (w["batches"], w["rows"], w["is_last"], w["truncated"]) == (4, 10, True, False)
    _, none = read.consume_batches(df.where("id < 0"), ["id"], 3, F.max("id") > 99)
    assert none.first()["batches"] == 0


def test_pages_cover_everything(spark):
    df = spark.range(25)
    pages = [[r["id"] for r in p.collect()] for p in read.iterate_pages(df, "id", 10)]
    assert [i for p in pages for i in p] == list(range(25)) and [len(p) for p in pages] == [10, 10, 5]


def test_a_null_in_a_list_means_one_thing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    for more in (0, 3000):
        values = [None, 1, *range(10, 10 + more)]
        frame = spark.createDataFrame([(v,) for v in values], "x int")
        for given in (values, frame):
            assert [r["id"] for r in Where().in_list("id", given).apply(df).collect()] == [1]
            assert Where().not_in("id", given).apply(df).count() == 0


def test_long_lists_in_writes(spark):
    df = spark.range(20).withColumn("v", F.lit("old"))
    values = [3, 4, *range(100, 3000)]
    for given in (values, spark.createDataFrame([(v,) for v in values], "x bigint")):
        where = Where().in_list("id", given)
        got = update.update_where(df, where, Set().set("v", "new"))
        assert got.columns == ["id", "v"] and sorted(r["id"] for r in got.where("v = 'new'").collect()) == [3, 4]
        assert update.update_where(df, where, Set().set("v", "new"), "count").first()["affected"] == 2
        result = update.delete_where(df, where)
        assert result.snapshot.count() == 18 and result.outcome.first()["deleted"] == 2 and result.snapshot.columns == ["id", "v"]
        stay, target = load.move_records(df, df.limit(0), where, {})
        assert stay.count() == 18 and target.count() == 2


def test_raw_values_are_put_in_once(spark):
    df = spark.createDataFrame([("x",)], "v string")
    got = update.update_where(df, Where(), Set().set_raw("v", "concat(v, :ab, :a, ':a', \":ab\")", a="1:ab'", ab=":a"))
    assert got.first()["v"] == "x:a1:ab':a:ab"


def test_repeated_patches(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, s string, n int")
    patches = spark.createDataFrame([(1, "x", None, 1), (1, None, 9, 2), (1, "y", None, 3)], "id int, s string, n int, at int")
    got = update.update_partial(base, patches, "id", order="at").snapshot
    assert sorted(map(tuple, got.collect())) == [(1, "y", 9), (2, "b", 2), (3, "c", 3)]
    new = update.replace_content(base, patches, ["id"], order="at")
    assert sorted(map(tuple, new.collect())) == [(1, "y", None), (2, "b", 2), (3, "c", 3)]
    for call in (lambda: update.update_partial(base, patches.drop("at"), "id").snapshot, lambda: update.replace_content(base, patches.drop("at"), ["id"])):
        with pytest.raises(Exception, match="more than one incoming row"):
            call().collect()


def test_patches_without_a_place_fail(spark):
    base = spark.createDataFrame([(1, "a")], "id int, s string")
    patches = spark.createDataFrame([(1, "x", None)], "id int, s string, at int")
    result = update.update_partial(base, patches, "id", order="at")
    for got in (result.snapshot, result.outcome, update.replace_content(base, patches, ["id"], order="at")):
        with pytest.raises(Exception, match="an incoming row has no at"):
            got.collect()


def test_pages_lose_no_row_of_a_repeated_or_null_key(spark):
    df = spark.range(120).select(F.when(F.col("id") < 100, F.col("id") % 5).alias("k"), F.when(F.col("id") < 60, F.col("id")).alias("v"))
    pages = [p.collect() for p in read.iterate_pages(df, "k", 7)]
    rows = [tuple(r) for p in pages for r in p]
    assert len(rows) == 120 and all(len(p) == 7 for p in pages[:-1])
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(rows, key=key) == sorted((tuple(r) for r in df.collect()), key=key)
    assert [r[0] for r in rows] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))


def test_time_limit_ends_with_its_action(spark):
    from recordlake.sources.tables import within_time

    assert within_time(spark, 60_000, spark.range(10).count) == 10
    endless = spark.range(0, 10 ** 15, 1, 4).select(F.sum(F.hash("id")))
    with pytest.raises(Exception, match="(?i)cancel"):
        within_time(spark, 1_000, endless.collect)
    assert spark.range(5).count() == 5
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_lookup_picks_a_row_with_maps(spark):
    df = spark.sql("select 1 as k, map('a', 1) as m, parse_json('{\"x\": 1}') as v union all select 1, map('b', 2), parse_json('2') union all select 2, null, null")
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    got = {r["k"]: r for r in read.lookup_by_key(df, keys, ["k"]).select("k", "m", "found").collect()}
    assert got[1]["m"] in ({"a": 1}, {"b": 2}) and got[2]["found"] and got[2]["m"] is None and not got[3]["found"]
