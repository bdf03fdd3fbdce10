"""Stored postings: rows of the plain searches, folders that are read, ranges that are left out."""

import random

from pyspark.sql import functions as F

from recordlake.operators import postings, search
from recordlake.session import work_path


def documents(spark, n=900):
    rng = random.Random(4)
    common = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        t = [rng.choice(common) for _ in range(rng.choice([3, 5, 8, 200, 300]))]
        if i % 90 == 0:
            t = ["rare", "w1", "rare"]
        rows.append((i, " ".join(t)))
    return spark.createDataFrame(rows + [(n, None), (n + 1, ""), (n + 2, "Rare, RARE; rare!")], "doc_id long, text string")


def test_text_index(spark):
    docs = documents(spark)
    root = work_path(spark, "text")
    index = postings.TextIndex.build(docs, root, range_rows=50)
    for query, k in ((["rare", "w1"], 5), (["w1", "W2", "w3"], 12), (["none"], 3), (["rare"], 100)):
        want = [tuple(r) for r in search.full_text(docs, query, k).orderBy("rank").collect()]
        assert [tuple(r) for r in index.search(query, k).orderBy("rank").collect()] == want
    index.search(["rare", "w1"], 5)
    report = index.postings.report
    assert report["postings_scored"] < report["postings"] / 2 and report["ranges_scored"] < report["ranges"]
    # A second reader opens the folders of its terms and no others.
    again = postings.TextIndex(spark, root)
    mine = again.postings.blocks(["rare", "w1"])
    plan = mine._jdf.queryExecution().executedPlan().toString()
    asked = {postings._folder_of(spark, t) for t in ("rare", "w1")}
    assert "PartitionFilters: [folder" in plan and "PushedFilters: [In(term, [rare,w1])]" in plan
    assert {r["folder"] for r in mine.select("folder").distinct().collect()} == asked
    assert spark.read.parquet(f"{root}/blocks").select("folder").distinct().count() > 10


def test_sparse_index(spark):
    rng = random.Random(9)
    rows = []
    for i in range(700):
        t = rng.sample(range(30), rng.randint(0, 6))
        scale = 50.0 if i % 100 == 0 else 1.0
        rows.append((i, [f"t{x}" for x in t], [round(scale * rng.uniform(-1, 2), 3) for _ in t]))
    rows += [(900, None, None), (901, ["t1", "t1"], [5.0, 6.0]), (902, ["t1"], [None])]
    vectors = spark.createDataFrame(rows, "rid long, tokens array<string>, weights array<double>")
    index = postings.SparseIndex.build(vectors, work_path(spark, "sparse"), range_rows=40)
    plain = vectors.where("rid <> 902")
    for query, k in (({"t1": 1.0, "t2": 2.0, "t3": 0.5}, 8), ({"t1": -1.0, "t5": 1.0}, 10), ({"t7": 1.5}, 300), ({"zz": 1.0}, 3)):
        want = [tuple(r) for r in search.sparse_neighbors(plain, query, k).orderBy("rank").collect()]
        assert [tuple(r) for r in index.search(query, k).orderBy("rank").collect()] == want
    index.search({"t1": 1.0, "t2": 2.0, "t3": 0.5}, 3)
    assert index.postings.report["postings_scored"] < index.postings.report["postings"]


def test_no_records(spark):
    none = documents(spark).limit(0)
    assert postings.TextIndex.build(none, work_path(spark, "text")).search(["a"], 3).count() == 0
    assert documents(spark).where(F.col("doc_id") < 0).count() == 0


def test_terms_of_any_characters(spark):
    """Terms stay apart and whole on their way into the blocks."""
    terms = ["", "\x00", "\x01", "\x01a", "\x01b", "a\x00b", "\x00\x01a", "\x01\x00", "é\x00", "a", "b", "東", " ", "\\", "|", "."]
    vectors = spark.createDataFrame([(i, [t], [1.0 + i]) for i, t in enumerate(terms)] + [(50, terms, [0.5] * len(terms))], "rid long, tokens array<string>, weights array<double>")
    index = postings.SparseIndex.build(vectors, work_path(spark, "sparse"))
    for i, t in enumerate(terms):
        assert [tuple(r) for r in index.search({t: 2.0}, 5).orderBy("rank").collect()] == [(i, 2.0 + 2 * i, 1), (50, 1.0, 2)]


def test_entries_are_exchanged_packed(spark, monkeypatch):
    """An exchanged row holds a record's entries of a part of the folders, not one entry."""
    rows = [(i, [f"t{j}" for j in range(600)], [float(j + 1) for j in range(600)]) for i in range(40)]
    given = spark.createDataFrame(rows, "rid long, tokens array<string>, weights array<double>")
    counted, plain = [], type(given).repartition
    monkeypatch.setattr(type(given), "repartition", lambda self, *columns: counted.append(self.count()) or plain(self, *columns))
    index = postings.SparseIndex.build(given, work_path(spark, "sparse"))
    assert len(counted) == 1 and counted[0] <= 40 * postings.FOLDERS
    assert spark.read.parquet(f"{index.postings.root}/blocks").count() == 600


def test_sparse_vectors_of_a_text_without_tokens(spark, tmp_path):
    from recordlake.registry import series

    folder = str(tmp_path)
    spark.createDataFrame([(1, "the erst the"), (2, "... !!"), (3, ""), (4, None)], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    for query in (series.v2, series.v2_indexed):
        assert [tuple(r) for r in query(spark, folder).collect()] == [(1, 1.0, 1)]
