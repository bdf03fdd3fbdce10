"""The corpus pipeline against a plain version of its exact stages, and each stage on odd documents."""

import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from recordlake.llm import leaks, tokens
from test_edges import corpus, linked_by_hand, words

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t, lang, source in rows], DOCS)


def test_stages_on_given_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [leaks.normal(t) for t in pq.read_table(f"{FOLDER}/benchmark.parquet")["text"].to_pylist()]
    kept = []
    for _, stage in pipeline.STAGES[:3]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    told, single, clean = kept
    assert len(told) >= 0.98 * spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    want = linked_by_hand(sorted(told.items()), width=pipeline.NEAR_WORDS, percent=pipeline.NEAR_PERCENT)
    assert set(single) == {i for i, (_, comp) in want.items() if i == comp}
    whole = {i for i, t in single.items() if any(b in leaks.normal(t) for b in bench)}
    assert not whole & set(clean) and len(single) - len(clean) <= len(whole) + 2
    mixed = pipeline.mixed(spark, docs, FOLDER).cache()
    sizes = sum(len(words(t)) for t in clean.values())
    assert abs(sum(len(words(r["text"])) for r in mixed.collect()) - 1.5 * sizes) <= 20
    out = sorted(pipeline.coded(spark, mixed, FOLDER).collect(), key=lambda r: r["start"])
    tok, start = tokens.tokenizer(tokens.tokenizer_path(pipeline.TOKENIZER)), 0
    for r, (i, t) in zip(out, sorted((r["doc_id"], r["text"]) for r in mixed.collect()), strict=True):
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, pipeline.END_ID], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_near_copies_share_four_fifths_of_their_five_word_runs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = {i for i, (_, comp) in linked_by_hand(rows, width=5, percent=80).items() if i == comp}
    assert len(want) < sum(i == comp for i, (_, comp) in linked_by_hand(rows).items())
    assert {r["doc_id"] for r in pipeline.one_of_each(spark, docs, FOLDER).collect()} == want


def test_stages_on_odd_and_no_documents(spark):
    for rows in (corpus(n=40), []):
        docs = frame(spark, rows)
        for name, stage in pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
            if name != "token_ids":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert (docs.count() > 0) == bool(rows)


def test_run(spark):
    assert pipeline.run(spark, FOLDER).count() > 100


def test_given_columns_of_any_name_pass_through(spark):
    names = ["score", "size", "leaks", "lang_pred", "component_id", "taken", "target", "given_0", "_words"]
    docs = frame(spark, corpus(n=40))
    plain = docs
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for _, stage in pipeline.STAGES[:4]:
        docs, plain = stage(spark, docs, FOLDER).cache(), stage(spark, plain, FOLDER).cache()
        assert docs.columns == [*plain.columns, *names]
        rows = docs.collect()
        assert all(r[name] == f"{i}:{'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for i, name in enumerate(names))
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, docs.select(*plain.columns).collect())) == sorted(map(key, plain.collect()))
