"""Full-text, sparse and dense neighbour search, and rank fusion."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.operators.ordering import dense_index
from recordlake.session import stored, work_path

# BM25 parameters, reciprocal-rank constant.
BM25_K1, BM25_B, RRF_K = 1.2, 0.75, 60
# Query vectors handled per pass over the vectors.
QUERY_BLOCK = 1024
# Vectors scored at once against a block.
SCORE_ROWS = 2048


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _occurrences(items: Column, word: str) -> Column:
    return F.size(items) - F.size(F.array_remove(items, word))


def full_text(docs: DataFrame, query: Sequence[str], k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ``k`` best documents for the keywords by BM25, best first, ties by id.

    Term counts are taken inside each row, so text never leaves its task. They are written out once,
    a few numbers per document; the global counts (one row) and the scores come from that, and the
    top k from per-task heaps.
    """
    words = sorted({w.lower() for w in query})
    counted = stored(docs.select(id_col, tokens(F.col(text_col)).alias("_t")).select(
        id_col, F.size("_t").alias("_len"),
        *[_occurrences(F.col("_t"), w).alias(f"_tf{i}") for i, w in enumerate(words)],
    ))
    totals = counted.agg(
        F.count(F.lit(1)).alias("n"), F.sum("_len").alias("len"),
        *[F.count(F.when(F.col(f"_tf{i}") > 0, F.lit(1))).alias(f"df{i}") for i in range(len(words))],
    )
    packed = totals.select(F.struct("*").alias("s")).scalar()
    scored = counted.where(reduce(Column.__or__, [F.col(f"_tf{i}") > 0 for i in range(len(words))])).withColumn("_s", packed)
    mean = F.col("_s.len") / F.col("_s.n")
    parts = []
    for i in range(len(words)):
        seen, tf = F.col(f"_s.df{i}"), F.col(f"_tf{i}")
        idf = F.ln(F.lit(1.0) + (F.col("_s.n") - seen + 0.5) / (seen + 0.5))
        parts.append(idf * tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * F.col("_len") / mean)))
    score = F.round(reduce(Column.__add__, parts), 6).alias("score")
    return top(scored.select(id_col, score), k, id_col)


def top(scored: DataFrame, k: int, id_col: str) -> DataFrame:
    """Best k rows with their rank; the window sees those k rows only."""
    best = scored.orderBy(F.desc("score"), id_col).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), F.col(id_col))))


def sparse_neighbors(
    vectors: DataFrame, query: dict, k: int, id_col: str = "rid", tokens_col: str = "tokens", weights_col: str = "weights"
) -> DataFrame:
    """Top ``k`` records by dot product of their token/weight lists with the query's.

    Each record's product is a fold over its own lists against the (small) query map; records that
    share no token are left out.
    """
    lookup = F.create_map(*[x for t, w in query.items() for x in (F.lit(t), F.lit(float(w)))])
    pairs = F.filter(F.arrays_zip(F.col(tokens_col).alias("t"), F.col(weights_col).alias("w")), lambda p: p["t"].isin(list(query)))
    product = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p["w"].cast("double") * F.element_at(lookup, p["t"]))
    hit = F.arrays_overlap(F.col(tokens_col), F.array(*[F.lit(t) for t in query]))
    # An exploded one-row list filters like a WHERE, but is not pushed below the columns it reads, so
    # lists that are computed on the way in are computed once.
    scored = vectors.select(
        F.explode(F.when(hit, F.array(F.struct(F.col(id_col), F.round(product, 6).alias("score"))))).alias("h")
    ).select("h.*")
    return top(scored, k, id_col)


def _block_scorer(ids: list, matrix: np.ndarray, k: int, id_col: str, vec_col: str):
    """Cosine of every vector with every query of the block; the best k of each are kept over the whole
    partition and given once, at its end, so a task gives at most k rows per query."""
    unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros((0, len(ids)))
        names = np.zeros((0, len(ids)), dtype=object)
        for pdf in batches:
            pdf = pdf[pdf[vec_col].notna()]
            for i in range(0, len(pdf), SCORE_ROWS):
                part = pdf.iloc[i:i + SCORE_ROWS].sort_values(id_col)
                rows = np.stack(part[vec_col].to_numpy()).astype(np.float64)
                rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
                found = np.concatenate([best, np.round(rows @ unit.T, 6)])
                known = np.concatenate([names, np.broadcast_to(part[id_col].to_numpy(dtype=object)[:, None], (len(part), len(ids)))])
                if len(found) > k:
                    at = _best(found, known, k)
                    found, known = np.take_along_axis(found, at, 0), np.take_along_axis(known, at, 0)
                best, names = found, known
        if len(best):
            yield pd.DataFrame({"query_id": np.repeat(ids, len(best)), id_col: names.T.ravel(), "score": best.T.ravel()}).astype({id_col: type(names[0, 0])})

    return score


def _best(found: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest scores of each column; among equal scores at the edge, the smallest names."""
    at = np.argpartition(-found, k - 1, axis=0)[:k]
    edge = np.take_along_axis(found, at, 0).min(axis=0)
    for q in np.flatnonzero((found >= edge).sum(axis=0) > k):
        rows = np.flatnonzero(found[:, q] >= edge[q])
        at[:, q] = sorted(rows, key=lambda r: (-found[r, q], names[r, q]))[:k]
    return at


def dense_neighbors(
    vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
    query_id: str = "query_id",
) -> DataFrame:
    """The ``k`` nearest vectors by cosine for each query: query_id, id, score, rank. Exact.

    Queries are taken in blocks of QUERY_BLOCK rows. A block is fetched, sent to the tasks and answered
    in one pass, at most k rows per query and task, and its answer is written to the shared folder
    before the next one: the driver holds one block, however many queries there are.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    qid_type = queries.schema[query_id].dataType.simpleString()
    schema = f"query_id {qid_type}, {id_col} {id_type}, score double"
    path = None

    def answer(block: list) -> None:
        nonlocal path
        scorer = _block_scorer([r[0] for r in block], np.array([r[1] for r in block], dtype=np.float64), k, id_col, vec_col)
        found = _rank(vectors.select(id_col, vec_col).mapInPandas(scorer, schema), k, id_col)
        path = path or work_path(spark, "neighbours")
        found.write.mode("append").parquet(path)

    block = []
    for row in queries.select(query_id, vec_col).toLocalIterator():
        block.append(row)
        if len(block) == QUERY_BLOCK:
            answer(block)
            block = []
    if block:
        answer(block)
    if path is None:
        return spark.createDataFrame([], f"{schema}, rank int")
    return spark.read.schema(f"{schema}, rank int").parquet(path)


def _rank(scored: DataFrame, k: int, id_col: str) -> DataFrame:
    # Spark cuts each task's rows to k per query before the shuffle (window group limit).
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(id_col))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fuse(lists: Sequence[DataFrame], k: int = RRF_K, id_col: str = "doc_id", limit: int | None = None) -> DataFrame:
    """Reciprocal rank fusion of top-k lists: sum of 1/(k + rank), best first, ties by id.

    A list carrying ``rank`` is used as ranked; otherwise its score order gives the rank.
    """
    ranked = []
    for frame in lists:
        if "rank" not in frame.columns:
            frame = dense_index(frame, [F.desc("score"), F.col(id_col)], name="rank", start=1)
        ranked.append(frame.select(id_col, (F.lit(1.0) / (F.lit(float(k)) + F.col("rank"))).alias("part")))
    both = reduce(DataFrame.unionByName, ranked)
    out = both.groupBy(id_col).agg(F.round(F.sum("part"), 9).alias("score")).orderBy(F.desc("score"), id_col)
    return out.limit(limit) if limit is not None else out
