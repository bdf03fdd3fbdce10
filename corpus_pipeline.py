"""From raw documents to token ids: five stages, each reading all that the one before it kept.

Language identification, near duplicates, benchmark decontamination, mixing, token output. A stage
takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared folder
and read again as the next stage's documents. All but the last return the columns they were given.

Nulls and edges: a null text goes in the first stage. Rows with a null id are judged like others, but are no
near copy's representative and stay. Rows that repeat an id stay or go together as near copies, and are mixed
and coded each. Ties in the mix go by a hash of the id and the text. Texts of any length are read whole. A table
without rows gives none. Columns beside those of ``documents`` pass through all stages but the last, whatever
their names are: inner columns of the operators never meet them.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import dac, jaccard, langid, leaks, mixing, tokens
from recordlake.registry.base import table
from recordlake.session import work_path

#: A text whose best language has less than this probability is rejected, as is one without a letter.
LEAST_SCORE = 0.3
#: Near copies share this much of their runs of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

#: The language model and the tokenizer are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(stage):
    """The stage, with given columns beside those of ``documents`` under names that no operator uses."""

    @functools.wraps(stage)
    def run_apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"given_{i}" for i, c in enumerate(c for c in docs.columns if c not in COLUMNS)}
        out = stage(spark, _named(docs, names), sf_dir)
        return _named(out, {b: a for a, b in names.items()})

    return run_apart


def _named(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """All columns, renamed at once."""
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


@_apart
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learned languages; a null text goes, as ``und``."""
    learns = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)), F.lit(0)) != 2
    net = langid.train(docs, learns)
    if net is None:  # nothing to learn from: only texts without a letter go
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = langid.identify(docs, net)
    return told.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


@_apart
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of linked documents stays; rows that share an id stay or go together."""
    gone = jaccard.near_components(docs, width=NEAR_WORDS, percent=NEAR_PERCENT).where("component_id <> doc_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@_apart
def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return leaks.annotate(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(*docs.columns)


@_apart
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: a row per copy, and at each source's cut a shortened text."""
    taken = mixing.mix(docs.withColumn("size", mixing.word_count("text")), text="text")
    return mixing.expand(taken, chars="n_chars").select(*docs.columns)


def coded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in directly addressable form, and each document's place in them."""
    path = work_path(spark, "codes")
    dac.write(docs, path, tokens.tokenizer_path(TOKENIZER), END_ID)
    return dac.read(spark, path).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", unseen),
    ("mixing", mixed),
    ("token_ids", coded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
