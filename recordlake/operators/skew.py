"""Many-to-one joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 64
HOT_SHARE = 0.005
KEY_SAMPLE = 0.01
SALTS = 64


def hot_keys(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[tuple]:
    """The keys that hold at least ``share`` of the rows: at most MAX_HOT_KEYS of them.

    Counted on a sample of the key columns alone. A key that is missed only costs balance (AQE's
    skew handling still applies); no result depends on this list.
    """
    counts = df.select(*on).sample(KEY_SAMPLE, 7).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n")).limit(MAX_HOT_KEYS).collect()
    floor = max(2, share * sum(r["_n"] for r in top))
    return [tuple(r[c] for c in on) for r in top if r["_n"] >= floor]


def _is_hot(on: Sequence[str], keys: list[tuple]) -> Column:
    """Null keys count too: unmatched rows of an outer join also pile up on one task."""
    tests = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(on, key)]) for key in keys]
    return reduce(Column.__or__, tests)


def join_to_one(
    many: DataFrame, one: DataFrame, on: Sequence[str], how: str = "left", salts: int = SALTS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Join ``many`` to ``one``; ``on`` is usually unique in ``one``, but need not be.

    Without ``hot`` this is Spark's own join: a side under the broadcast threshold is broadcast, and
    adaptive execution splits the large partitions of a skewed sort-merge join. Callers that know
    their hot keys (``hot_keys`` finds them on a stored table, once) name them: rows of these get a salt
    and the matching rows of ``one`` are repeated per salt, so that a key holding a third of the rows
    is spread over ``salts`` tasks; all other keys join unsalted.
    """
    on = list(on)
    if not hot:
        return many.join(one, on, how)
    # Rows of one partition keep their salt when a stage is run again; equal copies in different
    # partitions get different salts.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in _hashable(many)]), F.lit(salts))
    many_side = many.withColumn("_salt", F.when(_is_hot(on, hot), spread.cast("int")).otherwise(F.lit(0)))
    all_salts = F.array(*[F.lit(i) for i in range(salts)])
    one_side = one.withColumn(
        "_salt", F.explode(F.when(_is_hot(on, hot), all_salts).otherwise(F.array(F.lit(0))))
    )
    return many_side.join(one_side, [*on, "_salt"], how).drop("_salt")


def _hashable(df: DataFrame) -> list[str]:
    """Columns xxhash64 accepts: no maps or variants at any depth."""
    return [f.name for f in df.schema.fields if not any(w in f.dataType.simpleString() for w in ("map<", "variant"))]
