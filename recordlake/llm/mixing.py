"""Mixing sources to target weights, with DataFrame and SQL functions only.

Every document gets a random key, a hash of its id and a seed. Within each source documents stand
in key order; prefix sums of their sizes cut the source at its exact budget, after as many whole
epochs as fit. Since keys are uniform, a source is range-cut by the key's leading bits into buckets
of a few thousand documents: a sum inside each bucket and one offset per bucket give the prefix
sums, however large a source is.

Nulls and edges: a null source is a source of its own, the last; an empty text has size 0 and is
never taken. Rows that repeat an id stand next to each other, by size. A null id takes its key from
the text's hash, where the text is given. Empty tables give empty results. Extra columns pass through;
names starting with ``_mix_`` are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.session import stored

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 2000
HEX_DIGITS = 5


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, source: str, size: str, weights: Sequence[int], percent: int, epochs: int) -> DataFrame:
    """One row per source: its size, rows and target; one row per source is all that meets in a window.

    The sources share ``percent`` of all sizes by weight (weights repeat in code-point order of the
    sources, null last). A target stops at ``epochs`` times its source's size and the excess is shared
    again, until none is above: each target is then the smaller of that stop and one common share
    times its weight.
    """
    per = sizes.groupBy(F.col(source).alias("_mix_source")).agg(
        F.sum(size).cast("long").alias("source_size"), F.count(F.lit(1)).alias("_mix_rows"))
    order = Window.orderBy(F.col("_mix_source").isNull(), F.col("_mix_source"))
    given = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("_mix_weight", F.element_at(given, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    cap = F.lit(epochs) * F.col("source_size")
    # Sources that stop first come first; ratios are compared on a common multiple of all weights.
    common = 1
    for w in weights:
        common *= w
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(cap * (F.lit(common) / F.col("_mix_weight")).cast("long"), F.col("_mix_source").isNull(), F.col("_mix_source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("_mix_total", F.sum("source_size").over(everything) * percent)
        .withColumn("_mix_stopped", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_mix_open", F.sum("_mix_weight").over(everything) - F.coalesce(F.sum("_mix_weight").over(before), F.lit(0)))
    )
    # The share from this source on, if it and all after it were open; it holds where it is not above the stop.
    left = F.col("_mix_total") - 100 * F.col("_mix_stopped")
    holds = left * F.col("_mix_weight") <= 100 * cap * F.col("_mix_open")
    share = F.max(F.when(holds, left / (100 * F.col("_mix_open")))).over(everything)
    return per.withColumn("_mix_share", share).select(
        "_mix_source", "source_size", "_mix_rows",
        F.coalesce(F.least(cap.cast("double"), F.col("_mix_share") * F.col("_mix_weight")), cap.cast("double")).alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", size: str = "size", text: str | None = None,
        weights: Sequence[int] = (5, 2, 1), percent: int = 150, epochs: int = 2, seed: str = "mix") -> DataFrame:
    """All rows, with ``source_size``, ``target`` and ``taken``, the words that the mix takes of each."""
    docs = docs.drop("source_size", "target", "taken")
    fallback = F.md5(F.col(text)) if text else F.lit("")
    keyed = docs.withColumn("_mix_key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), fallback, F.lit(""))).cast("binary")))
    place = F.conv(F.substring("_mix_key", 1, HEX_DIGITS), 16, 10).cast("long")
    narrow = stored(keyed.select(F.col(source).alias("_mix_source"), F.col(size).alias("_mix_size"), place.alias("_mix_place")), "mix")
    targets = stored(source_targets(narrow, "_mix_source", "_mix_size", weights, percent, epochs).withColumn(
        "_mix_bits", F.least(F.lit(4 * HEX_DIGITS), F.ceil(F.log2(F.col("_mix_rows") / BUCKET_ROWS + 1))).cast("int")), "targets")
    same = F.col("_mix_source").eqNullSafe(F.col("_mix_of"))
    cut = lambda bits: F.floor(F.col("_mix_place") / F.pow(F.lit(2.0), F.lit(4 * HEX_DIGITS) - bits)).cast("long")
    bits = targets.select(F.col("_mix_source").alias("_mix_of"), "_mix_bits")
    sums = narrow.groupBy("_mix_source", "_mix_place").agg(F.sum("_mix_size").alias("_mix_size")).join(bits, same).groupBy(
        "_mix_source", cut(F.col("_mix_bits")).alias("_mix_bucket")).agg(F.sum("_mix_size").alias("_mix_size"))
    earlier = Window.partitionBy("_mix_source").orderBy("_mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_mix_offset", F.coalesce(F.sum("_mix_size").over(earlier), F.lit(0))).drop("_mix_size")
    offsets = stored(
        offsets.join(targets.withColumnRenamed("_mix_source", "_mix_of"), same)
        .select(*_name("_mix_source", "_mix_s"), "_mix_bucket", "_mix_offset", "source_size", "target"), "offsets")

    small = targets.select(*_name("_mix_source", "_mix_s"), "_mix_bits")
    rows = keyed.withColumn("_mix_place", place).select("*", *_name(source, "_mix_s"))
    rows = rows.join(small, ["_mix_s_null", "_mix_s"]).withColumn("_mix_bucket", cut(F.col("_mix_bits"))).drop("_mix_bits")
    rows = rows.join(offsets, ["_mix_s_null", "_mix_s", "_mix_bucket"])
    inside = Window.partitionBy("_mix_s_null", "_mix_s", "_mix_bucket").orderBy("_mix_key", size).rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_mix_offset") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - whole * F.col("source_size")
    taken = whole * F.col(size) + F.greatest(F.lit(0), F.least(F.col(size), rest - ahead))
    return rows.withColumn("taken", taken.cast("long")).drop(
        *[c for c in rows.columns if c.startswith("_mix_")])


def _name(column: str, to: str) -> list[Column]:
    """A nullable text as two columns that join plainly."""
    return [F.col(column).isNull().alias(f"{to}_null"), F.coalesce(F.col(column), F.lit("")).alias(to)]


def expand(mixed: DataFrame, size: str = "size", text: str = "text", chars: str | None = None) -> DataFrame:
    """The mixed rows themselves: one copy per whole epoch, and the words of the cut as a shorter text."""
    whole = F.when(F.col(size) > 0, F.floor(F.col("taken") / F.col(size))).otherwise(0).cast("int")
    part = (F.col("taken") - whole * F.col(size)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    rows = mixed.withColumn("_mix_cut", F.explode(copies))
    rows = rows.withColumn(text, F.when(F.col("_mix_cut") > 0, F.array_join(F.slice(pieces, 1, F.greatest(F.col("_mix_cut"), F.lit(1))), "")).otherwise(F.col(text)))
    if chars:
        rows = rows.withColumn(chars, F.when(F.col("_mix_cut") > 0, F.length(text).cast("long")).otherwise(F.col(chars)))
    return rows.drop("_mix_cut")
