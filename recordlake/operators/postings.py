"""Stored postings for full-text and sparse search: blocks with their largest weights, and a top k that skips blocks.

Records are put into *ranges* of about ``RANGE`` records of similar size (length of a text, largest weight
of a vector), so that ranges differ in what they can score. A block holds one term's postings in one range,
with the largest and smallest weight in it. The blocks lie in folders by a hash of the term, sorted by term
and range: a build adds up equal terms inside each record and exchanges what is left once, a record's entries of
several folders as one row, in which all terms are one string; a query opens its terms' folders only, and Parquet's statistics skip the other terms in them.

A query first reads, of its terms' blocks, the numbers alone. What the terms' largest weights come to in a
range bounds every record there. The few ranges with the highest bounds are scored; then those whose bound
reaches the k-th score found, and no others. The result is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.functions.values import let
from recordlake.operators.search import BM25_B, BM25_K1, tokens, top
from recordlake.session import stored

RANGE = 4096
FOLDERS = 64
#: Ranges that are scored before any is left out.
FIRST = 4
#: Folders go together in so many parts when entries are exchanged.
PARTS = 16
#: Entries of the ranges whose blocks are written together, a file per folder.
ZONE = 1 << 24
#: Size classes a factor of two is divided into, and the most on each side of size 1.
STEPS, MOST_CLASSES = 8, 400


class Postings:
    """An index under ``root``; ``report`` tells what the last search read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.report = spark, root, {}

    @classmethod
    def build(cls, records: DataFrame, root: str, id_col: str, range_rows: int = RANGE) -> Postings:
        """``records`` (id, ``size``, ``held``, ``entries``) has every record once, with its ``held`` different terms
        as ``entries``, an array of (``term``, ``weight``). It is read twice.

        The driver gets two counts per size class. A record's range follows from them and from its own row, so its
        entries are brought to their places in one exchange: by part (of the folders) and *zone*, which is as many ranges
        as hold about ``ZONE`` entries. They stay packed until then, as an entry's own row would be three times as long.
        """
        size_class = F.greatest(F.lit(-MOST_CLASSES), F.least(F.lit(MOST_CLASSES), F.coalesce(F.floor(F.log2(F.col("size")) * STEPS), F.lit(-MOST_CLASSES)))).cast("int")
        classed = records.withColumn("class", size_class)
        counts = classed.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("held")).collect()
        first, before, places = 0, 0, []
        for c, n, held in sorted((r["class"], r["n"], r["held"] or 0) for r in counts):
            many = -(-n // range_rows)
            places.append((c, first, many, before, held))
            first, before = first + many, before + held
        spot = F.create_map(*[x for c, at, many, start, held in places for x in (F.lit(c), F.struct(
            F.lit(at).alias("at"), F.lit(many).alias("many"), F.lit(start).cast("long").alias("start"), F.lit(held).cast("long").alias("held")))]) if places else F.lit(
                None).cast("map<int,struct<at:int,many:int,start:long,held:long>>")
        placed = classed.select(id_col, "entries", spot[F.col("class")].alias("p")).withColumn("i", F.pmod(F.xxhash64(id_col), F.col("p.many")))
        each = placed.select(
            F.col(id_col).alias("id"), (F.col("p.at") + F.col("i")).cast("int").alias("range"),
            F.floor((F.col("p.start") + F.col("p.held") * F.col("i") / F.col("p.many")) / ZONE).cast("int").alias("zone"), F.explode(_packed(F.col("entries"))).alias("e"))
        each = each.select("id", "range", "zone", F.col("e.term").alias("part"), "e.weight.*").repartition("part", "zone")
        each = each.select("id", "range", "zone", "part", F.explode(F.arrays_zip(F.split("terms", _END).alias("term"), F.col("weights").alias("weight"))).alias("e"))
        blocks = each.select("id", "range", "zone", "part", _bare(F.col("e.term")).alias("term"), "e.weight").groupBy("part", "zone", "term", "range").agg(
            F.collect_list(F.struct("id", "weight")).alias("posts"), F.max("weight").alias("most"), F.min("weight").alias("least"),
            F.count(F.lit(1)).alias("n"))  # at most about ``range_rows`` records
        blocks.drop("part", "zone").withColumn("folder", _folder(F.col("term"))).sortWithinPartitions("folder", "term", "range").write.partitionBy("folder").parquet(f"{root}/blocks")
        records.select(id_col).limit(0).write.parquet(f"{root}/ids")  # the type of ids, also of an empty index
        return cls(records.sparkSession, root)

    def blocks(self, terms: Sequence[str]) -> DataFrame:
        """The blocks of some terms: their folders are known before anything is read."""
        named = self.spark.read.parquet(f"{self.root}/ids").schema.fields[0].dataType.simpleString()
        every = self.spark.read.schema(
            f"range int, term string, posts array<struct<id:{named},weight:double>>, most double, least double, n bigint, folder int").parquet(f"{self.root}/blocks")
        return every.where(F.col("folder").isin([_folder_of(self.spark, t) for t in terms]) & F.col("term").isin(list(terms)))

    def frequencies(self, terms: Sequence[str]) -> dict[str, int]:
        """In how many records each term is."""
        return {r["term"]: r["n"] for r in self.blocks(terms).groupBy("term").agg(F.sum("n").alias("n")).collect()}

    def search(self, weights: Mapping[str, float], k: int, id_col: str) -> DataFrame:
        """The ``k`` records with the largest sums of weight times query weight: id, score, rank; ties by id."""
        terms = sorted(weights)
        mine = self.blocks(terms)
        by_term = F.create_map(*[x for t in terms for x in (F.lit(t), F.lit(float(weights[t])))])
        q = by_term[F.col("term")]
        # A record may also lack the term.
        bound = F.greatest(q * F.col("most"), q * F.col("least"), F.lit(0.0))
        bounds = stored(mine.groupBy("range").agg(F.sum(bound).alias("bound"), F.sum("n").alias("n")), "bounds")
        best = bounds.orderBy(F.desc("bound"), "range").limit(FIRST)
        head = [r["range"] for r in best.select("range").collect()]
        found = stored(self._score(mine.where(F.col("range").isin(head)), weights, id_col), "head")
        kth = found.orderBy(F.desc("score"), id_col).limit(k).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).first()
        rest = bounds.where(~F.col("range").isin(head))
        if kth["n"] == k:
            # Scores are rounded to six places; bounds are not.
            rest = rest.where(F.col("bound") >= kth["s"] - 1e-6)
        rest = stored(rest, "rest")
        more = self._score(mine.join(rest.select("range"), "range", "left_semi"), weights, id_col)
        total, read = (x.agg(F.count(F.lit(1)).alias("r"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first() for x in (bounds, rest.unionByName(bounds.where(F.col("range").isin(head)))))
        self.report = {"ranges": total["r"], "ranges_scored": read["r"], "postings": total["n"], "postings_scored": read["n"]}
        return top(found.unionByName(more), k, id_col)

    def _score(self, blocks: DataFrame, weights: Mapping[str, float], id_col: str) -> DataFrame:
        """Whole scores of all records of the blocks' ranges, terms added in their order."""
        posts = blocks.select("term", F.explode("posts").alias("p")).select("term", F.col("p.id").alias(id_col), "p.weight")
        parts = [F.coalesce(F.max(F.when(F.col("term") == t, F.col("weight"))), F.lit(0.0)) * float(weights[t]) for t in sorted(weights)]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        return posts.groupBy(id_col).agg(F.round(total, 6).alias("score"))


def _runs(ordered: Column, term, weight) -> Column:
    """(``term``, ``weight``) of each run of equal terms in an array in their order; ``weight`` is given a function
    that gives the run's items, and their number."""

    def runs(items: Column, starts: Column) -> Column:
        def one(at: Column, i: Column) -> Column:
            n = F.coalesce(F.get(starts, i + 1), F.size(items)) - at
            return F.struct(term(F.get(items, at)).alias("term"), weight(lambda: F.slice(items, at + 1, n), n).alias("weight"))

        return F.transform(starts, one)

    def places(items: Column) -> Column:
        every = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1))
        return F.filter(every, lambda i: (i == 0) | (term(F.get(items, i)) != term(F.get(items, i - 1))))

    return let(ordered, lambda items: let(places(items), lambda starts: runs(items, starts)))


#: Between terms in a packed row, and what stands before a letter for it or for itself inside a term.
_END, _MARK = "\u0000", "\u0001"


def _packed(entries: Column) -> Column:
    """For each part that a record has entries of: (``term``, the part, ``weight``: its ``terms`` as one string, ``weights``)."""

    def marked(term: Column) -> Column:
        return F.replace(F.replace(term, F.lit(_MARK), F.lit(_MARK + "b")), F.lit(_END), F.lit(_MARK + "a"))

    ordered = F.sort_array(F.transform(entries, lambda e: F.struct(F.pmod(_folder(e["term"]), F.lit(PARTS)).alias("part"), e["term"].alias("term"), e["weight"].alias("weight"))))
    return _runs(ordered, lambda e: e["part"], lambda run, _: let(run(), lambda run_: F.struct(
        F.array_join(F.transform(run_, lambda e: marked(e["term"])), _END).alias("terms"), F.transform(run_, lambda e: e["weight"]).alias("weights"))))


def _bare(term: Column) -> Column:
    return F.replace(F.replace(term, F.lit(_MARK + "a"), F.lit(_END)), F.lit(_MARK + "b"), F.lit(_MARK))


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


def _folder_of(spark: SparkSession, term: str) -> int:
    return spark.range(1).select(_folder(F.lit(term))).first()[0]


class TextIndex:
    """Full-text search by BM25 over a stored index, with the rows of ``search.full_text``."""

    def __init__(self, spark: SparkSession, root: str, id_col: str = "doc_id"):
        self.postings, self.id_col = Postings(spark, root), id_col
        self.n, self.mean = spark.read.parquet(f"{root}/stats").select("n", "mean").first()  # one row

    @classmethod
    def build(cls, docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE) -> TextIndex:
        words = F.array_sort(tokens(F.col(text_col)))
        split = stored(docs.select(id_col, F.size(words).alias("len"), _runs(words, lambda w: w, lambda _, n: n).alias("t")), "split")
        stats = split.agg(F.count(F.lit(1)).alias("n"), (F.sum("len") / F.count(F.lit(1))).alias("mean"))
        stats.write.parquet(f"{root}/stats")
        mean = docs.sparkSession.read.parquet(f"{root}/stats").first()["mean"] or 1.0

        def impact(tf: Column) -> Column:
            return tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * F.col("len") / F.lit(mean)))

        entries = F.transform("t", lambda e: F.struct(e["term"].alias("term"), impact(e["weight"]).alias("weight")))
        Postings.build(split.select(id_col, F.col("len").cast("double").alias("size"), F.size("t").alias("held"), entries.alias("entries")), root, id_col, range_rows)
        return cls(docs.sparkSession, root, id_col)

    def search(self, query: Sequence[str], k: int) -> DataFrame:
        import math

        words = sorted({w.lower() for w in query})
        seen = self.postings.frequencies(words)
        idf = {w: math.log(1.0 + (self.n - seen.get(w, 0) + 0.5) / (seen.get(w, 0) + 0.5)) for w in words}
        return self.postings.search(idf, k, self.id_col)


class SparseIndex:
    """Sparse neighbours over a stored index, with the rows of ``search.sparse_neighbors``."""

    def __init__(self, spark: SparkSession, root: str, id_col: str = "rid"):
        self.postings, self.id_col = Postings(spark, root), id_col

    @classmethod
    def build(cls, vectors: DataFrame, root: str, id_col: str = "rid", tokens_col: str = "tokens", weights_col: str = "weights", range_rows: int = RANGE) -> SparseIndex:
        """Ranges go by the largest weight, so that blocks of heavy entries stand together."""
        weights = F.col(weights_col).cast("array<double>")
        pairs = F.transform(F.arrays_zip(F.col(tokens_col).alias("t"), weights.alias("w")), lambda e: F.struct(e["t"].alias("term"), e["w"].alias("weight")))
        known = F.sort_array(F.filter(pairs, lambda e: e["term"].isNotNull() & e["weight"].isNotNull()))
        total = _runs(known, lambda e: e["term"], lambda part, _: F.aggregate(part(), F.lit(0.0), lambda s, e: s + e["weight"]))
        given = stored(vectors.select(id_col, F.array_max(F.transform(weights, F.abs)).alias("size"), total.alias("entries")).withColumn("held", F.size("entries")), "vectors")
        Postings.build(given, root, id_col, range_rows)
        return cls(vectors.sparkSession, root, id_col)

    def search(self, query: Mapping[str, float], k: int) -> DataFrame:
        return self.postings.search(query, k, self.id_col)
