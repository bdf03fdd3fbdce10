"""Connected components of a link table, by links between labels that fall together, and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b", labels: DataFrame | None = None) -> DataFrame:
    """Rows (node, comp) for every node of a link; comp is the smallest node that it reaches.

    In each round the links go between the labels of their ends, each such pair once, and those inside a
    label go; so a round reads what is still between labels, and not all links again. A label that is its
    own takes the smallest it has a link to, and every node the label of its label, so that long chains
    halve. A node with very many links costs one partial minimum per task. Links and labels are written to
    the shared folder after each round; only a count comes back. ``labels`` are the rows that links taken
    in before gave; their nodes come back as well.
    """
    links = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "links")
    ends = links.select(F.col("b").alias("node"), F.col("a").alias("comp")).union(links.select("a", "a")).groupBy("node").agg(F.min("comp").alias("comp"))
    if labels is None:
        labels = stored(ends, "labels")
    else:
        labels = stored(labels.select("node", "comp").union(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))), "labels")
    while True:
        at_a, at_b = (labels.select(F.col("node").alias(end), F.col("comp").alias(f"of_{end}")) for end in "ab")
        links = stored(links.join(at_a, "a").join(at_b, "b").select(
            F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).where("a < b").distinct(), "links")
        near = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("near"))
        # Only a label that is its own moves, so that no node leaves what it is joined to.
        low = labels.join(near, "node", "left").select("node", "comp", F.when(F.col("node") == F.col("comp"), F.col("near")).alias("near")).select(
            "node", "comp", F.coalesce("near", "comp").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("comp").alias("jumped"))
        after = stored(low.join(jump, "low").select("node", F.col("jumped").alias("comp"), (F.col("jumped") < F.col("comp")).alias("moved")), "labels")
        labels = after.select("node", "comp")
        if after.where("moved").isEmpty():
            return labels
