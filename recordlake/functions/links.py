"""Record links: ``#bucket:pos`` text and its struct form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rid text format.
RID_PATTERN = r"^#\+?[0-9]+:\+?[0-9]+$"


def parse_link(text: Column) -> Column:
    """``#b:p`` text to STRUCT<bucket INT, pos BIGINT>; anything else, or out of range, is null."""
    bucket = F.substring_index(F.ltrim(text, F.lit("#")), ":", 1).try_cast("int")
    pos = F.substring_index(text, ":", -1).try_cast("bigint")
    link = F.struct(bucket.alias("bucket"), pos.alias("pos"))
    return F.when(text.rlike(RID_PATTERN) & bucket.isNotNull() & pos.isNotNull(), link)


def link_text(link: Column) -> Column:
    """STRUCT<bucket, pos> to ``#b:p``; null stays null."""
    return F.when(
        link.isNotNull(),
        F.concat(F.lit("#"), link["bucket"].cast("string"), F.lit(":"), link["pos"].cast("string")),
    )


def make_link(bucket: Column, pos: Column) -> Column:
    return F.struct(bucket.cast("int").alias("bucket"), pos.cast("bigint").alias("pos"))
