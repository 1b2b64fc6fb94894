"""Exact duplicates: groups of a 128-bit content hash, checked byte by byte."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.runtime import cut


def one_spaced(text: Column) -> Column:
    """The text (null: empty) with each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", hash_bytes: int = 16, row: str | None = None) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256``: one row per input row.

    ``row`` names a column that numbers the rows; it is returned as well.
    Without it, a row's place in the table as read tells copies of a row apart.

    Texts are equal if their bytes are, after ``one_spaced``.  Rows are
    grouped by the first ``hash_bytes`` of the text's SHA-256 and by the text
    itself, so that Spark compares the bytes of equal hashes; tasks merge
    their copies before the shuffle, and a group of any size arrives as one
    row per task.  A row then finds its group by the hash alone; only hashes
    that several texts share (for 16 bytes: none ever) are looked up with
    the text.

    ``keep_id`` is the smallest id of the group; nulls come last, so it is
    null only if all ids are.  A null text counts as empty.  If the row with
    that id is repeated, one of its copies has ``kept``.
    """
    rows = docs.select(F.col(id).alias("__id"), one_spaced(F.col(text)).alias("__text"), (F.col(row) if row else F.monotonically_increasing_id()).alias("__row"))
    rows = rows.withColumn("__sha", F.sha2("__text", 256)).withColumn("__hash", F.substring(F.unhex("__sha"), 1, hash_bytes))
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    grouped = rows.groupBy("__hash", "__text").agg(first.alias("__first"), F.count("*").alias("group_size"))
    groups = cut(grouped.select("__hash", "__first", "group_size"))
    shared = cut(groups.groupBy("__hash").agg(F.count("*").alias("__texts")).filter("__texts > 1").select("__hash"))
    members = rows.select("__id", "__row", "__sha", "__hash")
    if shared.isEmpty():
        found = members.join(groups.select("__hash", "__first", "group_size"), "__hash")
    else:
        # Members of a shared hash are told apart by their text, compared as a whole.
        texts = grouped.join(shared, "__hash", "left_semi")
        alone = members.join(groups.join(shared, "__hash", "left_anti").select("__hash", "__first", "group_size"), "__hash")
        mixed = rows.join(shared, "__hash", "left_semi").join(texts, ["__hash", "__text"])
        columns = ["__id", "__row", "__sha", "__first", "group_size"]
        found = alone.select(*columns).unionByName(mixed.select(*columns))
    return found.select(
        F.col("__id").alias(id),
        F.col("__first.id").alias("keep_id"),
        "group_size",
        (F.col("__row") == F.col("__first.row")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
        *([F.col("__row").alias(row)] if row else []),
    )
