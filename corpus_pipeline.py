"""A corpus from raw documents: filtered, deduplicated, decontaminated and encoded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``docs`` for the rows that stay.  ``doc_id`` names a
document: rows of one id share decisions, except that the exact stage keeps one
of a repeated row.  Null ids, null and empty texts pass like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import leaks
from tessera.llm.exact import exact_groups
from tessera.llm.pieces import encode_decode
from tessera.llm.quality import quality_scores
from tessera.llm.simhash import similar_groups
from tessera.runtime import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids (gone)``; rows without an id stay."""
    return docs.join(ids.distinct(), docs["doc_id"] == ids["gone"], "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality_scores(docs, _table(spark, sf_dir, "labels"))
    return _without(docs, scored.filter("predicted = 0").select(F.col("doc_id").alias("gone")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that of the smallest id."""
    row = "row"
    while row.lower() in {c.lower() for c in docs.columns}:
        row += "_"
    # The place in the table as read, so the same in both reads.
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    gone = exact_groups(numbered, row=row).filter(~F.col("kept")).select(F.col(row).alias("gone"))
    return numbered.join(gone, numbered[row] == gone["gone"], "left_anti").drop(row)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    groups = similar_groups(docs)
    return _without(docs, groups.filter("component_id < doc_id").select(F.col("doc_id").alias("gone")))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = leaks(docs, _table(spark, sf_dir, "benchmark"))
    return _without(docs, found.select(F.col("doc_id").alias("gone")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and hashes of every document that is left."""
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("clean", clean), ("encode", encode)]

#: SQL can express neither the classifier nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
