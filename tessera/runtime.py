"""Session, lineage and ordering helpers shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType
from pyspark.sql.window import Window


def build_session(name: str = "tessera", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    that names none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the copy.

    The copy survives the loss of executors, so iterative operators call this
    once per round instead of growing the plan.  It is a table of its own: a
    checkpoint keeps the estimated size of the plan it comes from, which for
    joins is a product, and over rounds of joins that number alone grows until
    planning takes longer than the work.  Columns are written by position, so
    that names may clash.
    """
    spark = df.sparkSession
    if any(isinstance(f.dataType, NullType) for f in df.schema):
        shared_folder(spark)
        return df.checkpoint(eager=True)
    path = new_path(spark, "cut")
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path).toDF(*df.columns)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{uuid.uuid4().hex}/{name}"


def number_rows(df: DataFrame, *order, name: str = "row_id", start: int = 1, keep: list | None = None) -> DataFrame:
    """Dense consecutive numbers in ``order`` without a single-task window.

    Rows are range partitioned and sorted, written once (so both passes see
    the same partitions), and each partition is shifted by the sizes of the
    partitions before it.  ``order`` should be unique for a repeatable result.
    With ``keep`` only those columns are written and returned.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = cut(
        (ordered if keep is None else ordered.select(*keep)).withColumn("__part", F.spark_partition_id()).withColumn(
            "__seq", F.monotonically_increasing_id() - F.shiftleft(F.col("__part").cast("bigint"), 33)
        )
    )
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__size"))
    # One row per partition, so this window and the broadcast are bounded by the partition count.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    return (
        ordered.join(F.broadcast(shifts), "__part")
        .withColumn(name, F.col("__shift") + F.col("__seq") + F.lit(start))
        .drop("__part", "__seq", "__shift", "__size")
    )


def scalar(df: DataFrame):
    """The single row of an ungrouped aggregate."""
    return df.first()
