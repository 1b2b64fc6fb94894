"""Writers for processed tables and reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import polygon_wkt
from tessera.runtime import number_rows


def write_transcripts(t: DataFrame, path: str, partition_by: str | None = None) -> None:
    """All labelled transcripts as Parquet."""
    writer = t.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def cell_export(cells: DataFrame, coordinates: DataFrame | None = None) -> DataFrame:
    """Cell table with coordinates."""
    if coordinates is None:
        return cells
    return cells.drop("x", "y").join(coordinates.select("cell_id", "x", "y"), "cell_id")


def sample_size(n: int, ratio: float = 0.01) -> int:
    """Rows in a transcript sample of a table of ``n``."""
    return min(n, max(1000, int(n * ratio)))


def transcript_sample(t: DataFrame, ratio: float = 0.01, seed: int = 0, row: str = "row_id") -> DataFrame:
    """Repeatable sample: the rows of smallest seeded hash.

    Only rows below a bound on the hash that all but surely covers the sample
    are sorted; should it not, the whole table is.
    """
    n = t.count()
    size = sample_size(n, ratio)
    columns = [c for c in ("x", "y", "gene", "cell_id", "CellComp") if c in t.columns]
    hashed = t.select(*columns, row, F.md5(F.concat_ws(":", F.col(row), F.lit(seed)).cast("binary")).alias("__h"))
    share = (size + 8 * math.sqrt(size) + 64) / max(n, 1)
    low = F.conv(F.substring("__h", 1, 8), 16, 10).cast("bigint") <= F.lit(int(share * 2**32))
    placed = number_rows(hashed.filter(low), F.col("__h"), F.col(row), name="__at")
    if placed.count() < size:
        placed = number_rows(hashed, F.col("__h"), F.col(row), name="__at")
    return placed.filter(F.col("__at") <= size).select(*columns)


def embedding_export(df: DataFrame, vector: str, id: str = "cell_id", dims: int = 3) -> DataFrame:
    """First dimensions of an embedding as columns ``dim0`` and on."""
    return df.select(id, *[F.get(F.col(vector), i).cast("double").alias(f"dim{i}") for i in range(dims)])


def boundary_export(boundaries: DataFrame) -> DataFrame:
    """Essential columns of cell outlines with the polygon as text."""
    return boundaries.select(
        "cell_id", "area", "centroid_x", "centroid_y", "n_transcripts", polygon_wkt(F.col("geometry")).alias("geometry_wkt")
    )


def one_row(df: DataFrame, name: str) -> DataFrame:
    """``df`` if it has one row."""
    if len(df.select(F.lit(1)).limit(2).collect()) != 1:
        raise ValueError(f"'{name}' must have one row")
    return df


def as_map(counts: DataFrame, key: str = "value", n: str = "n") -> DataFrame:
    """Counts as one row holding a map, which is as long as there are keys: for counts of labels in a report."""
    return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, n)))).alias("counts"))


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """One row with a struct per section; every section is a one-row table."""
    whole = None
    for name, df in sections.items():
        one = one_row(df, name).select(F.struct(*df.columns).alias(name))
        whole = one if whole is None else whole.join(F.broadcast(one), F.lit(True))
    return whole


def write_report(whole: DataFrame, path: str) -> None:
    """A report as one JSON document."""
    whole.coalesce(1).write.mode("overwrite").json(path)


def write_results(parts: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each part of the results as JSON documents in a folder of its own; the folders."""
    paths = {}
    for name, df in parts.items():
        paths[name] = f"{folder.rstrip('/')}/{name}.json"
        df.write.mode("overwrite").json(paths[name])
    return paths


def results_summary(platform: str, layers: dict[str, list[str]], totals: DataFrame, labels: dict[str, DataFrame]) -> DataFrame:
    """Layers of a result with cell and gene totals and the counts of each labelling."""
    spark = totals.sparkSession
    head = spark.createDataFrame([(platform, *layers.values())], "platform string, " + ", ".join(f"{k} array<string>" for k in layers))
    whole = head.join(F.broadcast(one_row(totals, "totals")), F.lit(True))
    for name, counts in labels.items():
        whole = whole.join(F.broadcast(as_map(counts).withColumnRenamed("counts", name)), F.lit(True))
    return whole
