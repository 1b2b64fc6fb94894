"""Denoising, cell assignment and summaries of transcript tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.schema import INTRACELLULAR, InputError, find_column, need_column


def valid_cell_id(cell: Column) -> Column:
    """A cell id that is not a placeholder."""
    return cell.isNotNull() & ~F.trim(cell).isin("", "nan", "None", "0")


def has_valid_cell_id(df: DataFrame) -> DataFrame:
    """One row: does any transcript have a meaningful cell id?"""
    name = find_column(df, "cell_id")
    if name is None:
        return df.agg(F.lit(False).alias("has_cell_id"))
    return df.agg(F.coalesce(F.bool_or(valid_cell_id(F.col(name))), F.lit(False)).alias("has_cell_id"))


def has_valid_compartment(df: DataFrame) -> DataFrame:
    """One row: is any transcript nuclear or cytoplasmic?"""
    name = find_column(df, "CellComp")
    if name is None:
        return df.agg(F.lit(False).alias("has_compartment"))
    known = F.coalesce(F.col(name).isin(*INTRACELLULAR), F.lit(False))
    return df.agg(F.coalesce(F.bool_or(known), F.lit(False)).alias("has_compartment"))


def denoise(df: DataFrame, method: str = "intracellular") -> DataFrame:
    """Keep transcripts inside the cell (``intracellular``) or nucleus (``nuclear_only``).

    A table without any known compartment passes through, as does ``none``.
    """
    keep = {"none": None, "intracellular": INTRACELLULAR, "nuclear_only": ("Nuclear",)}
    if method not in keep:
        raise InputError(f"unknown denoise method '{method}'; known: {sorted(keep)}")
    name = find_column(df, "CellComp")
    if keep[method] is None or name is None:
        return df
    known = df.filter(F.col(name).isin(*INTRACELLULAR)).limit(1)
    if known.isEmpty():
        return df
    return df.filter(F.col(name).isin(*keep[method]))


def denoise_summary(before: DataFrame, after: DataFrame, method: str) -> DataFrame:
    """Rows before and after denoising and the share dropped."""
    sizes = (
        before.select(F.lit(1).alias("b"), F.lit(0).alias("a"))
        .unionAll(after.select(F.lit(0).alias("b"), F.lit(1).alias("a")))
        .agg(F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"))
    )
    b, a = F.col("b").cast("bigint"), F.col("a").cast("bigint")
    return sizes.select(
        F.lit(method).alias("denoise_backend"),
        b.alias("before_transcripts"),
        a.alias("after_transcripts"),
        (b - a).alias("dropped_transcripts"),
        safe_ratio(b - a, b).alias("drop_ratio"),
    )


def provided_cells(df: DataFrame) -> DataFrame:
    """Transcripts that come with a cell id; the id ``0`` is kept."""
    cell = F.col(need_column(df, "cell_id"))
    return df.filter(cell.isNotNull() & (cell.cast("string") != ""))


def fov_cells(df: DataFrame) -> DataFrame:
    """Cell ids made unique by field of view; a null id stays null."""
    cell, fov = need_column(df, "cell_id"), need_column(df, "fov")
    return df.withColumn(cell, F.concat(F.col(fov).cast("string"), F.lit("_"), F.col(cell).cast("string")))


def mask_cells(df: DataFrame, mask: DataFrame, prefix: str = "cellpose_") -> DataFrame:
    """Cell of each transcript from a label raster ``(y, x, mask_id)``.

    Coordinates round half to even; background and pixels outside are dropped.
    """
    cell = need_column(df, "cell_id")
    x, y = F.col(need_column(df, "x")), F.col(need_column(df, "y"))
    labels = mask.filter(F.col("mask_id") > 0).select(
        F.col("x").cast("bigint").alias("__px"),
        F.col("y").cast("bigint").alias("__py"),
        F.concat(F.lit(prefix), F.col("mask_id").cast("string")).alias("__label"),
    )
    return (
        df.withColumn("__px", F.rint(x).cast("bigint"))
        .withColumn("__py", F.rint(y).cast("bigint"))
        .join(labels, ["__px", "__py"])
        .withColumn(cell, F.col("__label"))
        .drop("__px", "__py", "__label")
    )


def external_cells(df: DataFrame, assignment: DataFrame, row: str = "row_id", prefix: str = "baysor_") -> DataFrame:
    """Cells of an external segmenter, joined by row id; label 0 is noise."""
    # Accepted label columns, in order of preference.
    names = ("cell", "segmentation", "cluster", "assignment")
    label = next((n for n in names if n in assignment.columns), None)
    if label is None:
        raise InputError(f"assignment needs one of {names}")
    cell = need_column(df, "cell_id")
    labels = assignment.filter(F.col(label).isNotNull() & (F.col(label).cast("string") != "0")).select(
        F.col(row), F.concat(F.lit(prefix), F.col(label).cast("string")).alias("__label")
    )
    return df.join(labels, row).withColumn(cell, F.col("__label")).drop("__label")


def segmentation_summary(df: DataFrame, method: str) -> DataFrame:
    """Assigned transcripts and distinct cells."""
    return df.agg(
        F.lit(method).alias("segmentation_backend"),
        F.count("*").alias("n_transcripts_assigned"),
        F.countDistinct(need_column(df, "cell_id")).alias("n_cells_assigned"),
    )


def ingestion_summary(df: DataFrame, platform: str = "unknown") -> DataFrame:
    """Counts of transcripts, cells, genes and fields of view; compartment shares where known."""
    cell, gene = F.col("cell_id"), F.col("gene")
    totals = df.agg(
        F.count("*").alias("n_transcripts"),
        F.countDistinct("cell_id").alias("cells"),
        F.bool_or(valid_cell_id(cell)).alias("has_cell_id"),
        F.countDistinct(gene).alias("n_genes"),
        F.countDistinct("fov").alias("n_fovs"),
        F.avg(F.coalesce((F.col("CellComp") == "Nuclear").cast("double"), F.lit(0.0))).alias("nuclear"),
        F.avg(F.coalesce((F.col("CellComp") == "Cytoplasm").cast("double"), F.lit(0.0))).alias("cytoplasm"),
        F.bool_or(F.coalesce(F.col("CellComp").isin(*INTRACELLULAR), F.lit(False))).alias("has_compartment"),
    )
    return totals.select(
        F.lit(platform).alias("platform"),
        "n_transcripts",
        F.when(F.col("has_cell_id"), F.col("cells")).otherwise(F.lit(0)).cast("bigint").alias("n_cells"),
        "n_genes",
        "n_fovs",
        F.when(F.col("has_compartment"), F.col("nuclear")).alias("nuclear_fraction"),
        F.when(F.col("has_compartment"), F.col("cytoplasm")).alias("cytoplasm_fraction"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; null counts as the text ``nan``."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("nan"))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def fractions(df: DataFrame, column: str) -> DataFrame:
    """Share of rows per value."""
    counts = distribution(df, column)
    total = counts.agg(F.sum("n").alias("__total"))
    # The total is one row, so the broadcast is bounded.
    return counts.join(F.broadcast(total), F.lit(True)).select(
        "value", safe_ratio(F.col("n"), F.col("__total")).alias("fraction")
    )


def top_slices(counts: DataFrame, label: str = "value", n: str = "n", largest: int = 6) -> DataFrame:
    """The ``largest`` values by count, the rest summed as ``Other``, with shares."""
    top = counts.orderBy(F.col(n).desc(), F.col(label)).limit(largest).select(label, n)
    total = counts.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("__total"))
    kept = top.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("__kept"))
    rest = (
        total.join(F.broadcast(kept), F.lit(True))
        .select(F.lit("Other").alias(label), (F.col("__total") - F.col("__kept")).alias(n))
        .filter(F.col(n) > 0)
    )
    slices = top.unionByName(rest)
    return slices.join(F.broadcast(total), F.lit(True)).select(
        label, F.col(n).cast("bigint").alias(n), safe_ratio(F.col(n), F.col("__total")).alias("fraction")
    )
