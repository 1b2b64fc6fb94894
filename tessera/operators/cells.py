"""Cell tables and the sparse cell-by-gene matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.runtime import cut
from tessera.schema import find_column, need_column


def cell_gene_counts(df: DataFrame) -> DataFrame:
    """Long cell-by-gene counts; only pairs that occur."""
    cell, gene = need_column(df, "cell_id"), need_column(df, "gene")
    return (
        df.filter(F.col(cell).isNotNull())
        .groupBy(F.col(cell).cast("string").alias("cell_id"), F.col(gene).cast("string").alias("gene"))
        .agg(F.count("*").alias("count"))
    )


def cell_summary(df: DataFrame, row: str = "row_id") -> DataFrame:
    """Transcripts, genes, centroid and first field of view of each cell."""
    cell, gene = need_column(df, "cell_id"), need_column(df, "gene")
    x, y, fov = need_column(df, "x"), need_column(df, "y"), find_column(df, "fov")
    aggregates = [
        F.count("*").alias("n_transcripts"),
        F.countDistinct(gene).alias("n_genes"),
        F.avg(x).alias("x"),
        F.avg(y).alias("y"),
    ]
    if fov is not None and row in df.columns:
        aggregates.append(F.min_by(fov, F.when(F.col(fov).isNotNull(), F.col(row))).alias("fov"))
    return (
        df.filter(F.col(cell).isNotNull())
        .groupBy(F.col(cell).cast("string").alias("cell_id"))
        .agg(*aggregates)
    )


def centroid_points(cells: DataFrame) -> DataFrame:
    """One point per cell."""
    return cells.select("x", "y", "cell_id")


def qc_per_cell(counts: DataFrame) -> DataFrame:
    """Total counts and detected genes per cell."""
    return counts.groupBy("cell_id").agg(
        F.sum("count").cast("bigint").alias("total_counts"),
        F.sum((F.col("count") > 0).cast("bigint")).alias("n_genes_by_counts"),
    )


def qc_per_gene(counts: DataFrame) -> DataFrame:
    """Cells with the gene, mean count, share of cells without it and total, per gene."""
    n_cells = counts.agg(F.countDistinct("cell_id").alias("__cells"))
    per_gene = counts.groupBy("gene").agg(
        F.sum((F.col("count") > 0).cast("bigint")).alias("n_cells_by_counts"),
        F.sum("count").cast("bigint").alias("total_counts"),
    )
    return per_gene.join(F.broadcast(n_cells), F.lit(True)).select(
        "gene",
        "n_cells_by_counts",
        (F.col("total_counts") / F.col("__cells")).alias("mean_counts"),
        ((F.lit(1.0) - F.col("n_cells_by_counts") / F.col("__cells")) * 100.0).alias("pct_dropout_by_counts"),
        "total_counts",
    )


def qc_filter(cells: DataFrame, min_transcripts: int = 10, min_genes: int = 10,
              transcripts: str = "n_transcripts", genes: str = "n_genes") -> DataFrame:
    """Cells with enough transcripts and genes."""
    return cells.filter((F.col(transcripts) >= min_transcripts) & (F.col(genes) >= min_genes))


def qc_filter_relaxed(cells: DataFrame, min_transcripts: int = 10, min_genes: int = 10,
                      transcripts: str = "n_transcripts", genes: str = "n_genes") -> tuple[DataFrame, DataFrame]:
    """QC filter that retries with one gene when nothing passes.

    Returns the cells kept and a one-row record of what was applied.
    """
    enough = F.col(transcripts) >= min_transcripts
    seen = cells.agg(
        F.count("*").alias("before"),
        F.count_if(enough & (F.col(genes) >= min_genes)).alias("strict"),
        F.count_if(enough & (F.col(genes) >= 1)).alias("relaxed"),
    ).first()
    relax = seen["strict"] == 0 and seen["relaxed"] > 0
    applied = 1 if relax else min_genes
    record = cells.sparkSession.createDataFrame(
        [(
            seen["before"],
            seen["relaxed"] if relax else seen["strict"],
            min_transcripts,
            min_genes,
            applied,
            relax,
            f"min_genes={min_genes} filtered all cells" if relax else None,
        )],
        "n_obs_before_qc long, n_obs_after_qc long, min_transcripts int, min_genes_original int, "
        "min_genes_applied int, auto_relax_applied boolean, auto_relax_reason string",
    )
    return cells.filter(enough & (F.col(genes) >= applied)), record


def enough_cells(cells: DataFrame, least: int = 2) -> bool:
    """Are there at least ``least`` cells to analyse?"""
    return cells.limit(least).count() >= least


def sparsity(counts: DataFrame) -> DataFrame:
    """Share of empty entries of the cell-by-gene matrix."""
    # Two distinct counts in one aggregate would move every entry for each of them.
    counts = cut(counts.select("cell_id", "gene", (F.col("count") > 0).alias("positive")))
    cells = counts.groupBy("cell_id").agg(F.count_if("positive").alias("n")).agg(
        F.count("cell_id").alias("n_cells"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_positive")
    )
    genes = counts.select("gene").distinct().agg(F.count("gene").alias("n_genes"))
    return cells.crossJoin(F.broadcast(genes)).select(  # one row each
        "n_cells",
        "n_genes",
        "n_positive",
        (F.lit(1.0) - F.col("n_positive") / (F.col("n_cells") * F.col("n_genes"))).alias("sparsity"),
    )


def choose_clustering(counts: DataFrame, requested: str = "leiden", few: int = 500, sparse: float = 0.99) -> tuple[str, str | None]:
    """Clustering method to use and, if it differs from ``requested``, why.

    Few and almost empty cells give no useful neighbour graph.
    """
    s = sparsity(counts).first()
    if requested == "leiden" and s["n_cells"] < few and s["sparsity"] is not None and s["sparsity"] > sparse:
        return "kmeans", f"sparsity={s['sparsity']:.2%} > {sparse:.0%} threshold"
    return requested, None


def with_stats(cells: DataFrame, stats: DataFrame, defaults: dict) -> DataFrame:
    """Per-cell statistics joined back; cells without any get ``defaults``."""
    return cells.join(stats, "cell_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    )


def common_cells(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose cell also occurs in ``right``; two cells are needed."""
    both = left.join(right.select("cell_id").distinct(), "cell_id", "left_semi")
    if both.select("cell_id").distinct().limit(2).count() < 2:
        raise ValueError("fewer than 2 common cells")
    return both


def cell_id_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cell ids in both tables."""
    return left.select("cell_id").intersect(right.select("cell_id"))
