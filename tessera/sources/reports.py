"""Run reports: scanning, merging and summarising them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import first_non_zero, percent, run_backend, run_step, safe_ratio, short_number

# Parameters of a run that its listing shows.
RUN_PARAMETERS = (
    "denoise_backend",
    "segmentation_backend",
    "clustering_backend",
    "annotation_backend",
    "spatial_domain_backend",
    "input_csv",
)


def scan_reports(spark: SparkSession, root: str, pattern: str = "*_report.json") -> DataFrame:
    """First report of each run directory: ``run_name, path, report``.

    Run directories lie one or two levels below ``root``.  ``report`` is a
    variant; files that are no JSON are left out.
    """
    files = spark.read.text(root, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value")
    )
    base = root.rstrip("/").split("://")[-1].removeprefix("file:")
    return first_reports(files.withColumn("below", F.substring_index(F.col("path"), base + "/", -1)))


def first_reports(files: DataFrame) -> DataFrame:
    """First report of each run directory among ``path, value, below``, where ``below`` is the path from the root."""
    named = files.withColumn("run_name", F.regexp_replace("below", "/[^/]*$", "")).filter(F.size(F.split("run_name", "/")) <= 2)
    first = named.groupBy("run_name").agg(F.min("path").alias("path"), F.min_by("value", "path").alias("value"))
    return first.select("run_name", "path", F.try_parse_json("value").alias("report")).filter("report is not null")


def write_bundle(reports: DataFrame, path: str) -> None:
    """Report files ``path, value`` as rows of a table: a file for each costs more to write and list than it holds."""
    reports.select("path", "value").write.parquet(path)


def scan_bundle(spark: SparkSession, path: str) -> DataFrame:
    """:func:`scan_reports` over the files held by a bundle, whose paths start at the root."""
    return first_reports(spark.read.parquet(path).withColumn("below", F.col("path")))


def _get(path: str, kind: str = "string"):
    return F.try_variant_get("report", path, kind)


def list_runs(reports: DataFrame) -> DataFrame:
    """Listing of runs; sizes come from the first field that has one."""
    def size(*names: str):
        return first_non_zero(*[_get(n, "bigint") for n in names])

    return reports.select(
        "run_name",
        "path",
        F.coalesce(_get("$.parameters.created_at"), _get("$.parameters.timestamp")).alias("created_at"),
        size("$.analysis_summary.n_cells", "$.metadata.n_cells", "$.n_cells", "$.n_obs").alias("n_cells"),
        size("$.analysis_summary.n_genes", "$.metadata.n_genes", "$.n_genes", "$.n_vars").alias("n_genes"),
        *[_get(f"$.parameters.{p}").alias(p) for p in RUN_PARAMETERS],
    )


def read_benchmark(spark: SparkSession, summaries: list[str], reports: DataFrame) -> DataFrame:
    """Summary files where there are any, else the individual reports, as JSON text."""
    if summaries:
        return spark.read.text(summaries, wholetext=True).select(
            F.col("_metadata.file_path").alias("source"), F.to_json(F.try_parse_json("value")).alias("document")
        )
    return reports.select(F.col("path").alias("source"), F.to_json("report").alias("document"))


def stats_by_backend(reports: DataFrame) -> DataFrame:
    """Layer evaluation and step summary of each ``<step>_<backend>`` run, as JSON text."""
    name = F.substring_index("run_name", "/", -1)
    tagged = reports.withColumns({"step": run_step(name), "backend": run_backend(name)}).filter("step <> ''")

    def part(section: str):
        return F.call_function("get_json_object", F.to_json("report"), F.concat(F.lit(f"$.{section}."), F.col("step")))

    return tagged.select("step", "backend", part("layer_evaluation").alias("layer_evaluation"), part("step_summary").alias("step_summary"))


def nest_by_step(stats: DataFrame, value: str) -> DataFrame:
    """One row per step with a map from backend to value; a step has a handful of backends."""
    return stats.groupBy("step").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("backend", value)))).alias("backends"))


def report_metrics(reports: DataFrame) -> DataFrame:
    """Headline numbers of each report."""
    layer = "$.layer_evaluation"

    def number(path: str):
        return F.coalesce(_get(f"{layer}.{path}", "bigint"), F.lit(0))

    return reports.select(
        "run_name",
        number("expression.n_cells_after_qc").alias("n_cells"),
        number("expression.n_genes_after_hvg").alias("n_genes"),
        number("clustering.n_clusters").alias("n_clusters"),
        number("spatial_domain.n_spatial_domains").alias("n_domains"),
        number("subcellular_spatial_domain.n_cells_with_multiple_domains").alias("n_multi_domain_cells"),
    )


def validation_totals(results: DataFrame) -> DataFrame:
    """Runs passed, failed and in all, and the seconds they took."""
    return results.agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.round(F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)), 1).alias("total_elapsed_seconds"),
    )


def validation_details(results: DataFrame, reports: DataFrame, key: str = "run_name") -> DataFrame:
    """Each run with its report, where there is one."""
    return results.join(reports, key, "left")


def platform_summary(results: DataFrame) -> DataFrame:
    """Runs and seconds by platform and status, with totals per platform and over all."""
    return results.rollup("platform", "status").agg(
        F.count("*").alias("n_runs"), F.sum("elapsed_seconds").alias("elapsed_seconds")
    )


def step_metrics(summary: DataFrame) -> DataFrame:
    """Shown metrics of each step: ``step, backend, metric, value``.

    ``summary`` has ``step`` and ``entries``, a map from key to text.  Private,
    backend and distribution keys are left out, as are skipped steps.
    """
    suffixes = ("_backend", "_backend_used", "_backend_requested", "_distribution")
    backend = F.element_at(
        F.map_values(F.map_filter("entries", lambda k, v: k.endswith("_backend") | k.endswith("_backend_used"))), 1
    )
    told = summary.withColumn("backend", F.when(F.size(F.map_filter("entries", lambda k, v: k.endswith("_backend") | k.endswith("_backend_used"))) > 0, backend).otherwise("—"))
    shown = told.filter(~((F.col("backend") == "none") & F.coalesce(F.element_at("entries", F.lit("skipped")) == "true", F.lit(False))))
    flat = shown.select("step", "backend", F.explode("entries").alias("key", "text"))
    hidden = F.col("key").startswith("__") | (F.col("key") == "skipped")
    for s in suffixes:
        hidden = hidden | F.col("key").endswith(s)
    number = F.col("text").try_cast("double")
    whole = F.when(number == F.floor(number), F.col("text").try_cast("bigint"))
    share = F.col("key").contains("ratio") | F.col("key").contains("fraction")
    value = (
        F.when(number.isNull(), F.col("text"))
        .when(share, percent(number))
        .when(number >= 1000, short_number(number, billions=False))
        .otherwise(F.coalesce(whole.cast("string"), F.col("text")))
    )
    return flat.filter(~hidden).select("step", "backend", F.replace("key", F.lit("_"), F.lit(" ")).alias("metric"), value.alias("value"))


def silhouette_ranking(scores: DataFrame) -> DataFrame:
    """``step, backend, value`` from best to worst with the share of the best (at least 1)."""
    best = scores.agg(F.greatest(F.max("value"), F.lit(1.0)).alias("__best"))
    return (
        scores.join(F.broadcast(best), F.lit(True))
        .select("step", "backend", "value", safe_ratio(F.col("value"), F.col("__best")).alias("relative"))
        .orderBy(F.col("value").desc(), "step", "backend")
    )


def scatter_stats(points: DataFrame, color: str) -> DataFrame:
    """Count, bounds and number of colours of a scatter plot."""
    return points.agg(
        F.count("*").alias("count"),
        F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"),
        F.countDistinct(F.coalesce(F.col(color).cast("string"), F.lit("unknown"))).alias("unique_colors"),
    )


def scatter_points(points: DataFrame, color: str) -> DataFrame:
    """Points of a scatter plot."""
    return points.select("x", "y", F.coalesce(F.col(color).cast("string"), F.lit("unknown")).alias("color"), F.col("cell_id").cast("string").alias("cell_id"))


def cell_detail(t: DataFrame, cell_id: str, gene: str | None = None) -> DataFrame:
    """Transcripts of one cell, optionally of one gene; the filters reach the file scan."""
    rows = t.filter(F.col("cell_id") == cell_id)
    if gene:
        rows = rows.filter(F.col("gene") == gene)
    domain = F.col("subcellular_domain") if "subcellular_domain" in t.columns else F.lit(None).cast("string")
    return rows.select(
        "x", "y",
        F.coalesce(domain, F.lit("0")).alias("subcellular_domain"),
        F.coalesce("gene", F.lit("unknown")).alias("gene"),
        F.coalesce("CellComp", F.lit("unknown")).alias("cellcomp"),
        F.coalesce(F.col("fov").cast("string").try_cast("int"), F.lit(-1)).alias("fov"),
    )


def cell_overview(detail: DataFrame) -> DataFrame:
    """Transcripts, genes in order and bounds of :func:`cell_detail`; zeros if empty."""
    return detail.agg(
        F.count("*").alias("n_transcripts"),
        F.array_join(F.sort_array(F.collect_set("gene")), ",").alias("genes"),
        *[F.coalesce(f(c), F.lit(0.0)).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))],
    )


def counts_of(detail: DataFrame, column: str) -> DataFrame:
    """Rows per gene or domain of one cell, most frequent first."""
    return detail.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "value")
