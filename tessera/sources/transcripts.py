"""Instrument files as one canonical transcript table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schema import OPTIONAL, REQUIRED, InputError

# Native column per canonical column, in order of preference.
NATIVE_COLUMNS = {
    "cosmx": (
        ("x_global_px", "x"),
        ("y_global_px", "y"),
        ("target", "gene"),
        ("cell", "cell_id"),
        ("fov", "fov"),
        ("CellComp", "CellComp"),
    ),
    "xenium": (
        ("x_location", "x"),
        ("y_location", "y"),
        ("z_location", "z"),
        ("feature_name", "gene"),
        ("cell_id", "cell_id"),
        ("fov_name", "fov"),
        ("qv", "qv"),
    ),
    "merfish": (
        ("global_x", "x"),
        ("global_y", "y"),
        ("gene", "gene"),
        ("barcode_id", "cell_id"),
        ("fov", "fov"),
        ("global_z", "z"),
        ("z", "z"),
    ),
    "stereoseq": (
        ("x", "x"),
        ("y", "y"),
        ("geneID", "gene"),
        ("cell_id", "cell_id"),
        ("MIDCounts", "mid_counts"),
    ),
}

# Column sets that identify a platform, first match wins.
SIGNATURES = (
    ({"x_location", "y_location", "feature_name", "cell_id"}, "xenium"),
    ({"x", "y", "feature_name", "cell_id"}, "xenium"),
    ({"x_global_px", "y_global_px", "target"}, "cosmx"),
    ({"global_x", "global_y", "gene", "barcode_id"}, "merfish"),
    ({"x", "y", "gene", "barcode_id"}, "merfish"),
    ({"geneID", "x", "y"}, "stereoseq"),
)

# Texts that a delimited file uses for a missing value.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _suffixes(path: str) -> list[str]:
    return path.rstrip("/").rsplit("/", 1)[-1].lower().split(".")[1:]


def _separator(path: str) -> str:
    return "\t" if {"gem", "tsv"} & set(_suffixes(path)) else ","


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Text columns of a delimited file (gzip by suffix), no inference pass."""
    raw = spark.read.csv(path, header=True, sep=_separator(path), quote='"', escape='"')
    kept = [c for c in raw.columns if c and c not in ("Unnamed: 0", "_c0")]
    return raw.select(
        *[F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c) for c in kept]
    )


def platform_of_columns(columns) -> str | None:
    """Platform whose signature the column names satisfy."""
    present = set(columns)
    return next((name for needed, name in SIGNATURES if needed <= present), None)


def detect_platform(spark: SparkSession, path: str) -> str:
    """Platform by file suffix, else by the header."""
    suffixes = _suffixes(path)
    if suffixes and suffixes[-1] == "parquet":
        return "xenium"
    if suffixes and suffixes[-1] == "gem":
        return "stereoseq"
    found = platform_of_columns(read_delimited(spark, path).columns)
    if found is None:
        raise InputError(f"cannot tell the platform of {path}; name one of {sorted(NATIVE_COLUMNS)}")
    return found


def _require(df: DataFrame, needed, platform: str) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise InputError(f"[{platform}] missing columns {missing}; present: {sorted(df.columns)}")


def scan_cosmx(spark: SparkSession, path: str) -> DataFrame:
    raw = read_delimited(spark, path)
    _require(raw, ("x_global_px", "y_global_px", "target"), "cosmx")
    return raw


def scan_xenium(spark: SparkSession, path: str) -> DataFrame:
    is_parquet = _suffixes(path)[-1:] == ["parquet"]
    raw = spark.read.parquet(path) if is_parquet else read_delimited(spark, path)
    if "x_location" not in raw.columns and "x" in raw.columns and "y" in raw.columns:
        raw = raw.withColumnsRenamed({"x": "x_location", "y": "y_location"})
    _require(raw, ("x_location", "y_location", "feature_name", "cell_id"), "xenium")
    return raw


def scan_merfish(spark: SparkSession, path: str) -> DataFrame:
    raw = read_delimited(spark, path)
    if {"global_x", "global_y"} <= set(raw.columns):
        raw = raw.drop("x", "y")
    elif {"x", "y"} <= set(raw.columns):
        raw = raw.withColumnsRenamed({"x": "global_x", "y": "global_y"})
    _require(raw, ("global_x", "global_y", "gene"), "merfish")
    return raw


def scan_stereoseq(spark: SparkSession, path: str) -> DataFrame:
    raw = read_delimited(spark, path)
    _require(raw, ("x", "y", "geneID" if "geneID" in raw.columns else "gene"), "stereoseq")
    return raw


SCANS = {
    "cosmx": scan_cosmx,
    "xenium": scan_xenium,
    "merfish": scan_merfish,
    "stereoseq": scan_stereoseq,
}


def standardise_columns(df: DataFrame, platform: str | None = None, cell_id_column: str | None = None) -> DataFrame:
    """Native names to canonical names; missing optional columns get defaults.

    ``cell_id_column`` replaces the default cell column of a platform.  As in
    the file formats, a native ``cell_id`` column keeps its place except for
    merfish, where the chosen column is the cell column.
    """
    pairs = list(NATIVE_COLUMNS.get(platform, ()))
    if cell_id_column and cell_id_column in df.columns and (platform == "merfish" or "cell_id" not in df.columns):
        pairs = [(cell_id_column, "cell_id"), *[p for p in pairs if p[1] != "cell_id"]]
    source_of: dict[str, str] = {}
    for native, canonical in pairs:
        if native in df.columns:
            source_of.setdefault(canonical, native)
    for canonical in (*REQUIRED, *OPTIONAL):
        if canonical in df.columns and canonical not in source_of.values():
            source_of.setdefault(canonical, canonical)
    defaults = {
        "cell_id": F.lit(None).cast("string"),
        "fov": F.lit("0"),
        "CellComp": F.lit("Unknown"),
        "qv": F.lit(None).cast("double"),
        "z": F.lit(None).cast("double"),
    }
    rest = [c for c in df.columns if c not in source_of.values() and c not in source_of and c not in defaults]
    return df.select(
        *[F.col(f"`{native}`").alias(canonical) for canonical, native in source_of.items()],
        *[value.alias(name) for name, value in defaults.items() if name not in source_of],
        *[F.col(f"`{c}`") for c in rest],
    )


def to_points(df: DataFrame) -> DataFrame:
    """Known columns with their types; coordinates that are no number become null."""
    types = {"x": "double", "y": "double", "z": "double", "qv": "double"}
    order = ("row_id", "x", "y", "gene", "z", "cell_id", "fov", "CellComp", "qv")
    return df.select(
        *[
            F.col(c) if c == "row_id" else F.col(c).cast("string").try_cast(types.get(c, "string")).alias(c)
            for c in order
            if c in df.columns
        ]
    )


def check_points(df: DataFrame, platform: str = "input") -> DataFrame:
    """Required columns are there and at least one row is."""
    _require(df, REQUIRED, platform)
    if df.isEmpty():
        raise InputError(f"[{platform}] the transcript table is empty")
    return df


def ingest(spark: SparkSession, path: str, platform: str | None = None, cell_id_column: str | None = None) -> DataFrame:
    """Canonical transcripts of one instrument file or folder.

    ``row_id`` follows the scan order (file split, then position).
    """
    platform = platform or detect_platform(spark, path)
    if platform not in SCANS:
        raise InputError(f"unknown platform '{platform}'; known: {sorted(SCANS)}")
    points = to_points(standardise_columns(SCANS[platform](spark, path), platform, cell_id_column))
    return check_points(points, platform).withColumn("row_id", F.monotonically_increasing_id())


def split_counts(df: DataFrame, largest: int, count: str = "count") -> tuple[DataFrame, DataFrame]:
    """Rows whose count is at most ``largest``, and those that are above it."""
    above = F.coalesce(F.col(count).try_cast("double") > largest, F.lit(False))
    return df.filter(~above), df.filter(above)


def expand_counts(df: DataFrame, count: str = "count") -> DataFrame:
    """One row of count 1 per counted molecule; counts below 1 and what is no number give none.

    Every count is expanded.  ``split_counts`` takes rows of unlikely counts
    aside where they are to be looked at first.
    """
    n = F.col(count).try_cast("double").cast("bigint")
    return (
        df.filter(n > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), n)))
        .drop("__copy")
        .withColumn(count, F.lit(1).cast("bigint"))
    )


def first_cells(df: DataFrame, n: int = 1000, cell: str = "cell_id", row: str = "row_id") -> DataFrame:
    """All rows of the first ``n`` distinct cells in row order."""
    leading = (
        df.filter(F.col(cell).isNotNull())
        .groupBy(cell)
        .agg(F.min(row).alias("__first"))
        .orderBy("__first", cell)
        .limit(n)
    )
    return df.join(leading, cell, "left_semi")
