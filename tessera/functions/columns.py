"""Scalar column expressions used across operators and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.schema import STEPS


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / denominator.cast("double")
    )


def text_or_null(value: Column) -> Column:
    """Trimmed text; empty becomes null."""
    return F.nullif(F.trim(value), F.lit(""))


def first_non_zero(*values: Column) -> Column:
    """First value that is neither null nor 0, else 0."""
    return F.coalesce(*[F.nullif(v, F.lit(0).cast("bigint")) for v in values], F.lit(0).cast("bigint"))


def size_text(size: Column) -> Column:
    """Byte count as readable text, for instance ``58.65 GB``."""
    # Unit sizes, largest first.
    units = (("TB", 1 << 40), ("GB", 1 << 30), ("MB", 1 << 20), ("KB", 1 << 10))
    text = F.when(size.isNull(), F.lit(None).cast("string"))
    for unit, step in units:
        text = text.when(size >= step, F.format_string(f"%.2f {unit}", size / F.lit(float(step))))
    return text.otherwise(F.format_string("%d B", size))


def short_number(value: Column, billions: bool = True) -> Column:
    """Count shortened to K, M or B with one decimal; a dash for null."""
    v = value.cast("double")
    text = F.when(value.isNull(), F.lit("—"))
    if billions:
        text = text.when(v >= 1e9, F.format_string("%.1fB", v / 1e9))
    return (
        text.when(v >= 1e6, F.format_string("%.1fM", v / 1e6))
        .when(v >= 1e3, F.format_string("%.1fK", v / 1e3))
        .otherwise(value.cast("string"))
    )


def percent(value: Column) -> Column:
    """Fraction as a percentage with one decimal; a dash for null."""
    return F.when(value.isNull(), F.lit("—")).otherwise(F.format_string("%.1f%%", value * 100.0))


# Citation patterns.
DOI_PATTERN = r"doi\.org/(10\.\d{4,}/[^\s<>\"']+)"
PMID_PATTERN = r"PMID:\s*(\d+)"
NO_CITATION = "Citation missing"


def citation(text: Column) -> Column:
    """DOI found in a page, else ``PMID:<n>``, else null."""
    doi = F.regexp_extract(text, DOI_PATTERN, 1)
    pmid = F.regexp_extract(text, PMID_PATTERN, 1)
    return (
        F.when(text.contains(NO_CITATION), F.lit(None).cast("string"))
        .when(doi != "", doi)
        .when(pmid != "", F.concat(F.lit("PMID:"), pmid))
    )


def run_key(*parameters: Column) -> Column:
    """Short stable key of a parameter combination."""
    return F.substring(F.sha1(F.concat_ws("|", *[p.cast("string") for p in parameters])), 1, 12)


def run_step(directory: Column) -> Column:
    """Step that a ``<step>_<backend>`` directory belongs to, else empty text."""
    return F.regexp_extract(directory, _RUN_DIRECTORY, 1)


def run_backend(directory: Column) -> Column:
    """Backend part of a ``<step>_<backend>`` directory, else empty text."""
    return F.regexp_extract(directory, _RUN_DIRECTORY, 2)


# Longest step first, so that a step never shadows one that it is a prefix of.
_RUN_DIRECTORY = "^(" + "|".join(sorted(STEPS, key=len, reverse=True)) + ")_(.+)$"


def is_identifier(value: Column) -> Column:
    """Only letters, digits, underscore, dot and dash."""
    return value.rlike(r"^[A-Za-z0-9_.\-]+$")


def polygon_wkt(vertices: Column) -> Column:
    """Closed ``POLYGON`` text from an array of (x, y) structs."""
    ring = F.concat(vertices, F.slice(vertices, 1, 1))
    pairs = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(pairs, ", "), F.lit("))"))
