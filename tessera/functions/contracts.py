"""Data contracts between steps, as tables of what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

from tessera.runtime import new_path
from tessera.schema import find_column

# What each step needs from the tables before it, as (source, target, table, columns).
CONTRACTS = (
    ("denoise", "segmentation", "denoised", ("cell_id", "fov", "gene", "x", "y", "CellComp")),
    ("segmentation", "spatial_domain", "segmented", ("cell_id", "fov")),
    ("segmentation", "subcellular_spatial_domain", "segmented", ("cell_id", "x", "y")),
    ("spatial_domain", "analysis", "cells", ("spatial_domain", "x", "y")),
    ("subcellular_spatial_domain", "analysis", "segmented", ("subcellular_domain",)),
    ("analysis", "annotation", "cells", ("cluster", "pcs", "x", "y")),
    ("annotation", "end", "cells", ("cluster", "cell_type")),
)

# Columns each step's own input needs.
STEP_INPUTS = {
    "denoise": ("CellComp",),
    "segmentation": ("cell_id", "fov"),
    "subcellular_spatial_domain": ("cell_id", "x", "y"),
    "analysis": ("pcs", "x", "y"),
    "annotation": ("cluster",),
}

_MESSAGES = "source string, target string, table string, missing string"


def missing_columns(df: DataFrame, needed) -> list[str]:
    """Needed columns that ``df`` has under no accepted name."""
    return sorted(c for c in needed if find_column(df, c) is None)


def check_input(df: DataFrame, step: str) -> list[str]:
    """Messages about the input of a step: missing columns, no rows."""
    messages = []
    missing = missing_columns(df, STEP_INPUTS.get(step, ()))
    if missing:
        messages.append(f"{step} input: missing required columns: {missing}")
    if df.isEmpty():
        messages.append(f"{step} input: is empty")
    return messages


def check_contracts(spark: SparkSession, tables: dict[str, DataFrame], fail: bool = False) -> DataFrame:
    """One row per contract column that is missing; with ``fail`` any is an error."""
    rows = []
    for source, target, table, needed in CONTRACTS:
        if table not in tables:
            rows.append((source, target, table, "<table>"))
        else:
            rows += [(source, target, table, c) for c in missing_columns(tables[table], needed)]
    if rows and fail:
        raise ValueError(f"contracts not met: {rows}")
    return spark.createDataFrame(rows, _MESSAGES)


#: Columns that name rows of another table, as (table, column, other table, its column).
REFERENCES = (("segmented", "cell_id", "cells", "cell_id"),)

_VIOLATIONS = "source string, target string, table string, column string, problem string, n bigint"


def _problems(df: DataFrame, column: str) -> dict[str, Column]:
    """What can be wrong with a column, as counts over rows."""
    found = find_column(df, column)
    if found is None:
        return {"missing": F.count(F.lit(1))}
    value, kind = F.col(found), df.schema[found].dataType
    counts = {"null": F.count_if(value.isNull())}
    if isinstance(kind, FractionalType):
        counts["not finite"] = F.count_if(F.isnan(value) | (F.abs(value) == float("inf")))
    elif isinstance(kind, StringType):
        counts["empty"] = F.count_if(F.trim(value) == "")
    return counts


def write_checked(df: DataFrame, path: str, needed) -> tuple[DataFrame, dict[tuple[str, str], int]]:
    """Write a step's table, and what is wrong with its ``needed`` columns, counted while it is written.

    Returns the written table and ``(column, problem)`` with the number of
    rows; the counts cost no pass of their own.  A table without rows has
    the problem ``('', 'no rows')``.
    """
    seen = Observation()
    metrics = {(c, p): count for c in needed for p, count in _problems(df, c).items()}
    named = [count.alias(f"m{i}") for i, count in enumerate(metrics.values())]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *named).write.parquet(path)
    got = seen.get
    found = {key: got[f"m{i}"] for i, key in enumerate(metrics)}
    if not got["rows"]:
        found["", "no rows"] = 1
    return df.sparkSession.read.schema(df.schema).parquet(path), found


def contract_violations(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """``source, target, table, column, problem, n``: rows that do not meet what the next steps need.

    Each table is written once, by :func:`write_checked`; references to
    another table are then looked up by a join (``unmatched``).  A table that
    is not given has the problem ``no table``.
    """
    needed: dict[str, set[str]] = {}
    for _, _, table, columns in CONTRACTS:
        needed.setdefault(table, set()).update(columns)
    written, problems = {}, {}
    for table, df in tables.items():
        written[table], problems[table] = write_checked(df, new_path(spark, table), sorted(needed.get(table, ())))
    rows = []
    for source, target, table, columns in CONTRACTS:
        if table not in tables:
            rows.append((source, target, table, "", "no table", 1))
            continue
        rows += [(source, target, table, c, p, n) for (c, p), n in problems[table].items() if n and (c in columns or not c)]
        for holder, column, other, key in REFERENCES:
            if holder == table and column in columns and other in written:
                lost = written[table].filter(F.col(column).isNotNull()).join(written[other].select(F.col(key).alias("__key")), F.col(column) == F.col("__key"), "left_anti").count()
                rows += [(source, target, table, column, "unmatched", lost)] * (lost > 0)
    return spark.createDataFrame(rows, _VIOLATIONS)
