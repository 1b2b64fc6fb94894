"""Dataset catalogue: reading, checking, searching, changing and writing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import size_text, text_or_null
from tessera.operators.graph import rank_in_group
from tessera.runtime import number_rows
from tessera.schema import (
    CATALOGUE,
    CATALOGUE_COLUMNS,
    CATALOGUE_PRIORITY,
    CATALOGUE_REQUIRED,
    InputError,
)


def clean_catalogue(raw: DataFrame) -> DataFrame:
    """Text columns of a catalogue file as typed rows; empty is null, status defaults to pending."""
    if set(raw.columns) != set(CATALOGUE_COLUMNS):
        raise InputError(f"catalogue columns differ: expected {CATALOGUE_COLUMNS}, got {raw.columns}")
    typed = {name: text_or_null(F.col(name).cast("string")).try_cast(kind) for name, kind, _, _ in CATALOGUE}
    typed["status"] = F.coalesce(typed["status"], F.lit("pending"))
    return raw.select(*[typed[name].alias(name) for name in CATALOGUE_COLUMNS])


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue from delimited text; an empty file is an error."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    rows = clean_catalogue(raw)
    if rows.isEmpty():
        raise InputError("the catalogue file has no rows")
    return rows


def write_catalogue_csv(catalogue: DataFrame, path: str) -> None:
    """Catalogue in id order with its fixed columns.  A catalogue is one small file by format."""
    catalogue.select(*CATALOGUE_COLUMNS).orderBy("id").coalesce(1).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"'
    )


def column_metadata(spark: SparkSession) -> DataFrame:
    """One row per catalogue column: type, nullability, category and default visibility."""
    return spark.createDataFrame(
        [(i, name, kind, not needed, category, name in CATALOGUE_PRIORITY) for i, (name, kind, needed, category) in enumerate(CATALOGUE)],
        "position int, name string, type string, nullable boolean, category string, priority boolean",
    )


def catalogue_documents(catalogue: DataFrame) -> DataFrame:
    """Each row as a JSON document, in id order, with nulls kept."""
    row = F.to_json(F.struct(*[F.col(c) for c in CATALOGUE_COLUMNS]), {"ignoreNullFields": "false"})
    return catalogue.orderBy("id").select("id", row.alias("document"))


def write_catalogue_json(catalogue: DataFrame, path: str) -> None:
    """Rows, column metadata and total below ``path``."""
    catalogue_documents(catalogue).select(F.col("document").alias("value")).write.mode("overwrite").text(f"{path}/rows")
    column_metadata(catalogue.sparkSession).coalesce(1).write.mode("overwrite").json(f"{path}/columns")
    catalogue.agg(F.count("*").alias("total")).coalesce(1).write.mode("overwrite").json(f"{path}/total")


def harmonise(source: DataFrame) -> DataFrame:
    """Rows of the older, wider catalogue as rows of the fixed layout.

    Chinese and English names merge into one, a link column splits into page
    and download link, a 0/1 status becomes a word and the size is also shown
    as text.
    """
    have = set(source.columns)

    def pick(*names: str) -> Column:
        found = [text_or_null(F.col(n).cast("string")) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    link = pick("Data_Source_Link")
    is_file = F.coalesce(link.rlike(r"(?i)\.(zip|tar|gz|tgz|csv|parquet|h5|h5ad)(\?.*)?$"), F.lit(False))
    state = pick("Data_Status", "status")
    size = pick("data_size_bytes", "Data_Size").try_cast("bigint")
    values = {
        "id": pick("id"),
        "project_id": pick("project_id"),
        "platform": pick("platform", "Platform"),
        "name": F.coalesce(
            F.nullif(F.concat_ws(" / ", F.array_distinct(F.array_compact(F.array(pick("name_zh", "info"), pick("name_en", "info.1"))))), F.lit("")),
            pick("name"),
        ),
        "project_url": F.coalesce(pick("project_url"), F.when(~is_file, link)),
        "download_url": F.coalesce(pick("download_url"), F.when(is_file, link)),
        "status": F.when(state == "1", "ready").when(state.isin("ready", "error"), state).otherwise("pending"),
        "data_size_bytes": size,
        "data_size_display": F.coalesce(pick("data_size_display"), size_text(size)),
    }
    for name, kind, _, _ in CATALOGUE:
        values.setdefault(name, pick(name).try_cast(kind))
    return source.select(*[values[n].alias(n) for n in CATALOGUE_COLUMNS])


def search(catalogue: DataFrame, text: str | None = None, platform: str | None = None, status: str | None = None,
           hide_fragments: bool = True) -> DataFrame:
    """Rows with ``text`` in any column (any case), of one platform and status; raw fragments hidden."""
    rows = catalogue
    if hide_fragments:
        rows = rows.filter(~F.col("id").startswith("R"))
    if text:
        needle = F.lit(text.lower())
        hit = F.lit(False)
        for c in catalogue.columns:
            hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), needle), F.lit(False))
        rows = rows.filter(hit)
    if platform:
        rows = rows.filter(F.col("platform") == platform)
    if status:
        rows = rows.filter(F.col("status") == status)
    return rows


def visible_columns(catalogue: DataFrame, everything: bool = False) -> DataFrame:
    """Columns shown first, or all."""
    return catalogue.select(*(CATALOGUE_COLUMNS if everything else CATALOGUE_PRIORITY))


def mixed_order(column: str, descending: bool = False) -> list[Column]:
    """Sort keys: numbers by value before texts by text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("—"))
    number = text.try_cast("double")
    keys = [number.isNull(), number, text]
    return [k.desc() if descending else k.asc() for k in keys]


def page(rows: DataFrame, order: list, number: int = 1, size: int = 50) -> DataFrame:
    """One page of the ordered rows with ``position`` and ``n_pages``; size 0 is all rows.

    A page number past the end gives the last page.
    """
    placed = number_rows(rows, *order, name="position")
    total = placed.count()
    pages = 1 if size == 0 else max(1, -(-total // size))
    at = min(max(number, 1), pages)
    kept = placed if size == 0 else placed.filter(F.col("position").between((at - 1) * size + 1, at * size))
    return kept.withColumn("n_pages", F.lit(pages).cast("bigint"))


# Digit of each platform in an id.
PLATFORM_DIGITS = {"CosMx": "0", "Xenium": "1", "MERFISH": "2"}
# First letter of an id by record type.
RECORD_LETTERS = {"Standard": "D", "Merged": "M", "Raw_Fragment": "R"}


def _lookup(values: dict, key: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def _padded(number: Column) -> Column:
    text = number.cast("string")
    return F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)


def generate_ids(rows: DataFrame, key: str, project: str = "project") -> DataFrame:
    """Ids ``<letter><platform digit><number>`` and project ids ``P<digit><number>``.

    ``rows`` has ``record_type, platform, data_source``, a unique ``key`` and a
    project name.  Numbers run within type and platform in order of the source.
    """
    numbered = rank_in_group(rows, ["record_type", "platform"], [F.col("data_source"), F.col(key)], "__n")
    digit = _lookup(PLATFORM_DIGITS, F.col("platform"))
    projects = rank_in_group(rows.select("platform", project).distinct(), ["platform"], [F.col(project)], "__p").select(
        "platform", project, "__p"
    )
    return numbered.join(projects, ["platform", project]).withColumns(
        {
            "id": F.concat(_lookup(RECORD_LETTERS, F.col("record_type")), digit, _padded(F.col("__n") + 1)),
            "project_id": F.concat(F.lit("P"), digit, _padded(F.col("__p") + 1)),
        }
    ).drop("__n", "__p")


def reorder_ids(rows: DataFrame, order: DataFrame, id: str = "id") -> DataFrame:
    """New id = position in ``order (position, id)``; all rows at once, others keep theirs."""
    moves = order.select(F.col(id), F.col("position").alias("__new"))
    return rows.join(moves, id, "left").withColumn(id, F.coalesce(F.col("__new").cast(dict(rows.dtypes)[id]), F.col(id))).drop("__new")


def positions(spark: SparkSession, ids: list) -> DataFrame:
    """A given list of ids as ``position, id``."""
    return spark.createDataFrame([(list(ids),)], "ids array<string>").select(F.posexplode("ids").alias("p", "id")).select(
        (F.col("p") + 1).alias("position"), "id"
    )


def apply_changes(rows: DataFrame, changes: DataFrame, key: str = "id", action: str = "action") -> DataFrame:
    """New snapshot after inserts, updates and deletes.

    ``changes`` has the columns of ``rows`` and an action.  Updating or
    deleting an absent key changes nothing; inserting a present key replaces it.
    """
    values = [c for c in rows.columns if c != key]
    c = changes.select(key, F.col(action).alias("__a"), *[F.col(v).alias(f"__{v}") for v in values])
    joined = rows.withColumn("__old", F.lit(True)).join(c, key, "full_outer")
    old, act = F.col("__old").isNotNull(), F.col("__a")
    kept = joined.filter(
        (act.isNull()) | (act == "insert") | (old & (act == "update"))
    )
    return kept.select(key, *[F.when(act.isNull(), F.col(v)).otherwise(F.col(f"__{v}")).alias(v) for v in values])


def integrity(rows: DataFrame, key: str = "id", required: tuple = CATALOGUE_REQUIRED) -> DataFrame:
    """Rows, rows with a null in a required column, and ids that occur more than once."""
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    totals = rows.agg(F.count("*").alias("n_rows"), F.count_if(missing).alias("n_null_required"))
    twice = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("n_duplicate_ids"))
    return totals.join(F.broadcast(twice), F.lit(True))


def distinct_sorted(rows: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return rows.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
