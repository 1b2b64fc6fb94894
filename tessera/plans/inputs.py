"""Tables and the transcript view derived from them, for Spark and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.cells import cell_gene_counts, cell_summary
from tessera.operators.neighbours import spatial_graph
from tessera.operators.transcripts import denoise, provided_cells
from tessera.runtime import cut, number_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_KEPT: dict[tuple, DataFrame] = {}


def forget() -> None:
    """Drop the derived tables that queries of a session share, for timing each on its own."""
    _KEPT.clear()


def query(name: str, sql: str | None = None):
    """Register a query ``(Inputs) -> DataFrame`` and its SQL twin."""

    def add(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Inputs(spark, sf_dir))

        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return add


ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax")


class Inputs:
    """The given tables of one folder and what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def kept(self, name: str, make: Callable[[], DataFrame], written: bool = False) -> DataFrame:
        """A derived table that several queries of a session share, written once, by ``make`` itself if ``written``."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _KEPT:
            _KEPT[key] = make() if written else cut(make())
        return _KEPT[key]

    def _joined(self) -> DataFrame:
        part = self.table("part").select("p_partkey", "p_brand")
        return self.table("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))

    @staticmethod
    def _view(df: DataFrame, *extra: str) -> DataFrame:
        return df.select(
            *extra,
            ((F.col("l_suppkey") % 10) * 100 + F.col("l_quantity")).cast("double").alias("x"),
            (F.expr("l_suppkey div 10") * 100 + (F.col("l_partkey") * 37) % 50).cast("double").alias("y"),
            F.col("p_brand").alias("gene"),
            F.when(F.col("l_linenumber") != 7, F.col("l_suppkey").cast("string")).alias("cell_id"),
            F.col("l_linenumber").cast("bigint").alias("fov"),
            F.when(F.col("l_returnflag") == "N", "Nuclear").when(F.col("l_returnflag") == "A", "Cytoplasm")
            .otherwise("Membrane").alias("CellComp"),
        )

    def transcripts(self) -> DataFrame:
        """The transcript view without row ids: one join, no other shuffle."""
        return self._view(self._joined())

    def numbered(self) -> DataFrame:
        """The transcript view with row ids, written once per session."""
        def make():
            keyed = self._joined().select("p_brand", "l_returnflag", *ORDER)
            # What is only there for the order goes no further than the sort.
            return self._view(number_rows(keyed, *ORDER, keep=["p_brand", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]), "row_id")

        return self.kept("numbered", make, written=True)

    def segmented(self) -> DataFrame:
        return provided_cells(self.transcripts())

    def counts(self) -> DataFrame:
        return cell_gene_counts(self.segmented())

    def cells(self) -> DataFrame:
        """Cells with a number, and two labellings taken from the supplier table."""
        def make():
            s = self.table("supplier")
            summary = cell_summary(self.segmented()).withColumn("cell_no", F.col("cell_id").cast("bigint"))
            labels = s.select(
                F.col("s_suppkey").alias("cell_no"),
                (F.col("s_nationkey") % 4).cast("string").alias("cluster"),
                (F.col("s_nationkey") % 3).cast("string").alias("spatial_domain"),
            )
            return summary.join(labels, "cell_no")

        return self.kept("cells", make)

    def graph(self, k: int = 6) -> DataFrame:
        return self.kept(f"graph{k}", lambda: spatial_graph(self.cells(), k))

    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("cell_id"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string").alias("label")
        )


VIEWS = {
    "transcripts": f"""SELECT row_number() OVER (ORDER BY {', '.join(ORDER)}) AS row_id,
  CAST((l_suppkey % 10) * 100 AS DOUBLE) + l_quantity AS x,
  CAST((l_suppkey // 10) * 100 + (l_partkey * 37) % 50 AS DOUBLE) AS y,
  p_brand AS gene,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS cell_id,
  CAST(l_linenumber AS BIGINT) AS fov,
  CASE l_returnflag WHEN 'N' THEN 'Nuclear' WHEN 'A' THEN 'Cytoplasm' ELSE 'Membrane' END AS CellComp
  FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "inside": "SELECT * FROM transcripts WHERE CellComp IN ('Nuclear', 'Cytoplasm')",
    "seg": "SELECT * FROM transcripts WHERE cell_id IS NOT NULL AND cell_id <> ''",
    "counts": "SELECT cell_id, gene, count(*) AS n FROM seg GROUP BY 1, 2",
    "cells": """SELECT s_suppkey AS cell_no, cell_id, n_transcripts, n_genes, x, y,
  CAST(s_nationkey % 4 AS VARCHAR) AS cluster, CAST(s_nationkey % 3 AS VARCHAR) AS spatial_domain
  FROM (SELECT cell_id, count(*) AS n_transcripts, count(DISTINCT gene) AS n_genes, avg(x) AS x, avg(y) AS y
        FROM seg GROUP BY cell_id) JOIN supplier ON CAST(cell_id AS BIGINT) = s_suppkey""",
    "knn": """SELECT src, dst, rk, dist FROM (SELECT a.cell_no AS src, b.cell_no AS dst,
    sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist,
    row_number() OVER (PARTITION BY a.cell_no ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.cell_no) AS rk
    FROM cells a JOIN cells b ON a.cell_no <> b.cell_no) WHERE rk <= 6""",
    "graph": "SELECT src, dst FROM knn UNION SELECT dst, src FROM knn",
    "lognorm": """SELECT c.cell_id, c.gene, c.n, ln(1 + c.n * 10000.0 / t.total) AS v FROM counts c
  JOIN (SELECT cell_id, sum(n) AS total FROM counts GROUP BY 1) t ON c.cell_id = t.cell_id""",
    "emb": "SELECT vec_id AS cell_id, CAST(embedding AS DOUBLE[]) AS vector, CAST(label AS VARCHAR) AS label FROM embeddings",
}
_NEEDS = {
    "inside": ["transcripts"], "seg": ["transcripts"], "counts": ["seg"], "cells": ["seg"],
    "knn": ["cells"], "graph": ["knn"], "lognorm": ["counts"],
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it names."""
    import re

    needed: list[str] = []

    def visit(name: str) -> None:
        for other in _NEEDS.get(name, []):
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in VIEWS:
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.IGNORECASE):
            visit(name)
    if not needed:
        return sql
    # Materialised, so that a numbering or a neighbour search is not repeated per use.
    views = ",\n".join(f"{n} AS MATERIALIZED ({VIEWS[n]})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {views},\n{body[len('WITH RECURSIVE'):]}"
    if body.upper().startswith("WITH"):
        return f"WITH {views},\n{body[len('WITH'):]}"
    return f"WITH {views}\n{body}"


def r6(column, places: int = 6):
    """Rounded so that the order of a floating point sum does not show."""
    return F.round(column, places)
