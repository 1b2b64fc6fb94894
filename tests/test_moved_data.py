"""Steps move and write what they need, and deal it to as many tasks as its rows ask for."""

import numpy as np
from conftest import SMALL
from pyspark.sql import functions as F

from tessera.operators import cells as ce
from tessera.operators import spatial_stats as sp
from tessera.plans import cell_queries as cq
from tessera.plans.inputs import Inputs
from tessera.runtime import number_rows


def test_numbering_writes_the_kept_columns_only(spark):
    df = spark.range(50).select((49 - F.col("id")).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    got = number_rows(df, "a", keep=["b"])
    assert got.columns == ["b", "row_id"] and all(r["b"] == 50 - r["row_id"] for r in got.collect())


def test_choice_of_clustering_needs_no_numbering(spark, monkeypatch):
    monkeypatch.setattr(Inputs, "numbered", lambda _: 1 / 0)
    assert cq.clustering_choice(Inputs(spark, SMALL)).collect() == [("leiden",)]
    counts = spark.createDataFrame([("1", "a", 2), ("1", "b", 0), ("2", "a", 1), ("3", None, 1)], "cell_id string, gene string, count bigint")
    assert tuple(ce.sparsity(counts).first()) == (3, 2, 3, 0.5)


def test_tree_is_dealt_by_rows_whatever_the_files(spark, monkeypatch):
    monkeypatch.setattr(sp, "TREE_ROWS", 50)
    v = np.random.default_rng(21).normal(size=(400, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "cell_id bigint, pcs array<double>")
    found = [sp.principal_tree(d, k=6)[1] for d in (df.coalesce(1), df.repartition(7))]
    assert found[0].toPandas().sort_values("cell_id").reset_index(drop=True).equals(found[1].toPandas().sort_values("cell_id").reset_index(drop=True))
    assert len({r[0] for r in found[0].select(F.spark_partition_id()).collect()}) > 1
