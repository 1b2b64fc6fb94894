import gzip

import pytest

from tessera.functions.contracts import check_input
from tessera.operators import transcripts as tr
from tessera.schema import InputError, find_column, need_column
from tessera.sources import transcripts as src


def _file(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    return str(path)


def test_platforms_by_header_and_suffix(spark, tmp_path):
    cases = {
        "a.csv": ("fov,x_global_px,y_global_px,target\n1,2,3,G\n", "cosmx"),
        "b.csv": ("x,y,feature_name,cell_id\n1,2,G,c\n", "xenium"),
        "c.csv.gz": ("x,y,gene,barcode_id\n1,2,G,b\n", "merfish"),
        "d.tsv": ("geneID\tx\ty\tcount\nG\t1\t2\t1\n", "stereoseq"),
        "e.gem": ("geneID\tx\ty\tcount\nG\t1\t2\t1\n", "stereoseq"),
    }
    for name, (text, platform) in cases.items():
        path = _file(tmp_path, name, text)
        assert src.detect_platform(spark, path) == platform
        assert src.ingest(spark, path).count() == 1
    with pytest.raises(InputError):
        src.detect_platform(spark, _file(tmp_path, "f.csv", "a,b\n1,2\n"))


def test_bad_numbers_missing_texts_and_defaults(spark, tmp_path):
    path = _file(tmp_path, "a.csv", "fov,x_global_px,y_global_px,target,cell\n1,2.5,oops,G1,1_1\n2,,3,G2,NA\n")
    rows = src.ingest(spark, path).orderBy("row_id").collect()
    assert [(r["x"], r["y"], r["cell_id"], r["CellComp"]) for r in rows] == [(2.5, None, "1_1", "Unknown"), (None, 3.0, None, "Unknown")]
    with pytest.raises(InputError):
        src.ingest(spark, _file(tmp_path, "b.csv", "fov,x_global_px,y_global_px,target\n"), "cosmx")
    with pytest.raises(InputError):
        src.ingest(spark, path, "xenium")


def test_segmentation_keeps_zero_and_drops_empty(spark):
    df = spark.createDataFrame([("1_1", 1), ("", 1), (None, 1), ("0", 1)], "cell string, fov int")
    assert sorted(r["cell"] for r in tr.provided_cells(df).collect()) == ["0", "1_1"]
    assert [r["cell"] for r in tr.fov_cells(df.filter("cell = '1_1' or cell is null")).collect()] == ["1_1_1", None]


def test_denoise_passes_through_without_compartments(spark):
    df = spark.createDataFrame([("Unknown", "g")], "CellComp string, gene string")
    assert tr.denoise(df, "intracellular").count() == 1
    empty = df.filter("false")
    assert tr.denoise_summary(empty, empty, "none").first()["drop_ratio"] == 0.0
    with pytest.raises(InputError):
        tr.denoise(df, "other")


def test_aliases_and_checks(spark):
    df = spark.createDataFrame([(1, "g")], "x_location int, target string").filter("false")
    assert find_column(df, "x") == "x_location" and find_column(df, "fov") is None
    with pytest.raises(InputError):
        need_column(df, "fov")
    assert len(check_input(df, "denoise")) == 2


def test_distribution_fractions(spark):
    df = spark.createDataFrame([(v,) for v in "aabccc"], "v string")
    got = {r["value"]: r["fraction"] for r in tr.fractions(df, "v").collect()}
    assert got == pytest.approx({"a": 2 / 6, "b": 1 / 6, "c": 3 / 6})


def test_every_count_is_expanded(spark):
    from tessera.sources.transcripts import expand_counts, split_counts

    df = spark.createDataFrame([("A", "3"), ("B", "250"), ("C", "0"), ("D", "-1"), ("E", "x"), ("F", None)], "gene string, count string")
    got = expand_counts(df).groupBy("gene").count().collect()
    assert {r["gene"]: r["count"] for r in got} == {"A": 3, "B": 250}
    below, above = split_counts(df, 100)
    assert [r.gene for r in above.collect()] == ["B"] and below.count() == 5


def test_checks_of_a_written_table(spark, tmp_path):
    from tessera.functions.contracts import contract_violations, write_checked

    rows = [(None, 1.0), ("", float("nan")), (" ", float("inf")), ("a", None)]
    df = spark.createDataFrame(rows, "cell_id string, x double")
    back, found = write_checked(df, str(tmp_path / "t"), ["cell_id", "x", "y"])
    assert back.count() == 4
    assert found == {("cell_id", "null"): 1, ("cell_id", "empty"): 2, ("x", "null"): 1, ("x", "not finite"): 2, ("y", "missing"): 4}
    assert write_checked(df.limit(0), str(tmp_path / "none"), ["x"])[1]["", "no rows"] == 1
    got = {tuple(r) for r in contract_violations(spark, {"segmented": df, "cells": spark.createDataFrame([("a",)], "cell_id string")}).collect()}
    assert ("segmentation", "spatial_domain", "segmented", "cell_id", "unmatched", 2) in got
    assert ("denoise", "segmentation", "denoised", "", "no table", 1) in got
