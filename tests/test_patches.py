import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import patches as pt


def test_hull_of_a_split_group_equals_the_hull_of_all_points(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"k": ["hot"] * 900 + ["few"] * 3, "x": rng.normal(size=903), "y": rng.normal(size=903)})
    got = pt.convex_hulls(spark.createDataFrame(pdf).repartition(8), ["k"], salts=2).toPandas().set_index("k")
    for k, part in pdf.groupby("k"):
        hx, hy = pt._hull(part.x.to_numpy(), part.y.to_numpy())
        assert got.n_points[k] == len(part)
        assert list(zip(got.hull_x[k], got.hull_y[k])) == list(zip(hx, hy))


def test_boundaries_of_small_and_flat_cells(spark):
    rows = [("one", 1.0, 2.0), ("flat", 0.0, 0.0), ("flat", 2.0, 0.0), ("flat", 1.0, 0.0), ("tri", 0.0, 0.0), ("tri", 4.0, 0.0), ("tri", 0.0, 3.0), (None, 9.0, 9.0), ("nan", 1.0, 1.0)]
    got = pt.cell_boundaries(spark.createDataFrame(rows, "cell_id string, x double, y double")).toPandas().set_index("cell_id")
    assert set(got.index) == {"one", "flat", "tri"}
    assert got.area["one"] == pytest.approx(32 * math.sin(2 * math.pi / 64))
    assert (got.area["flat"], got.centroid_x["flat"]) == (0.0, 1.0)
    assert (got.area["tri"], got.centroid_x["tri"], got.centroid_y["tri"]) == pytest.approx((6.0, 4 / 3, 1.0))


def test_clip_area():
    square = ([0.0, 2.0, 2.0, 0.0], [0.0, 0.0, 2.0, 2.0])
    moved = ([1.0, 3.0, 3.0, 1.0], [1.0, 1.0, 3.0, 3.0])
    assert pt._clip(*square, *moved) == pytest.approx(1.0)
    assert pt._clip(*square, [5.0, 6.0, 5.0], [5.0, 5.0, 6.0]) == 0.0


def test_resolution_merges_only_across_patches(spark):
    def square(cell, col, x0, side):
        return [(cell, col, 0, x0 + dx * side, dy * side) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1))]

    rows = square("A", 0, 0.0, 4.0) + square("B", 1, 0.5, 4.0) + square("C", 1, 0.6, 4.0) + square("D", 1, 50.0, 4.0) + square("E", 0, 3.9, 4.0)
    df = spark.createDataFrame(rows, "cell_id string, patch_col bigint, patch_row bigint, x double, y double")
    mapping, merged = pt.resolve_patch_cells(df)
    got = {r["cell_id"]: r["resolved_id"] for r in mapping.collect()}
    assert got == {"A": "A", "B": "A", "C": "A", "D": "D", "E": "E"}
    assert {r["resolved_id"]: r["n_points"] for r in merged.collect()} == {"A": 12, "D": 4, "E": 4}


def test_patch_needs_a_positive_stride(spark):
    df = spark.createDataFrame([(0.0, 0.0, "g", "c")], "x double, y double, gene string, cell_id string")
    with pytest.raises(ValueError):
        pt.assign_patches(df, 10.0, 10.0)
    assert pt.patched_segmentation(df).count() == 1


def _squares(spark, cells):
    """Outlines of axis-aligned squares ``(id, patch, x, y, side)``."""
    rows = [(i, p, 0, [x, x + s, x + s, x], [y, y, y + s, y + s]) for i, p, x, y, s in cells]
    return spark.createDataFrame(rows, "id string, patch_col bigint, patch_row bigint, hull_x array<double>, hull_y array<double>")


def test_overlaps_of_squares_of_all_sizes(spark):
    rng = np.random.default_rng(3)
    cells = [(f"c{i:03d}", int(rng.integers(0, 3)), *rng.uniform(-20, 60, 2).tolist(), float(2.0 ** rng.uniform(-3, 6))) for i in range(150)]
    want = set()
    for i, a in enumerate(cells):
        for b in cells[i + 1 :]:
            w = min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2])
            h = min(a[3] + a[4], b[3] + b[4]) - max(a[3], b[3])
            if a[1] != b[1] and w > 0 and h > 0 and w * h / min(a[4], b[4]) ** 2 > 0.5:
                want.add((a[0], b[0]))
    got = [(r.src, r.dst) for r in pt.overlapping_cells(_squares(spark, cells)).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_a_slide_wide_outline_adds_its_own_pairs_alone(spark):
    cells = [(f"c{i:04d}", i % 2, float(i % 40 * 2), float(i // 40 * 2), 1.0) for i in range(1200)]
    boxes = lambda some: _squares(spark, some).select(
        "id", "patch_col", "patch_row", F.array_min("hull_x").alias("x1"), F.array_max("hull_x").alias("x2"),
        F.array_min("hull_y").alias("y1"), F.array_max("hull_y").alias("y2"),
    )
    assert pt._candidates(boxes(cells)).count() == 0
    assert pt._candidates(boxes([*cells, ("all", 7, -5.0, -5.0, 100.0)])).count() == 1200


def test_hulls_need_no_call_for_each_group_and_drop_what_is_inside(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"k": rng.integers(0, 40, 6000), "x": rng.normal(size=6000).round(2), "y": rng.normal(size=6000)})
    pdf.loc[:3000, "k"] = 7
    hulls = pt.convex_hulls(spark.createDataFrame(pdf).repartition(16), ["k"], salts=64)
    assert "FlatMapGroupsInPandas" not in hulls._jdf.queryExecution().executedPlan().toString()
    got = hulls.toPandas().set_index("k")
    for k, part in pdf.groupby("k"):
        hx, hy = pt._hull(part.x.to_numpy(), part.y.to_numpy())
        assert (got.n_points[k], list(zip(got.hull_x[k], got.hull_y[k]))) == (len(part), list(zip(hx, hy)))


def test_resolving_cells_needs_no_call_for_each_cell(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(pt, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    rows = [(c, p, 0, x + dx, y + dy) for c, p, x in (("A", 0, 0.0), ("B", 1, 0.5)) for dx in (0.0, 2.0, 4.0) for y in (0.0,) for dy in (0.0, 4.0)]
    mapping, merged = pt.resolve_patch_cells(spark.createDataFrame(rows, "cell_id string, patch_col bigint, patch_row bigint, x double, y double"))
    plans.append(merged._jdf.queryExecution().executedPlan().toString())
    assert plans and not any("FlatMapGroupsInPandas" in p for p in plans)
    assert [(r["resolved_id"], r["n_points"]) for r in merged.collect()] == [("A", 12)]


def _transcripts(spark, n):
    rng = np.random.default_rng(17)
    pdf = pd.DataFrame({"x": rng.integers(0, 90, n).astype(float), "y": rng.integers(-20, 60, n).astype(float), "gene": "g"})
    pdf["cell_id"] = [f"c{a:.0f}_{b:.0f}" for a, b in zip(pdf.x // 9, pdf.y // 11)]
    pdf.loc[:20, "cell_id"] = None
    pdf.loc[21:30, "cell_id"] = ""
    pdf.loc[5, ["x", "y"]] = [-70.0, 99.0]
    df = spark.createDataFrame(pdf)
    return df.withColumn("y", F.when(F.col("x") != 33.0, F.col("y")))


def test_outlines_of_patches_are_those_of_patched_transcripts(spark):
    df = _transcripts(spark, 4000)
    for width, overlap in ((40.0, 15.0), (30.0, 20.0), (500.0, 150.0)):
        named = pt.patched_segmentation(df, width=width, overlap=overlap, keep_patch=True)
        want = pt.convex_hulls(named, ["cell_id", "patch_col", "patch_row"]).withColumnRenamed("cell_id", "id")
        got = pt.patch_outlines(df, width=width, overlap=overlap)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    for r in got.collect():
        assert r["area"] == pytest.approx(pt._area_centroid(np.array(r["hull_x"]), np.array(r["hull_y"]))[0])
    assert pt.patch_outlines(df.filter("gene = 'none'")).count() == 0
    with pytest.raises(ValueError):
        pt.patch_outlines(df, width=10.0, overlap=10.0)


def test_resolving_cells_of_patches_reads_transcripts_once(spark):
    from tessera.plans.transcript_queries import overlapping_cells_resolved

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    class Given:
        def transcripts(self):
            df = _transcripts(spark, 3000).withColumns({"x": F.col("x") * 10, "y": F.col("y") * 10})
            return df.mapInArrow(counted, df.schema)

    found = overlapping_cells_resolved(Given()).toPandas()
    assert seen.value == 3000
    named = pt.patched_segmentation(_transcripts(spark, 3000).withColumns({"x": F.col("x") * 10, "y": F.col("y") * 10}), width=500.0, overlap=150.0, keep_patch=True)
    sizes = named.filter("x is not null and y is not null").groupBy("cell_id").count().toPandas().set_index("cell_id")["count"]
    assert set(found.cell_id) == set(sizes.index) and len(set(found.resolved_id)) < len(found)
    assert (found.groupby("resolved_id").n_points.first() == sizes.groupby(found.set_index("cell_id").resolved_id).sum()).all()


def test_hulls_of_many_groups_are_those_of_each():
    rng = np.random.default_rng(23)
    groups = [(np.array([3.0]), np.array([4.0])), (np.array([1.0, 1.0, 1.0]), np.array([0.0, 5.0, 2.0])), (np.arange(5.0), np.arange(5.0))]
    groups += [(np.sort(rng.integers(0, 12, n)).astype(float), rng.integers(-4, 5, n).astype(float)) for n in rng.integers(1, 60, 80)]
    # A convex chain whose points go one after the other.
    groups += [(np.arange(400.0), np.r_[np.arange(399.0) ** 2, -1e9])] * 2
    bounds = np.r_[0, np.cumsum([len(x) for x, _ in groups])]
    x, y = (np.concatenate([g[i] for g in groups]) for i in (0, 1))
    hx, hy, ends = pt._all_hulls(x, y, y, bounds)
    areas = pt._areas(hx, hy, ends)
    for g, i, j, area in zip(groups, ends, ends[1:], areas):
        ring = pt._hull(*g)
        assert list(zip(*ring)) == list(zip(hx[i:j], hy[i:j]))
        assert area == (pt._area_centroid(*ring)[0] if len(ring[0]) > 2 else 0.0)


def test_shared_area_of_polygons_within_each_other():
    square = (np.array([0.0, 4.0, 4.0, 0.0]), np.array([0.0, 0.0, 4.0, 4.0]))
    inner = (np.array([1.0, 4.0, 1.0]), np.array([0.0, 2.0, 3.0]))
    moved = (square[0] + 3, square[1] - 1)
    for a, b in ((square, inner), (inner, square), (square, square), (square, moved), (moved, inner), (square, (square[0] + 9, square[1]))):
        assert pt._shared(*a, *b) == pytest.approx(pt._clip(*a, *b))
