"""Overlapping spatial patches, cell outlines and their resolution."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.graph import components
from tessera.operators.tiles import whole_groups
from tessera.operators.transcripts import fov_cells, provided_cells
from tessera.runtime import cut
from tessera.schema import need_column

#: Outlines whose pairs one task compares.
TASK_OUTLINES = 1 << 13


def _span(at: Column, low: float, high: float, width: float, stride: float) -> tuple[Column, Column]:
    """First and last of the patches along one axis that hold ``at``; points lie between ``low`` and ``high``."""
    last = max(int(np.ceil((high - low) / stride)) - 1, 0)
    at = at - F.lit(float(low))
    upper = F.least(F.floor(at / F.lit(stride)), F.lit(last))
    lower = F.greatest(F.floor((at - F.lit(width)) / F.lit(stride)) + 1, F.lit(0))
    return F.least(lower, upper).cast("bigint"), upper.cast("bigint")


def _stride(width: float, overlap: float) -> float:
    if overlap >= width:
        raise ValueError(f"overlap ({overlap}) must be smaller than width ({width})")
    return width - overlap


def assign_patches(df: DataFrame, width: float = 500.0, overlap: float = 50.0) -> DataFrame:
    """One row per (transcript, square patch it lies in): adds ``patch_col, patch_row``.

    Patches are half open and start at the smallest coordinates.  A point past
    the last patch belongs to the last one.
    """
    stride = _stride(width, overlap)
    x, y = need_column(df, "x"), need_column(df, "y")
    frame = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    if frame[0] is None:
        return df.withColumns({"patch_col": F.lit(0).cast("bigint"), "patch_row": F.lit(0).cast("bigint")})

    def indices(column: str, low: float, high: float) -> Column:
        return F.explode(F.sequence(*_span(F.col(column), low, high, width, stride)))

    inside = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return inside.withColumn("patch_col", indices(x, frame[0], frame[1])).withColumn(
        "patch_row", indices(y, frame[2], frame[3])
    )


_SEGMENT = {"provided_cells": provided_cells, "fov_cell_id": fov_cells}


def _patch_name(cell: Column) -> Column:
    return F.concat(F.lit("P"), F.col("patch_col"), F.lit("x"), F.col("patch_row"), F.lit("_"), cell.cast("string"))


def patched_segmentation(df: DataFrame, method: str = "provided_cells", width: float = 500.0,
                         overlap: float = 50.0, keep_patch: bool = False, prefix: bool = True) -> DataFrame:
    """Segment every patch on its own; cell ids get the prefix ``P<col>x<row>_``.

    Transcripts in an overlap occur once per patch.  ``prefix=False`` is for
    data known to lie in one patch, where ids are unique as they are.
    """
    segment = _SEGMENT[method]
    patched = assign_patches(df, width, overlap)
    if not prefix:
        named = segment(patched)
        return named if keep_patch else named.drop("patch_col", "patch_row")
    cell = need_column(df, "cell_id")
    named = segment(patched).withColumn(cell, _patch_name(F.col(cell)))
    return named if keep_patch else named.drop("patch_col", "patch_row")


def union_patches(*parts: DataFrame) -> DataFrame:
    """Patch outputs stacked by column name."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def drop_overlap_copies(df: DataFrame, row: str = "row_id") -> DataFrame:
    """Keep each transcript once, in its first patch."""
    rest = [c for c in df.columns if c != row]
    first = df.groupBy(row).agg(F.min_by(F.struct(*rest), F.struct("patch_col", "patch_row")).alias("__r"))
    return first.select(row, "__r.*")


def _hull(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counter-clockwise hull of one group, without collinear points, point by point."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    # Only the lowest and highest point of each x can be on the hull.
    start = np.r_[True, x[1:] != x[:-1]]
    keep = start | np.r_[start[1:], True]
    points = list(dict.fromkeys(zip(x[keep].tolist(), y[keep].tolist())))
    if len(points) < 3:
        return np.array([p[0] for p in points]), np.array([p[1] for p in points])

    def chain(seq):
        line: list = []
        for p in seq:
            while len(line) > 1:
                (ax, ay), (bx, by) = line[-2], line[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                line.pop()
            line.append(p)
        return line[:-1]

    ring = chain(points) + chain(points[::-1])
    return np.array([p[0] for p in ring]), np.array([p[1] for p in ring])


def _area_centroid(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    cross = x * np.roll(y, -1) - np.roll(x, -1) * y
    area = cross.sum() / 2
    if abs(area) < 1e-300:
        return 0.0, (x.min() + x.max()) / 2, (y.min() + y.max()) / 2
    return (
        abs(area),
        ((x + np.roll(x, -1)) * cross).sum() / (6 * area),
        ((y + np.roll(y, -1)) * cross).sum() / (6 * area),
    )


def _turning(group: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points are corners of the chain to the right of all points of their group; points are in the order of the chain.

    A point that is not right of the line between two others is no corner,
    whichever points they are, so all such go at once, until none does.  Chains
    that lose few at a time are followed point by point at last.
    """
    keep, at = np.ones(len(x), bool), np.arange(len(x))
    for _ in range(64):
        g, px, py = group[at], x[at], y[at]
        turn = (px[1:-1] - px[:-2]) * (py[2:] - py[:-2]) - (py[1:-1] - py[:-2]) * (px[2:] - px[:-2])
        gone = (g[:-2] == g[2:]) & ~(turn > 0)
        if not gone.any():
            return keep
        keep[at[1:-1][gone]] = False
        # Chains without a change are done.
        changed = np.zeros(group.max() + 1, bool)
        changed[g[1:-1][gone]] = True
        at = at[keep[at] & changed[g]]
    line: list = []
    for p, g, px, py in zip(at.tolist(), group[at].tolist(), x[at].tolist(), y[at].tolist()):
        if line and line[-1][1] != g:
            line = []
        while len(line) > 1:
            (_, _, ax, ay), (b, _, bx, by) = line[-2:]
            if (bx - ax) * (py - ay) - (by - ay) * (px - ax) > 0:
                break
            keep[b] = False
            line.pop()
        line.append((p, g, px, py))
    return keep


def _all_hulls(x: np.ndarray, low: np.ndarray, high: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hulls as of :func:`_hull` of many groups of rows in the order of x: ``x, y`` and the bounds of each."""
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (group[1:] != group[:-1])])
    low, high, x, group = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start), x[start], group[start]
    ends = np.r_[group[1:] != group[:-1], True]
    starts = np.r_[True, ends[:-1]]
    flat = low == high
    # Where the chains meet in one point, it is the first of a chain, and not the last of the other; a lone point is both.
    below = _turning(group, x, low) & ~(ends & flat & ~starts)
    above = _turning(group[::-1], x[::-1], high[::-1])[::-1] & ~(starts & flat)
    order = np.lexsort((np.r_[np.arange(below.sum()), -np.arange(above.sum())], np.r_[np.zeros(below.sum()), np.ones(above.sum())], np.r_[group[below], group[above]]))
    sizes = np.bincount(np.r_[group[below], group[above]], minlength=len(bounds) - 1)
    return np.r_[x[below], x[above]][order], np.r_[low[below], high[above]][order], np.r_[0, np.cumsum(sizes)]


def _areas(x: np.ndarray, y: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Areas of polygons that have the corners ``bounds[i]`` to before ``bounds[i + 1]``."""
    after = np.arange(1, len(x) + 1)
    after[bounds[1:] - 1] = bounds[:-1]
    areas = np.abs(np.add.reduceat(x * y[after] - x[after] * y, bounds[:-1])) / 2
    return np.where((np.diff(bounds) > 2) & (areas >= 1e-300), areas, 0.0)


def _rings(columns: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Hull of each group of the ``n`` rows ``keys, x, low, high, n_points``, with its area.

    Rows reach the tasks flat and sorted, and a task finds the hulls of all its groups together.
    """
    kinds = dict(columns.dtypes)

    def run(table: pa.Table, bounds: np.ndarray) -> pa.Table:
        at, low, high, held = (table[c].to_numpy() for c in ("x", "low", "high", "n_points"))
        hx, hy, ends = _all_hulls(at, low, high, bounds)
        offsets = pa.array(ends.astype(np.int32))
        made = {k: table[k].take(pa.array(bounds[:-1])) for k in keys} | {"n_points": pa.array(np.add.reduceat(held, bounds[:-1]))}
        made |= {"hull_x": pa.ListArray.from_arrays(offsets, pa.array(hx)), "hull_y": pa.ListArray.from_arrays(offsets, pa.array(hy))}
        return pa.table(made | {"area": pa.array(_areas(hx, hy, ends))})

    shape = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_points bigint, hull_x array<double>, hull_y array<double>, area double"
    return whole_groups(columns.select(*keys, "x", "low", "high", "n_points"), keys, ["x"], run, shape, n)


def _hulls(columns: DataFrame, keys: list[str], salts: int = 4096) -> DataFrame:
    """Hulls as of :func:`convex_hulls`, with ``area``, of rows ``keys, x, low, high, n_points``; keys are not null.

    A group may have several rows for one x, and points that stand for
    ``n_points`` others.
    """
    before = None
    while True:
        sizes = columns.groupBy(*keys).agg(F.count("*").alias("__n"))
        large = sizes.filter(F.col("__n") > salts)
        total, n = sizes.agg(F.sum("__n"), F.sum(F.when(F.col("__n") > salts, F.col("__n")))).first()
        if not n or (before and 2 * n > before):
            return _rings(columns, keys, total or 0)
        before = n
        parts = columns.join(large, keys).withColumn("__part", F.pmod(F.xxhash64("x"), F.ceil(F.col("__n") / F.lit(salts))))
        left = _corners(_rings(parts, [*keys, "__part"], n), keys)
        columns = cut(columns.join(large, keys, "left_anti").unionByName(left))


def _corners(outlines: DataFrame, keys: list[str]) -> DataFrame:
    """The corners of outlines as rows ``keys, x, low, high, n_points``; one corner stands for all points of its outline."""
    corners = outlines.select(*keys, "n_points", F.posexplode(F.arrays_zip("hull_x", "hull_y")).alias("__i", "__p"))
    y = F.col("__p.hull_y")
    return corners.select(
        *keys, F.col("__p.hull_x").alias("x"), y.alias("low"), y.alias("high"),
        F.when(F.col("__i") == 0, F.col("n_points")).otherwise(F.lit(0).cast("bigint")).alias("n_points"),
    )


def convex_hulls(df: DataFrame, keys: list[str], x: str = "x", y: str = "y", salts: int = 4096) -> DataFrame:
    """Convex hull of each group: ``n_points, hull_x, hull_y`` (counter-clockwise).

    Only the lowest and highest point of each x can be on a hull, and those
    are aggregated before the shuffle.  A group with more than ``salts`` values
    of x takes hulls of salted parts of about that many first, as long as that
    drops half of them, so that no very large group meets as raw points.
    """
    points = df.select(*keys, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    columns = points.filter("x is not null and y is not null").dropna(subset=keys).groupBy(*keys, "x").agg(
        F.min("y").alias("low"), F.max("y").alias("high"), F.count("*").alias("n_points")
    )
    return _hulls(cut(columns), keys, salts).drop("area")


def patch_outlines(df: DataFrame, method: str = "provided_cells", width: float = 500.0, overlap: float = 50.0) -> DataFrame:
    """Outlines ``id, patch_col, patch_row, n_points, hull_x, hull_y, area`` of the cells that :func:`patched_segmentation` gives.

    ``df`` is read once, and a transcript is not repeated for each of its
    patches: those of a cell that share x and the patches come down to their
    lowest and highest y first.
    """
    stride = _stride(width, overlap)
    x, y = need_column(df, "x"), need_column(df, "y")
    seen = Observation()
    # The frame is that of all transcripts, so also of those without a cell.
    framed = df.observe(seen, *[f(c).alias(f"{f.__name__}_{n}") for n, c in (("x", x), ("y", y)) for f in (F.min, F.max)])
    named = _SEGMENT[method](framed)
    cell = F.col(need_column(named, "cell_id")).cast("string")
    points = cut(named.select(cell.alias("cell"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna())
    frame = {k: 0.0 if v is None else float(v) for k, v in seen.get.items()}
    first, last = _span(F.col("y"), frame["min_y"], frame["max_y"], width, stride)
    columns = cut(
        points.groupBy("cell", "x", first.alias("first"), last.alias("last")).agg(
            F.min("y").alias("low"), F.max("y").alias("high"), F.count("*").alias("n_points")
        )
    )
    patched = columns.withColumn("patch_row", F.explode(F.sequence("first", "last"))).withColumn(
        "patch_col", F.explode(F.sequence(*_span(F.col("x"), frame["min_x"], frame["max_x"], width, stride)))
    )
    hulls = _hulls(patched, ["cell", "patch_col", "patch_row"])
    return hulls.select(_patch_name(F.col("cell")).alias("id"), "patch_col", "patch_row", "n_points", "hull_x", "hull_y", "area")


def cell_boundaries(df: DataFrame, cell: str = "cell_id") -> DataFrame:
    """Outline of each cell with area, centroid and transcript count.

    Fewer than 3 transcripts give a unit circle around their mean, a flat hull
    gives its bounding box.
    """
    name = F.trim(F.col(cell).cast("string"))
    valid = df.filter(F.col(cell).isNotNull() & ~name.isin("", "nan", "None"))
    counts = valid.groupBy(F.col(cell).alias("cell_id")).agg(
        F.count("*").alias("n_transcripts"), F.avg("x").alias("mx"), F.avg("y").alias("my")
    )
    hulls = convex_hulls(valid.withColumn("cell_id", F.col(cell)), ["cell_id"])
    joined = counts.join(hulls, "cell_id", "left")
    kind = dict(joined.dtypes)["cell_id"]

    def outline(batches):
        turn = np.linspace(0, 2 * np.pi, 65)[:-1]
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                n = 0 if r.hull_x is None else int(r.n_points)
                if n < 3:
                    cx, cy = (r.mx, r.my) if n else (0.0, 0.0)
                    x, y = cx + np.cos(turn), cy + np.sin(turn)
                else:
                    x, y = np.asarray(r.hull_x), np.asarray(r.hull_y)
                    if len(x) < 3:
                        x = np.array([x.min(), x.max(), x.max(), x.min()])
                        y = np.array([y.min(), y.min(), y.max(), y.max()])
                area, gx, gy = _area_centroid(x, y)
                rows.append((r.cell_id, x, y, area, gx, gy, r.n_transcripts))
            yield pd.DataFrame(rows, columns=["cell_id", "hull_x", "hull_y", "area", "centroid_x", "centroid_y", "n_transcripts"])

    made = joined.mapInPandas(
        outline,
        f"cell_id {kind}, hull_x array<double>, hull_y array<double>, area double, centroid_x double, "
        "centroid_y double, n_transcripts bigint",
    )
    return made.select(
        "cell_id",
        F.zip_with("hull_x", "hull_y", lambda a, b: F.struct(a.alias("x"), b.alias("y"))).alias("geometry"),
        "area", "centroid_x", "centroid_y", "n_transcripts",
    )


def _clip(ax, ay, bx, by) -> float:
    """Area of the intersection of two counter-clockwise convex polygons."""
    poly = list(zip(ax, ay))
    for i in range(len(bx)):
        px, py, qx, qy = bx[i - 1], by[i - 1], bx[i], by[i]
        side = [(qx - px) * (v[1] - py) - (qy - py) * (v[0] - px) for v in poly]
        out = []
        for j, v in enumerate(poly):
            u, su, sv = poly[j - 1], side[j - 1], side[j]
            if (su < 0) != (sv < 0):
                t = su / (su - sv)
                out.append((u[0] + t * (v[0] - u[0]), u[1] + t * (v[1] - u[1])))
            if sv >= 0:
                out.append(v)
        poly = out
        if len(poly) < 3:
            return 0.0
    x, y = np.array(poly).T
    return float(abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2)


def _within(ax, ay, bx, by) -> bool:
    """Whether no corner of the first polygon is outside the second, as :func:`_clip` judges it."""
    px, py = np.roll(bx, 1)[:, None], np.roll(by, 1)[:, None]
    return bool(((bx[:, None] - px) * (ay - py) - (by[:, None] - py) * (ax - px) >= 0).all())


def _shared(ax, ay, bx, by) -> float:
    # Of the outlines of a cell that a patch cuts, one is a part of the other.
    if _within(ax, ay, bx, by):
        return _area_centroid(ax, ay)[0]
    if _within(bx, by, ax, ay):
        return _area_centroid(bx, by)[0]
    return _clip(ax, ay, bx, by)


@F.pandas_udf(T.DoubleType())
def _overlap_area(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series) -> pd.Series:
    return pd.Series([np.nan if p[0] is None else _shared(*p) for p in zip(ax, ay, bx, by)], dtype=float)


@F.pandas_udf(T.DoubleType())
def _hull_area(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([_area_centroid(np.asarray(a), np.asarray(b))[0] if len(a) > 2 else 0.0 for a, b in zip(x, y)], dtype=float)


def _level() -> Column:
    size = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(2.0**-60))
    return F.ceil(F.log2(size)).cast("int")


def _levels(boxes: DataFrame) -> dict[int, int]:
    """Boxes of each size; between the least and the largest double there are no more than some hundred."""
    return {r[0]: r[1] for r in boxes.groupBy(_level()).count().collect()}


def _candidates(boxes: DataFrame, levels: list[int] | None = None) -> DataFrame:
    """Pairs ``src, dst`` of different patches whose boxes meet, each once.

    An outline lies on the grid whose squares are its own size, rounded up to
    a power of two, so in four squares at most; it looks for others on its own
    grid and on all that are coarser.  A very large outline thus meets what it
    covers, and adds no meetings among that.  A pair counts in the square that
    holds the lower corner of the common box.
    """
    own = boxes.select("id", "patch_col", "patch_row", "x1", "x2", "y1", "y2", _level().alias("level"))
    if levels is None:
        levels = list(_levels(boxes))

    def placed(df: DataFrame, side: Column) -> DataFrame:
        def squares(low: str, high: str) -> Column:
            return F.explode(F.sequence(F.floor(F.col(low) / side), F.floor(F.col(high) / side)))

        return df.withColumn("gx", squares("x1", "x2")).withColumn("gy", squares("y1", "y2"))

    asking = own.withColumn("grid", F.explode(F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v >= F.col("level"))))
    a = placed(asking, F.pow(F.lit(2.0), F.col("grid")))
    b = placed(own.withColumn("grid", F.col("level")), F.pow(F.lit(2.0), F.col("grid")))
    key = ["grid", "gx", "gy"]
    rest = [c for c in own.columns]
    met = a.select(*key, *[F.col(c).alias(f"{c}_a") for c in rest]).join(b.select(*key, *[F.col(c).alias(f"{c}_b") for c in rest]), key)
    left, low = F.greatest("x1_a", "x1_b"), F.greatest("y1_a", "y1_b")
    side = F.pow(F.lit(2.0), F.col("grid"))
    return met.filter(
        # On a common grid both ask.
        ((F.col("level_a") < F.col("level_b")) | (F.col("id_a") < F.col("id_b")))
        & ((F.col("patch_col_a") != F.col("patch_col_b")) | (F.col("patch_row_a") != F.col("patch_row_b")))
        & (left <= F.least("x2_a", "x2_b")) & (low <= F.least("y2_a", "y2_b"))
        & (F.floor(left / side) == F.col("gx")) & (F.floor(low / side) == F.col("gy"))
    ).select(F.least("id_a", "id_b").alias("src"), F.greatest("id_a", "id_b").alias("dst"))


def _boxes(outlines: DataFrame) -> DataFrame:
    return outlines.withColumns(
        {
            "x1": F.array_min("hull_x"), "x2": F.array_max("hull_x"), "y1": F.array_min("hull_y"), "y2": F.array_max("hull_y"),
            "area": F.col("area") if "area" in outlines.columns else _hull_area("hull_x", "hull_y"),
        }
    )


def overlapping_cells(outlines: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Pairs of outlines of different patches whose overlap exceeds ``threshold`` of the smaller one.

    ``outlines``: ``id, patch_col, patch_row, hull_x, hull_y``, and ``area``
    if it is known.  Ids and boxes meet first; hulls join the pairs that are left.
    """
    return _overlaps(cut(_boxes(outlines.filter(F.size("hull_x") > 2))), threshold)


def _overlaps(boxes: DataFrame, threshold: float) -> DataFrame:
    boxes = boxes.filter(F.size("hull_x") > 2)
    shape = ["hull_x", "hull_y", "area", "x1", "x2", "y1", "y2"]
    levels = _levels(boxes)
    pairs = _candidates(boxes, list(levels))
    for end in ("src", "dst"):
        pairs = pairs.join(boxes.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in shape]), end)
    smaller = F.least("area_src", "area_dst")
    wide = F.least("x2_src", "x2_dst") - F.greatest("x1_src", "x1_dst")
    high = F.least("y2_src", "y2_dst") - F.greatest("y1_src", "y1_dst")
    # No more than the common box is shared.
    hopeful = pairs.filter((smaller > 0) & (wide * high > F.lit(threshold) * smaller))
    # Pairs are few bytes, but much work: tasks get them by their number, not by their size.
    tasks = sum(levels.values()) // TASK_OUTLINES + 1
    if tasks > 1:
        hopeful = hopeful.repartition(tasks, "src", "dst")
    # A cell that no patch cuts has the same outline in all its patches.
    same = (F.col("hull_x_src") == F.col("hull_x_dst")) & (F.col("hull_y_src") == F.col("hull_y_dst"))
    unlike = [F.when(~same, F.col(c)) for c in ("hull_x_src", "hull_y_src", "hull_x_dst", "hull_y_dst")]
    shared = hopeful.withColumn("shared", F.when(same, F.col("area_src")).otherwise(_overlap_area(*unlike)))
    return shared.filter(F.col("shared") / smaller > threshold).select("src", "dst", "shared", smaller.alias("smaller"))


def resolve_patch_cells(segmented: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Merge cells of different patches that cover each other.

    ``segmented`` comes from :func:`patched_segmentation` with ``keep_patch``.
    Returns the mapping ``cell_id, resolved_id`` and the merged outlines.
    """
    return resolve_outlines(convex_hulls(segmented, ["cell_id", "patch_col", "patch_row"]).withColumnRenamed("cell_id", "id"), threshold)


def resolve_outlines(outlines: DataFrame, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """Like :func:`resolve_patch_cells`, from outlines as of :func:`patch_outlines`."""
    boxes = cut(_boxes(outlines))
    pairs = _overlaps(boxes, threshold)
    mapping = cut(
        components(pairs, boxes.select("id")).select(F.col("id").alias("cell_id"), F.col("component").alias("resolved_id"))
    )
    # The hull of a merged cell is the hull of its parts' hulls; points are not read again.
    parts = boxes.select(F.col("id").alias("cell_id"), "n_points", "hull_x", "hull_y").join(mapping, "cell_id")
    hulls = _hulls(_corners(parts, ["resolved_id"]), ["resolved_id"])
    return mapping, hulls.select("resolved_id", "hull_x", "hull_y", "n_points")
