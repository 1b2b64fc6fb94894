"""Adaptive square tiles: no tile holds more than a set number of points.

Points are addressed by their integer position on a 2^30 grid over the data's
bounding square.  A tile is the prefix of such an address: ``(depth, ix, iy)``.
A tile with too many points is split again, as finely as its count asks for,
so a dense spot or one very large group ends up in many tiles.

Groups of few rows need no tiles: tasks take them whole, one after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.runtime import cut

FINEST = 30
KEY = ["group", "depth", "ix", "iy"]
#: Rows of a task that takes whole groups.
TASK_ROWS = 1 << 16


@dataclass
class Tiling:
    """Points with their tile, the tiles that were split, and the grid's frame."""

    points: DataFrame
    x0: float
    y0: float
    width: float
    split: list[DataFrame] = field(default_factory=list)


def _address(value: Column, origin: float, width: float) -> Column:
    cell = F.floor((value - F.lit(origin)) / F.lit(width) * F.lit(float(1 << FINEST)))
    return F.least(F.greatest(cell, F.lit(0)), F.lit((1 << FINEST) - 1)).cast("bigint")


def _shared_bits(low: Column, high: Column) -> Column:
    """Leading address bits that all values between low and high have in common."""
    differ = low.bitwiseXOR(high)
    return F.lit(FINEST) - F.when(differ == 0, F.lit(0)).otherwise(F.length(F.bin(differ)))


def tile_points(points: DataFrame, limit: int = 1024) -> Tiling:
    """Assign every row of ``points`` (columns ``group, x, y``) to a tile.

    Adds ``depth, ix, iy`` and ``parent_depth``.  Only points at one and the
    same 2^-30 address can exceed ``limit``; callers merge equal locations.
    """
    frame = points.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if frame[0] is None:
        frame = (0.0, 0.0, 0.0, 0.0)
    x0, y0 = float(frame[0]), float(frame[2])
    width = max(float(frame[1]) - x0, float(frame[3]) - y0) * (1 + 1e-9) or 1.0
    zero = F.lit(0).cast("bigint")
    placed = (
        points.withColumn("qx", _address(F.col("x"), x0, width))
        .withColumn("qy", _address(F.col("y"), y0, width))
        .withColumns({"depth": F.lit(0), "ix": zero, "iy": zero, "parent_depth": F.lit(0), "open": F.lit(True)})
    )
    tiling = Tiling(placed, x0, y0, width)
    while True:
        sizes = (
            tiling.points.filter("open")
            .groupBy(*KEY)
            .agg(
                F.count("*").alias("n"),
                _shared_bits(F.min("qx"), F.max("qx")).alias("bx"),
                _shared_bits(F.min("qy"), F.max("qy")).alias("by"),
            )
            .filter((F.col("n") > limit) & (F.least("bx", "by") < FINEST))
        )
        levels = F.ceil(F.log2(F.sqrt(F.col("n") / F.lit(limit))) + 1)
        full = cut(
            sizes.select(
                *KEY,
                F.least(
                    F.lit(FINEST),
                    F.least("bx", "by") + F.least(F.greatest(levels, F.lit(1)), F.lit(4)),
                ).cast("int").alias("child_depth"),
            )
        )
        if full.isEmpty():
            break
        tiling.split.append(full)
        deeper = F.col("child_depth").isNotNull()

        def child(address: str, own: str) -> Column:
            return F.when(deeper, F.expr(f"shiftright({address}, {FINEST} - child_depth)")).otherwise(F.col(own))

        tiling.points = (
            tiling.points.join(full, KEY, "left")
            .withColumns(
                {
                    "ix": child("qx", "ix"),
                    "iy": child("qy", "iy"),
                    "parent_depth": F.when(deeper, F.col("depth")).otherwise(F.col("parent_depth")),
                    "depth": F.coalesce("child_depth", "depth"),
                    "open": deeper,
                }
            )
            .drop("child_depth")
        )
    tiling.points = tiling.points.drop("qx", "qy", "open")
    if tiling.split:
        tiling.points = cut(tiling.points)
    return tiling


def tiles_in_reach(queries: DataFrame, tiling: Tiling) -> DataFrame:
    """Tiles that the disc (``x, y, reach``) of each query may touch.

    Walks down from the whole square through the split tiles, so the work is
    proportional to the tiles met.  Tiles without points may be included.
    """
    zero = F.lit(0).cast("bigint")
    found = queries.withColumns({"depth": F.lit(0), "ix": zero, "iy": zero})
    slack = F.lit(tiling.width * 1e-9)

    def span(axis: str, origin: float, index: str) -> Column:
        cells = F.pow(F.lit(2.0), F.col("child_depth"))
        first = F.expr(f"shiftleft({index}, child_depth - depth)")
        last = F.expr(f"shiftleft({index} + 1, child_depth - depth) - 1")

        def at(value: Column) -> Column:
            return F.floor((value - F.lit(origin)) / F.lit(tiling.width) * cells).cast("bigint")

        return F.sequence(
            F.least(F.greatest(at(F.col(axis) - F.col("reach") - slack), first), last),
            F.least(F.greatest(at(F.col(axis) + F.col("reach") + slack), first), last),
        )

    for full in tiling.split:
        found = found.join(full, KEY, "left")
        inner = F.col("child_depth").isNotNull()
        one = F.array(F.lit(0).cast("bigint"))
        found = (
            found.withColumn("nx", F.explode(F.when(inner, span("x", tiling.x0, "ix")).otherwise(one)))
            .withColumn("ny", F.explode(F.when(inner, span("y", tiling.y0, "iy")).otherwise(one)))
            .withColumns(
                {
                    "ix": F.when(inner, F.col("nx")).otherwise(F.col("ix")),
                    "iy": F.when(inner, F.col("ny")).otherwise(F.col("iy")),
                    "depth": F.coalesce("child_depth", "depth"),
                }
            )
            .drop("nx", "ny", "child_depth")
        )
        side = F.lit(tiling.width) / F.pow(F.lit(2.0), F.col("depth"))

        def gap(axis: str, origin: float, index: str) -> Column:
            low = F.lit(origin) + F.col(index) * side
            return F.greatest(low - F.col(axis), F.col(axis) - low - side, F.lit(0.0))

        dx, dy = gap("x", tiling.x0, "ix"), gap("y", tiling.y0, "iy")
        found = found.filter(F.sqrt(dx * dx + dy * dy) <= F.col("reach") + slack)
    return found


def split_groups(rows: DataFrame, group: str, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of groups of at most ``limit`` rows, and those of larger ones, if there are any; no group is null."""
    large = cut(rows.groupBy(group).agg(F.count("*").alias("__n")).filter(F.col("__n") > limit).select(group))
    if large.isEmpty():
        return rows, None
    return rows.join(large, group, "left_anti"), rows.join(large, group, "left_semi")


def whole_groups(rows: DataFrame, group: str | list[str], order: list[str], run: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, n: int | None = None) -> DataFrame:
    """What ``run(table, bounds)`` gives for runs of whole groups in ``order``; group i has the rows ``bounds[i]`` to before ``bounds[i + 1]``.

    Groups are to be of bounded size, as each is held by a task; a task gets about ``TASK_ROWS`` of the ``n`` rows, which are counted if not given.
    """
    keys = [group] if isinstance(group, str) else group

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
            if table.num_rows:
                yield from run(table, bounds).combine_chunks().to_batches()

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            differ = np.zeros(table.num_rows - 1, bool)
            for key in keys:
                at = table[key].combine_chunks().dictionary_encode()
                at = (at.combine_chunks() if isinstance(at, pa.ChunkedArray) else at).indices.to_numpy(zero_copy_only=False)
                differ |= at[1:] != at[:-1]
            starts = np.concatenate([[0], np.flatnonzero(differ) + 1])
            # The last group may go on in the next batch.
            yield from made(table.slice(0, int(starts[-1])), starts)
            held = table.slice(int(starts[-1]))
        if held is not None:
            yield from made(held, np.array([0, held.num_rows]))

    tasks = (rows.count() if n is None else n) // TASK_ROWS + 1
    return rows.repartition(tasks, *keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, schema)
