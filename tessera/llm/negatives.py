"""Hard negatives by threshold joins over an inverted index, after L2AP.

Anchors and rows meet in blocks.  A task indexes a block of rows under the
thresholds of the turn: dimensions go in one common order, and of each row the
last ones are left out that, by the norms of what follows, cannot reach the
lowest threshold by themselves.  Scores are summed over the postings a few
dimensions at a time; rows whose sum and remaining norms reach no anchor's
threshold are dropped on the way, and only pairs that may still reach it are
scored in full.  Thresholds begin high and are lowered, turn by turn, for the
anchors whose windows are not full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.runtime import cut

#: Rows and anchors of a block; a task holds one block of each.
ROWS, ANCHORS = 8192, 4096
#: Anchors that are scored at a time, and dimensions between two prunings.
TOGETHER, STRIDE = 256, 8
#: Thresholds for positives by turn, as shares of the anchor's norm times a large norm of the rows; the last turn takes all.
POSITIVE = (0.75, 0.5, 0.25, None)
#: Thresholds for negatives by turn, as places between the window's top (0) and its floor (1).
NEGATIVE = (0.25, 0.5, 1.0)


class Index:
    """Postings of a block of vectors, dimensions by energy, without those that norms cover."""

    def __init__(self, vectors: np.ndarray, share: float):
        """``share``: the lowest threshold over the anchor's norm."""
        energy = (vectors * vectors).sum(0)
        self.dims = np.argsort(-energy, kind="stable")
        x = vectors[:, self.dims]
        #: Norms of the dimensions from each on.
        self.rest = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])
        self.rest = np.concatenate([self.rest, np.zeros((len(x), 1))], axis=1)
        # What is left of a row from this dimension on reaches no threshold alone.
        kept = (self.rest[:, :-1] >= share * (1 - 1e-9)).sum(1) if share > 0 else np.full(len(x), x.shape[1])
        # Rows with the most postings first: those of a dimension are then the first rows.
        self.order = np.argsort(-kept, kind="stable")
        self.x, self.rest, self.kept = x[self.order], self.rest[self.order], kept[self.order]
        self.exact = vectors

    def above(self, anchors: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(anchor, row, score)`` of the pairs with a score of at least the anchor's ``least``; anchors in blocks."""
        for a in range(0, len(anchors), TOGETHER):
            own, low = anchors[a : a + TOGETHER][:, self.dims], least[a : a + TOGETHER]
            left = np.sqrt(np.cumsum((own * own)[:, ::-1], axis=1)[:, ::-1])
            left = np.concatenate([left, np.zeros((len(own), 1))], axis=1)
            slack = 1e-9 * (1 + left[:, :1])
            rows = np.arange(int((self.kept > 0).sum()))
            sums = np.zeros((len(own), len(rows)))
            for d in range(0, own.shape[1], STRIDE):
                end = min(d + STRIDE, own.shape[1])
                # Rows stay in order of their postings, so those with any from here on come first.
                n = int(np.searchsorted(-self.kept[rows], -d, "left"))
                if not n:
                    break
                cells = self.x[rows[:n], d:end] * (np.arange(d, end) < self.kept[rows[:n], None])
                sums[:, :n] += own[:, d:end] @ cells.T
                at = np.minimum(self.kept[rows], end)
                can = sums + left[:, at] * self.rest[rows, at] + slack >= low[:, None]
                alive = can.any(0)
                rows, sums = rows[alive], sums[:, alive]
                if not len(rows):
                    break
            if not len(rows):
                continue
            at = self.kept[rows]
            who, which = np.nonzero(sums + left[:, at] * self.rest[rows, at] + slack >= low[:, None])
            row = self.order[rows[which]]
            for i in range(0, len(who), 1 << 18):
                w, r = who[i : i + (1 << 18)], row[i : i + (1 << 18)]
                score = np.einsum("ij,ij->i", anchors[a + w], self.exact[r])
                good = score >= low[w]
                yield a + w[good], r[good], score[good].astype(np.int64)


def _packed(values: list, size: int) -> np.ndarray:
    """Packed vectors as a matrix of ``size`` columns; shorter ones end in zeros."""
    found = np.zeros((len(values), size))
    for i, x in enumerate(values):
        own = np.frombuffer(x, "<i2" if x[:1] == b"s" else "<f8", offset=1) if len(x) > 1 else np.zeros(0)
        found[i, : len(own)] = own
    return found


def quantised(embeddings: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", labels: int = 10, moved: int = 7) -> DataFrame:
    """``id, label, vector`` of the rows that take part, with whole components, packed.

    Rows whose id, label or vector is null or that have a null or non-finite
    component take no part.  A component x becomes floor(256 x); where the id
    is divisible by ``moved``, the label (label + 1) % ``labels``.  Rows
    of one id count once: the least label, then the least packed vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("vector")
            places = np.asarray(held.offsets)
            flat = np.floor(256 * np.nan_to_num(held.values.to_numpy(zero_copy_only=False).astype(np.float64)))
            made = []
            for i, j in zip(places[:-1].tolist(), places[1:].tolist()):
                own = flat[i:j]
                small = not len(own) or np.abs(own).max() < 1 << 15
                made.append(b"s" + own.astype("<i2").tobytes() if small else b"d" + own.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(made, pa.binary())], ["id", "label", "vector"])

    x = F.col("vector")
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter("id is not null and label is not null and vector is not null").filter(finite)
    rows = rows.withColumn("label", F.when(F.col("id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label")))
    packed = rows.mapInArrow(run, "id long, label long, vector binary")
    return packed.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own")).select("id", "own.label", "own.vector")


def _best(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first rows of each key: higher scores, then smaller ids."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other")
    return rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)


def _met(rows: DataFrame, asked: DataFrame, blocks: int, anchor_blocks: int, search, schema: str) -> DataFrame:
    """``search(table of rows, table of asked)`` for every block of rows and of what is asked."""
    left = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))
    right = asked.withColumn("side", F.pmod(F.xxhash64("anchor"), F.lit(anchor_blocks)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))
    return left.groupBy("block", "side").cogroup(right.groupBy("block", "side")).applyInArrow(search, schema)


def hard_negatives(
    embeddings: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``quantised`` says which rows take part.  Anchors are rows whose id is
    divisible by ``every``; an anchor's positives are its first other rows of
    the same label, by inner product, then smaller id.  For each, the first
    rows of other labels follow whose score is from ``percent`` percent of the
    positive's score up to that score; a positive score below zero leaves no
    such row.  Scores are whole numbers, exact up to 2^53; missing components
    of shorter vectors count as 0, and an empty vector scores 0.

    Anchors meet all rows, block by block: a block of rows goes to one task
    for each block of anchors and back, and each task returns at most as many
    rows a window as the window holds.  The last turn has the window's own
    floor as threshold (for positives: none), so what is returned is exact.
    """
    rows = cut(quantised(embeddings, id, vector, label))
    size = F.greatest(F.floor((F.octet_length("vector") - 1) / F.when(F.substring("vector", 1, 1) == F.lit(b"s"), 2).otherwise(8)), F.lit(0))
    about = rows.agg(F.count("*").alias("n"), F.max(size).alias("size"), F.sum((F.col("id") % every == 0).cast("long")).alias("anchors")).first()
    width = max(int(about["size"] or 0), 1)
    blocks, anchor_blocks = -(-about["n"] // ROWS) or 1, -(-(about["anchors"] or 0) // ANCHORS) or 1
    anchors = rows.filter(F.col("id") % every == 0).select(F.col("id").alias("anchor"), F.col("label").alias("own"), F.col("vector").alias("at"))

    def positive_search(share: float | None):
        def search(table: pa.Table, asked: pa.Table) -> pa.Table:
            found = []
            if table.num_rows and asked.num_rows:
                ids, kinds = table["id"].to_numpy(), table["label"].to_numpy()
                who, own = asked["anchor"].to_numpy(), asked["own"].to_numpy()
                x, q = _packed(table["vector"].to_pylist(), width), _packed(asked["at"].to_pylist(), width)
                norms, level = np.sqrt((q * q).sum(1)), asked["level"].to_numpy()
                for kind in np.unique(own).tolist():
                    r, a = np.flatnonzero(kinds == kind), np.flatnonzero(own == kind)
                    if not len(r):
                        continue
                    least = np.full(len(a), -np.inf) if share is None else share * norms[a] * level[a]
                    # No bound is above zero for an anchor of zeros, nor where all rows are zeros: those wait for the last turn.
                    least[least == 0] = np.inf
                    index = Index(x[r], -1.0 if share is None else share * float(level[a].min()))
                    for i, j, score in index.above(q[a], least):
                        found.append(_first(who[a[i]], ids[r[j]], score, positives, who[a[i]] != ids[r[j]]))
            return _table(found, ["anchor", "other", "score"])

        return search

    # A norm that few rows exceed sets the turns' thresholds; it decides nothing else.
    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.sqrt((_packed(batch.column("vector").to_pylist(), width) ** 2).sum(1)))], ["norm"])

    level = rows.select("vector").mapInArrow(squares, "norm double").agg(F.percentile_approx("norm", 0.9, 100)).first()[0] or 0.0
    left, best = anchors.withColumn("level", F.lit(float(level))), None
    for share in POSITIVE:
        found = _met(rows, left, blocks, anchor_blocks, positive_search(share), "anchor long, other long, score long")
        found = _best(found, ["anchor"], positives)
        full = F.count("*").over(Window.partitionBy("anchor")) >= (positives if share is not None else 0)
        found = cut(found.withColumn("full", full).filter("full").drop("full"))
        best = found if best is None else best.unionByName(found)
        left = cut(left.join(found.select("anchor").distinct(), "anchor", "left_anti"))
        if left.isEmpty():
            break
    best = cut(best.select("anchor", F.col("other").alias("positive"), F.col("score").alias("top")))

    def negative_search(depth: float):
        def search(table: pa.Table, asked: pa.Table) -> pa.Table:
            found = []
            if table.num_rows and asked.num_rows:
                ids, kinds = table["id"].to_numpy(), table["label"].to_numpy()
                x = _packed(table["vector"].to_pylist(), width)
                who, own, top = (asked[k].to_numpy() for k in ("anchor", "own", "top"))
                low = _threshold(top, percent, depth)
                first, at = np.unique(who, return_index=True)
                q = _packed(asked["at"].take(pa.array(at)).to_pylist(), width)
                least = np.full(len(first), np.iinfo(np.int64).max, np.int64)
                place = np.searchsorted(first, who)
                np.minimum.at(least, place, low)
                norms = np.sqrt((q * q).sum(1))
                share = float((least / np.maximum(norms, 1e-300)).min())
                windows = np.argsort(place, kind="stable")
                bounds = np.searchsorted(place[windows], np.arange(len(first) + 1))
                positive = asked["positive"].to_numpy()
                for i, j, score in Index(x, share).above(q, least.astype(np.float64)):
                    other = kinds[j] != own[at[i]]
                    i, j, score = i[other], j[other], score[other]
                    # Every pair once for each window of its anchor.
                    times = (bounds[i + 1] - bounds[i])
                    pair = np.repeat(np.arange(len(i)), times)
                    w = windows[np.repeat(bounds[i] - np.cumsum(times) + times, times) + np.arange(times.sum())]
                    good = (score[pair] >= low[w]) & (score[pair] <= top[w])
                    pair, w = pair[good], w[good]
                    found.append(_first(w, ids[j[pair]], score[pair], negatives))
            merged = _merge(found, negatives)
            w = merged[0]
            return pa.table({"anchor": asked["anchor"].take(pa.array(w)), "positive": asked["positive"].take(pa.array(w)), "other": pa.array(merged[1]), "score": pa.array(merged[2])}) if len(w) else _table([], ["anchor", "positive", "other", "score"])

        return search

    left, done = cut(best.filter("top >= 0").join(anchors, "anchor")), None
    for depth in NEGATIVE:
        found = _met(rows, left, blocks, anchor_blocks, negative_search(depth), "anchor long, positive long, other long, score long")
        found = _best(found, ["anchor", "positive"], negatives)
        full = F.count("*").over(Window.partitionBy("anchor", "positive")) >= (negatives if depth < 1 else 0)
        found = cut(found.withColumn("full", full).filter("full").drop("full"))
        done = found if done is None else done.unionByName(found)
        left = cut(left.join(found.select("anchor", "positive").distinct(), ["anchor", "positive"], "left_anti"))
        if left.isEmpty():
            break
    return done.join(best, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def _threshold(top: np.ndarray, percent: int, depth: float) -> np.ndarray:
    """The least whole score ``depth`` of the way from the window's top to its floor."""
    floor = -((-percent * top) // 100)
    return floor if depth >= 1 else np.maximum(floor, top - np.floor((top - floor) * depth).astype(np.int64))


def _first(key: np.ndarray, other: np.ndarray, score: np.ndarray, most: int, good: np.ndarray | None = None) -> np.ndarray:
    """The rows ``key, other, score`` of each key with the highest scores, then smallest others."""
    if good is not None:
        key, other, score = key[good], other[good], score[good]
    order = np.lexsort((other, -score, key))
    key, other, score = key[order], other[order], score[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)
    place = np.arange(len(key)) - np.repeat(head, np.diff(np.append(head, len(key))))
    return np.stack([key, other, score])[:, place < most]


def _merge(found: list[np.ndarray], most: int) -> np.ndarray:
    rows = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    return _first(*rows, most)


def _table(found: list[np.ndarray], names: list[str]) -> pa.Table:
    rows = np.concatenate(found, axis=1) if found else np.zeros((len(names), 0), np.int64)
    return pa.table({name: pa.array(rows[i].copy()) for i, name in enumerate(names)})
