"""Links between sets of word shingles: rows that meet under keys, and exact verification.

Candidates come from keys that like sets share.  Rows of a key go in order of
size and each is first paired with the next ones: all pairs where few rows have
the key, and what connects groups of near copies where many have.  Keys whose
rows verified links do not connect are then compared whole, in tiles of two
blocks whose sets are at hand: a pair is verified where it is found, and a tile
gives as many links as connect its rows.  So components are those of all links
among candidates, without a list of all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.batches import LOWER, flat, mixed, steps, window_hashes, word_hashes, words
from tessera.operators.graph import components
from tessera.runtime import cut

#: Rows of a key with which a row is paired at once, so keys of one row more have all their pairs.
NEXT = 2
#: Rows of other groups, among so many around it in a key, with which a row that was left out is paired before tiles are made.
FEW, REACH = 4, 16
#: Keys in which it looks for them.
SOUGHT = 4
#: Rows of a block of a key; larger keys are compared in tiles of two blocks.
TILE = 512
#: Partners of one row that are verified in a row.
TOGETHER = 256


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles of ``width`` words (A-Z lowered); fewer words make one shingle, none an empty set."""
    data, places = flat(texts)
    data = LOWER[data]
    starts, ends, before = words(data, places)
    hashes = word_hashes(data, starts, ends)
    whole = window_hashes(hashes, width)
    return [
        np.unique(whole[i : j - width + 1]) if j - i >= width else window_hashes(hashes[i:j], j - i)[: j > i]
        for i, j in zip(before[:-1].tolist(), before[1:].tolist())
    ]


def set_name(own: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    one, two = mixed(own), mixed(own ^ np.uint64(0xD6E8FEB86659FD93))
    return np.array([one.sum(dtype=np.uint64) + np.uint64(len(own)), two.sum(dtype=np.uint64)], np.uint64).tobytes()


def pairs_and_crowds(keyed: DataFrame, ratio: float) -> DataFrame:
    """``crowd, a, b, n``: pairs of rows that meet under a key, and ``(key, own, n)`` of the rows of keys with more rows than that covers.

    ``keyed (key, own, n)`` has a row once for each of its keys.  Sizes of a
    pair differ by at most the factor ``ratio``.
    """
    sorted_rows = keyed.repartition("key").sortWithinPartitions("key", "n", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(key: np.ndarray, own: np.ndarray, n: np.ndarray, low: int, high: int) -> pa.RecordBatch:
            """What the rows from ``low`` to before ``high`` give; those around them are known."""
            crowd = np.zeros(len(key), bool)
            span = NEXT + 2
            if len(key) >= span:
                at = np.flatnonzero(key[: len(key) - span + 1] == key[span - 1 :])
                for d in range(span):
                    crowd[at + d] = True
            a, b = [], []
            for d in range(1, NEXT + 1):
                i = np.arange(low, min(high, len(key) - d))
                i = i[(key[i] == key[i + d]) & (n[i] >= ratio * n[i + d])]
                a.append(np.minimum(own[i], own[i + d]))
                b.append(np.maximum(own[i], own[i + d]))
            some = low + np.flatnonzero(crowd[low:high])
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0)
            kind = np.concatenate([np.zeros(len(pairs), bool), np.ones(len(some), bool)])
            columns = [np.concatenate([pairs[:, 0], key[some]]), np.concatenate([pairs[:, 1], own[some]]), np.concatenate([np.zeros(len(pairs), np.int64), n[some]])]
            return pa.RecordBatch.from_arrays([pa.array(kind), *map(pa.array, columns)], ["crowd", "a", "b", "n"])

        held, done = [np.zeros(0, np.int64)] * 3, 0
        for batch in batches:
            rows = [np.concatenate([h, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for h, k in zip(held, ("key", "own", "n"))]
            # The last rows wait for those that follow.
            high = max(len(rows[0]) - NEXT - 1, done)
            if high > done:
                yield made(*rows, done, high)
            keep = max(high - NEXT - 1, 0)
            held, done = [r[keep:] for r in rows], high - keep
        if len(held[0]) > done:
            yield made(*held, done, len(held[0]))

    return cut(sorted_rows.select("key", "own", "n").mapInArrow(run, "crowd boolean, a long, b long, n long"))


Test = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def filtered(pairs: DataFrame, sets: DataFrame, test: Test) -> DataFrame:
    """The pairs that ``test(n of a, n of b, sketches of a, sketches of b)`` does not refuse."""
    side = lambda name: sets.select(F.col("own").alias(name), F.col("n").alias("n" + name), F.col("sketch").alias("s" + name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sketches = [np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in ("sa", "sb")]
            good = test(batch.column("na").to_numpy(), batch.column("nb").to_numpy(), *sketches)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, held: DataFrame, good: Callable[[int, int, int], bool]) -> DataFrame:
    """The pairs ``a, b`` whose whole sets ``held (own, members)`` pass ``good(size, size, size of the intersection)``.

    The set of ``a`` goes once to each task's run of its partners, at most
    ``TOGETHER`` of them, so a row with very many partners is dealt to several.
    """
    count = pairs.groupBy("a").agg(F.count("*").alias("partners"))
    dealt = pairs.join(count, "a").withColumn("deal", F.pmod(F.xxhash64("b"), F.ceil(F.col("partners") / TOGETHER)).cast("int"))
    partners = dealt.select("a", "deal", "b").join(held.select(F.col("own").alias("b"), "members"), "b").select("a", "deal", "b", "members")
    first = dealt.select("a", "deal").distinct().join(held.select(F.col("own").alias("a"), "members"), "a").select("a", "deal", F.lit(None).cast("long").alias("b"), "members")
    runs = first.unionByName(partners).repartition("a", "deal").sortWithinPartitions("a", "deal", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            found = []
            for a, b, members in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("members")):
                set_ = np.frombuffer(members.as_buffer(), np.uint64)
                if b is None:
                    own = set_.copy()
                elif len(own) and len(set_):
                    both = int((own[np.minimum(np.searchsorted(own, set_), len(own) - 1)] == set_).sum())
                    if good(len(own), len(set_), both):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"])

    return runs.mapInArrow(run, "a long, b long")


def _neighbours(rows: DataFrame, ratio: float) -> DataFrame:
    """``a, b``: rows outside their key's largest part with about ``FEW`` of other parts among the ``REACH`` before and after them.

    ``rows`` has ``key, n, own, part, large``.  A row looks around in
    ``SOUGHT`` of its keys, so that its pairs do not follow their number.
    """
    # A row has a bounded number of keys.
    nth = F.row_number().over(Window.partitionBy("own").orderBy("left", F.xxhash64("key"), "key"))
    left = rows.select("key", "n", "own", "part", (F.col("part") == F.col("large")).alias("left"))
    marked = left.select("key", "n", "own", "part", (~F.col("left") & (nth <= SOUGHT)).cast("long").alias("seeks"))
    ordered = marked.repartition("key").sortWithinPartitions("key", "n", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, used = [np.zeros(0, np.int64)] * 5, np.zeros(0, np.int64)
        for batch in batches:
            before = len(used)
            key, n, own, part, seeks = held = [np.concatenate([h, batch.column(k).to_numpy()]) for h, k in zip(held, ("key", "n", "own", "part", "seeks"))]
            used, found = np.concatenate([used, np.where(seeks[before:] == 1, 0, FEW)]), []
            for d in range(1, min(REACH, len(key) - 1) + 1):
                i = np.arange(max(before - d, 0), len(key) - d)
                i = i[(key[i] == key[i + d]) & (part[i] != part[i + d]) & (n[i] >= ratio * n[i + d]) & ((used[i] < FEW) | (used[i + d] < FEW))]
                used[i] += 1
                used[i + d] += 1
                found.append(np.stack([np.minimum(own[i], own[i + d]), np.maximum(own[i], own[i + d])], axis=1))
            both = np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])
            held, used = [h[-REACH:] for h in held], used[-REACH:]

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _resolved(tiled: DataFrame, test: Test, once: Once | None, good: Callable[[int, int, int], bool], ratio: float) -> DataFrame:
    """``src, dst``: verified links of rows of one tile that connect what all its good pairs connect, beyond what parts do."""

    def tile(held: pa.Table) -> list[tuple[int, int]]:
        own, part, found = held["own"].to_numpy(), held["part"].to_numpy().copy(), []
        members = [np.frombuffer(x.as_buffer(), np.uint64) for x in held["members"]]
        for i, j in _partners(held, test, once, ratio):
            for k in j.tolist():
                if part[k] != part[i]:
                    a, b = members[i], members[k]
                    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
                    if good(len(a), len(b), both):
                        found.append((int(own[i]), int(own[k])))
                        part[part == part[k]] = part[i]
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _each_tile(batches, "members"):
            found = tile(held)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["src", "dst"])

    return tiled.mapInArrow(run, "src long, dst long")


def _each_tile(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each tile, from rows in the order of tiles."""
    held: list[pa.RecordBatch] = []
    for whole in batches:
        for batch in steps(iter([whole]), column):
            keys = [batch.column(k).to_numpy() for k in ("key", "x", "y")]
            edges = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            bounds = [0, *edges.tolist(), batch.num_rows]
            for i, j in zip(bounds[:-1], bounds[1:]):
                # A tile may go on in the next batch.
                if held and any(held[0].column(k)[0].as_py() != batch.column(k)[i].as_py() for k in ("key", "x", "y")):
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _partners(held: pa.Table, test: Test, once: Once | None, ratio: float) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a tile with the later ones of other parts that the test allows and that are compared here."""
    n, part, block = (held[k].to_numpy() for k in ("n", "part", "block"))
    sketch = np.frombuffer(b"".join(held["sketch"].to_pylist()), np.uint8).reshape(len(n), -1)
    crossed = held["x"][0].as_py() != held["y"][0].as_py()
    about = once.prepare(sketch) if once else None
    for i in range(len(n) - 1):
        j = np.arange(i + 1, i + 1 + np.searchsorted(n[i + 1 :], n[i] / ratio, "right"))
        j = j[part[j] != part[i]]
        if crossed:
            j = j[block[j] != block[i]]
        if len(j):
            j = j[test(np.full(len(j), n[i]), n[j], np.broadcast_to(sketch[i], (len(j), sketch.shape[1])), sketch[j])]
        if once and len(j):
            j = j[once.here(sketch[i], sketch[j], about)]
        if len(j):
            yield i, j


def _wanted(tiled: DataFrame, test: Test, once: Once | None, ratio: float) -> DataFrame:
    """The rows of tiles that have a partner; only their whole sets are fetched."""
    names = ["key", "x", "y", "block", "own", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _each_tile(batches, "sketch"):
            some = np.zeros(len(held), bool)
            for i, j in _partners(held, test, once, ratio):
                some[i] = True
                some[j] = True
            if some.any():
                yield from held.select(names).filter(pa.array(some)).combine_chunks().to_batches()

    return tiled.mapInArrow(run, "key long, x int, y int, block int, own long, part long")


class Once:
    """Which of the keys that a pair shares compares it."""

    def prepare(self, sketch: np.ndarray):
        """What is known of a tile by the sketches of its rows."""
        raise NotImplementedError

    def here(self, one: np.ndarray, others: np.ndarray, about) -> np.ndarray:
        """The pairs that are compared in this tile; each pair is in one of its tiles at least."""
        raise NotImplementedError


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows of open keys in tiles ``x, y`` of two blocks; two blocks of the key's largest part do not meet."""
    blocks = lambda c: F.ceil(c / TILE).cast("int")
    first, others = blocks(F.col("most")), blocks(F.col("rows") - F.col("most"))
    inside = F.col("part") == F.col("large")
    own = F.when(inside, F.pmod(F.xxhash64("own"), first)).otherwise(first + F.pmod(F.xxhash64("own"), others)).cast("int")
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.when(inside, first).otherwise(F.lit(0)), first + others - 1)))
    return rows.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "own", "part")


def links(
    sets: DataFrame,
    keyed: DataFrame,
    load: Callable[[DataFrame], DataFrame],
    test: Test,
    good: Callable[[int, int, int], bool],
    similarity: float,
    once: Once | None = None,
) -> DataFrame:
    """``src, dst``: verified links among ``sets (own, n, sketch)`` that connect what all links among candidates connect.

    ``keyed (key, own, n)``: rows of one key are candidates, unless ``test``
    refuses their sketches.  ``load(owns)`` gives ``own, members`` for the
    sets asked for.  Links are pairs that are ``good``.
    """
    ratio = similarity - 1e-9
    met = pairs_and_crowds(keyed, ratio)
    pairs = cut(filtered(met.filter("NOT crowd").select("a", "b").distinct(), sets, test))
    held = cut(load(pairs.select(F.col("a").alias("own")).union(pairs.select("b")).distinct()))
    firm = cut(verified(pairs, held, good).select(F.col("a").alias("src"), F.col("b").alias("dst")))
    crowds = met.filter("crowd").select(F.col("a").alias("key"), F.col("b").alias("own"), "n")

    def parted() -> DataFrame:
        """Rows of crowds with the part that links put them in, and the key's largest part; keys of one part are done."""
        vertices = firm.select(F.col("src").alias("id")).union(firm.select("dst")).distinct()
        parts = components(firm, vertices).select(F.col("id").alias("own"), F.col("component").alias("part"))
        rows = crowds.join(parts, "own", "left").withColumn("part", F.coalesce("part", "own"))
        sizes = rows.groupBy("key", "part").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("key").agg(F.max_by("part", F.struct("size", "part")).alias("large"), F.sum("size").alias("rows"), F.max("size").alias("most"))
        return cut(rows.join(largest.filter("most < rows"), "key"))

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.join(sets.select("own", "n", "sketch"), "own").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "n", "own")

    # Rows that the first pairs left out of a group meet a few of its members before any are compared with all.
    near = _neighbours(parted(), ratio)
    pairs = cut(filtered(near.join(pairs, ["a", "b"], "left_anti"), sets, test))
    held = cut(load(pairs.select(F.col("a").alias("own")).union(pairs.select("b")).distinct()))
    firm = cut(firm.union(verified(pairs, held, good).select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    wanted = cut(_wanted(in_order(_tiles(parted())), test, once, ratio))
    held = cut(load(wanted.select("own").distinct()))
    return cut(firm.union(_resolved(in_order(wanted.join(held, "own")), test, once, good, ratio)))


def class_of(sets: DataFrame, firm: DataFrame) -> DataFrame:
    """``name, component_id``: of each set the smallest id that links reach; ``sets`` has ``name, own, least``."""
    linked = firm.select(F.col("src").alias("id")).union(firm.select("dst")).distinct()
    parts = components(firm, linked).select(F.col("id").alias("own"), F.col("component").alias("part"))
    parted = sets.select("name", "own", "least").join(parts, "own", "left").withColumn("part", F.coalesce("part", "own"))
    least = parted.groupBy("part").agg(F.min("least").alias("component_id"))
    return parted.join(least, "part").select("name", "component_id")
