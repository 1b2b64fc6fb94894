"""Near duplicates by SimHash, with pigeonring filtering.

The 64 bits are a ring of ``segments`` equal parts.  If two fingerprints
differ in at most ``radius`` bits, some part starts a chain whose first l
parts differ in at most l * radius / segments bits, for every l.  So rows meet
under keys made from a chain's first part, which may not differ, and from a
piece of its second part, of which one more than the budget of two parts
exist; longer chains and at last all bits are checked where rows meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import LOWER, flat, steps, words
from tessera.llm.minhash import SKETCHED, distinct_sets, set_links, sketched
from tessera.operators.graph import components
from tessera.runtime import cut

#: Shingles whose bits are counted at a time.
BLOCK = 1 << 17
#: Rows of a key that one task compares; more are compared in tiles of two such blocks.
TILE = 2048
SEED = 42


def _fingerprints(data: np.ndarray, places: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprints of texts; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    starts, ends, before = words(data, places)
    sizes = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
    spaced = LOWER[data[np.minimum(take, len(data) - 1)]] if len(starts) else np.zeros(0, np.uint8)
    spaced[at[1:] - 1] = 32
    held = spaced.tobytes()
    n_words = np.diff(before)
    n = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    first = np.concatenate([[0], np.cumsum(n)])
    own = np.repeat(np.arange(len(n)), n)
    left = np.repeat(before[:-1] - first[:-1], n) + np.arange(first[-1])
    right = np.minimum(left + shingle, before[1:][own])
    counts = np.zeros((len(n), 64), np.int64)
    for a in range(0, len(own), BLOCK):
        b = min(a + BLOCK, len(own))
        spans = zip(at[left[a:b]].tolist(), (at[right[a:b]] - 1).tolist())
        hashes = np.fromiter((xxh64_intdigest(held[i:j], SEED) for i, j in spans), np.uint64, b - a)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        some = np.flatnonzero(np.diff(own[a:b], prepend=-1))
        counts[own[a:b][some]] += np.add.reduceat(bits, some, axis=0, dtype=np.int32)
    ones = counts * 2 > n[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fingerprint`` (64 bits as a signed long) of each row.

    ASCII letters are lowered; shingles are of ``shingle`` words, repeats
    included, hashed by XXH64; a bit is 1 if it is in over half the hashes.
    """
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            found = _fingerprints(*flat(batch.column(text)), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(found.view(np.int64))], [id, "fingerprint"])

    return docs.select(id, text).mapInArrow(run, f"{id} {kind}, fingerprint long")


class Ring:
    """Parts of the fingerprint, budgets of chains, and the keys that chains of ``chain`` parts make."""

    def __init__(self, radius: int, segments: int, chain: int = 2):
        if not 0 <= radius < segments or 64 % segments or not 2 <= chain <= segments:
            raise ValueError("segments must divide 64 and be more than radius, and a chain has 2 or more")
        self.radius, self.segments, self.width = radius, segments, 64 // segments
        self.pieces = chain * radius // segments + 1
        rest = (chain - 1) * self.width
        cuts = [round(k * rest / self.pieces) for k in range(self.pieces + 1)]
        self.cuts = list(zip(cuts[:-1], cuts[1:]))

    def keys(self, fingerprint: Column) -> Column:
        """The keys of a fingerprint: one for each chain start and piece of the next part."""
        def part(at: int, size: int) -> Column:
            """``size`` bits of the ring from ``at`` on."""
            own = F.shiftrightunsigned(fingerprint, at % 64)
            if at % 64 + size > 64:
                own = own.bitwiseOR(F.shiftleft(fingerprint, 64 - at % 64))
            return own.bitwiseAND(F.lit((1 << size) - 1))

        made = []
        for i in range(self.segments):
            for j, (a, b) in enumerate(self.cuts):
                tag = i * self.pieces + j
                own = F.shiftleft(F.lit(tag).cast("long"), 48) + F.shiftleft(part(i * self.width, self.width), 24)
                made.append(own + part((i + 1) * self.width + a, b - a))
        return F.array(*made)

    def close(self, tag: int, x: np.uint64, others: np.ndarray) -> np.ndarray:
        """Places of the others within the radius of ``x`` by the chain of the key's tag."""
        start = (tag >> 48) // self.pieces
        apart = others ^ x
        found, mask = None, 0
        for length in range(1, self.segments + 1):
            mask |= ((1 << self.width) - 1) << ((start + length - 1) % self.segments * self.width)
            good = np.flatnonzero(np.bitwise_count(apart & np.uint64(mask)) <= length * self.radius // self.segments)
            apart = apart[good]
            found = good if found is None else found[good]
            if not len(found):
                break
        return found


    def within(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether some chain of each pair of fingerprints, and at last all their bits, are within the radius."""
        apart = a ^ b
        found = np.zeros(len(apart), bool)
        for start in range(self.segments):
            left, mask = np.flatnonzero(~found), 0
            for length in range(1, self.segments + 1):
                mask |= ((1 << self.width) - 1) << ((start + length - 1) % self.segments * self.width)
                left = left[np.bitwise_count(apart[left] & np.uint64(mask)) <= length * self.radius // self.segments]
            found[left] = True
        return found


def _forest(ring: Ring, tag: int, group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect what the links among ``group`` connect; each row is compared with those not reached before it."""
    rest, reached = group[1:], [group[0]]
    while reached or len(rest):
        if not reached:
            reached.append(rest[0])
            rest = rest[1:]
        x = reached.pop()
        near = ring.close(tag, x, rest)
        if len(near):
            found = rest[near]
            yield from ((int(x), int(y)) for y in found)
            reached.extend(found)
            rest = np.delete(rest, near)


def links(distinct: DataFrame, radius: int = 3, segments: int = 4, chain: int = 2) -> DataFrame:
    """``src, dst``: links that connect the distinct fingerprints of ``distinct (fingerprint)`` as all links do.

    Every pair within ``radius`` bits is linked or connected by others; a
    group of like fingerprints gives about one link for each row of it, not
    one for each pair.  Keys of one row are dropped after a count that tasks
    pre-aggregate; keys of more than ``TILE`` rows are dealt to tiles, so no
    task holds such a key.
    """
    ring = Ring(radius, segments, chain)
    keyed = cut(distinct.select("fingerprint", F.explode(ring.keys(F.col("fingerprint"))).alias("key")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / TILE).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = met.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fingerprint")
    tiled = tiled.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(columns: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            key, _, _, prints = columns
            pairs = []
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                pairs += _forest(ring, int(key[i]), prints[i:j])
            both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["src", "dst"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            columns[3] = columns[3].view(np.uint64)
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            new = np.zeros(len(columns[0]), bool)
            for column in columns[:3]:
                new[1:] |= column[1:] != column[:-1]
            bounds = np.concatenate([[0], np.flatnonzero(new)])
            # The last group may go on in the next batch.
            yield found(columns, bounds)
            held = [column[bounds[-1] :] for column in columns]
        if held is not None and len(held[0]):
            yield found(held, np.array([0, len(held[0])]))

    return tiled.mapInArrow(run, "src long, dst long").distinct()


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, segments: int = 4
) -> DataFrame:
    """``id, fingerprint, component_id`` of each row; fingerprints link at ``radius`` or fewer differing bits.

    Rows of one fingerprint are merged first, so copies cost nothing further.
    ``component_id`` is the smallest id that links reach, null only if all of
    them are null.  Null and empty texts have fingerprint zero and link like
    any other.  One row per input row, repeated rows too.
    """
    rows = cut(fingerprints(docs, id, text, shingle))
    distinct = cut(rows.groupBy("fingerprint").agg(F.min(id).alias("__least")))
    found = cut(links(distinct.select("fingerprint"), radius, segments))
    linked = found.select(F.col("src").alias("id")).union(found.select("dst")).distinct()
    parts = components(found, linked).select(F.col("id").alias("fingerprint"), F.col("component").alias("__part"))
    parted = cut(distinct.join(parts, "fingerprint", "left").withColumn("__part", F.coalesce("__part", "fingerprint")))
    least = parted.groupBy("__part").agg(F.min("__least").alias("component_id"))
    named = parted.join(least, "__part").select("fingerprint", "component_id")
    return rows.join(named, "fingerprint").select(id, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def similar_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80, radius: int = 3, segments: int = 4, miss: float = 1e-9
) -> DataFrame:
    """``id, component_id`` of each row: groups of texts that resemble each other as word shingles do.

    Texts are linked if their sets of shingles of ``words_each`` words have a
    Jaccard index of at least ``percent`` in a hundred, counted on whole sets;
    groups are what links connect.  Candidates are texts whose fingerprints
    meet under a key of the ring and have a chain and all bits within
    ``radius``, and, as like texts may be further apart, texts that share a
    band of minima: at 80 percent, all but 3 in a million pairs do.

    ``id`` is an integer; rows of one id are one document, rows without an id
    stand alone.  Texts of fewer words have one shingle, empty ones none, and
    two without shingles are alike.  Sets are told apart by 128-bit hashes,
    shingles by 64-bit ones.
    """
    named = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter("id is not null")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            prints = _fingerprints(*flat(batch.column("text")), 3).view(np.int64)
            name, n, sketch, keys = sketched(batch.column("text"), words_each)
            # The fingerprint follows the minima, so that it is at hand wherever rows meet.
            sketch = pa.array([m + f.tobytes() for m, f in zip(sketch.to_pylist(), prints)], pa.binary())
            columns = [batch.column("id"), batch.column("row"), name, n, sketch, keys, pa.array(prints)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "row", "name", "n", "sketch", "keys", "fingerprint"])

    rows = cut(named.select("id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(describe, f"id long, row long, {SKETCHED}, fingerprint long"))
    sets = distinct_sets(rows, "fingerprint")
    ring = Ring(radius, segments)

    def close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ring.within(*[np.ascontiguousarray(x).view(np.uint64)[:, 0] for x in (a, b)])

    firm = set_links(named, sets, F.concat("keys", ring.keys(F.col("fingerprint"))), words_each, percent, miss, close)
    least = lambda name, to: sets.select(F.col("own").alias(name), F.col("least").alias(to))
    edges = firm.join(least("src", "x"), "src").join(least("dst", "y"), "dst").select(F.col("x").alias("src"), F.col("y").alias("dst"))
    same = rows.select("id", "name").join(sets.select("name", "least"), "name").select(F.col("least").alias("src"), F.col("id").alias("dst"))
    edges = cut(edges.union(same).filter("src <> dst").distinct())
    linked = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    parts = components(edges, linked).select(F.col("id").alias("__one"), F.col("component").alias("component_id"))
    found = docs.select(F.col(id)).join(parts, F.col(id) == F.col("__one"), "left")
    return found.select(id, F.coalesce("component_id", F.col(id)).alias("component_id"))
