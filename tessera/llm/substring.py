"""Removal of repeated passages, found by difference-cover anchors.

Only words at places that are a cover position modulo ``PERIOD`` start an
anchor, a hash of ``width - PERIOD + 1`` words.  For any two places there is a
shift of less than ``PERIOD`` that brings both to a cover position, so two
equal windows of ``width`` words share an anchor at the same place in both.
Anchors that occur in one document only end there; a window with an anchor
that occurs in several is hashed as a whole, and the smallest id that has it
is asked for.

Questions and answers go by blocks of documents.  A block asks each bucket of
hashes about its distinct hashes, so a hash that very many documents have
costs one entry for each block; a bucket answers with one bit for each entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import flat, window_hashes, word_hashes, words

#: The perfect difference cover of 7: every remainder is a difference of two of these.
PERIOD, COVER = 7, (0, 1, 3)
#: Bytes of text of a block of documents, and for which there is a bucket of hashes.
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 16 << 20

_ASKED = "bucket long, block long, hashes binary, more binary, ids binary"
_ANSWERED = "bucket long, block long, kind int, bits binary"
_LAST = np.iinfo(np.int64).max


def _planes(values: np.ndarray) -> bytes:
    """The bytes of numbers, all lowest ones first: what is zero in most packs well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _unplanes(held: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(size, -1).T).view(kind).ravel()


class Block:
    """Words, anchors and windows of a block of documents."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray, width: int, buckets: int):
        self.width, self.buckets = width, buckets
        held = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
        self.data, places = flat(held)
        #: A null id is after all others.
        self.ids = np.asarray(ids.fill_null(_LAST).combine_chunks().to_numpy(zero_copy_only=False), np.int64) if len(ids) else np.zeros(0, np.int64)
        self.starts, self.ends, self.before = words(self.data, places)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        n = len(self.starts)
        owner = np.repeat(np.arange(len(self.ids)), np.diff(self.before))
        place = np.arange(n) - self.before[:-1][owner]
        left = self.before[1:][owner] - np.arange(n)
        size = width - PERIOD + 1
        at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= size))
        self.owner, self.left, self.at = owner, left, at
        self.anchors, self.which = np.unique(window_hashes(self.hashes, size)[at], return_inverse=True)
        least, most = np.full(len(self.anchors), _LAST), np.full(len(self.anchors), -1, np.int64)
        np.minimum.at(least, self.which, owner[at])
        np.maximum.at(most, self.which, owner[at])
        #: Anchors of several documents of this block.
        self.local = least != most

    def parts(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """``(bucket, start, end)`` of the buckets that sorted ``hashes`` meet; only these cost."""
        if not len(hashes):
            return []
        of = hashes // np.uint64(-(-(2**64) // self.buckets)) if self.buckets > 1 else np.zeros(len(hashes), np.uint64)
        heads = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        return list(zip(of[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(hashes)]))

    def answers(self, table: pa.Table, kind: int, hashes: np.ndarray) -> np.ndarray:
        """The bits that buckets have answered; buckets without a set bit have not."""
        found = np.zeros(len(hashes), bool)
        spans = {b: (i, j) for b, i, j in self.parts(hashes)}
        for row in table.select(["bucket", "kind", "bits"]).to_pylist():
            if row["kind"] == kind:
                i, j = spans[row["bucket"]]
                found[i:j] = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=j - i).astype(bool)
        return found

    def windows(self, answered: pa.Table) -> None:
        """Hashes of the windows that hold an anchor of several documents, and the smallest id here of each."""
        shared = self.answers(answered, 0, self.anchors) | self.local
        n = len(self.starts)
        near = np.zeros(n + 1, np.int64)
        at = self.at[shared[self.which]]
        # An anchor is in the windows that start up to PERIOD - 1 words before it.
        np.add.at(near, np.maximum(at - PERIOD + 1, 0), 1)
        np.add.at(near, at + 1, -1)
        self.first = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (self.left >= self.width))
        one = window_hashes(self.hashes, self.width)[self.first]
        two = window_hashes(word_hashes(self.data, self.starts, self.ends, 1), self.width)[self.first] >> np.uint64(32)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        new = np.ones(len(order), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        heads = np.flatnonzero(new)
        self.one, self.two = one[heads], two[heads].astype(np.uint32)
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        own = self.ids[self.owner[self.first]]
        self.least = np.minimum.reduceat(own[order], heads) if len(heads) else np.zeros(0, np.int64)

    def removed(self, answered: pa.Table) -> np.ndarray:
        """Words that a window covers which starts in a document with a smaller id."""
        before = self.answers(answered, 1, self.one)
        own = self.ids[self.owner[self.first]]
        gone = self.first[before[self.group] | (self.least[self.group] < own)]
        cover = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(cover, gone, 1)
        np.add.at(cover, gone + self.width, -1)
        return np.cumsum(cover[:-1]) > 0


def _asked(rows: list[tuple[int, int, bytes, bytes, bytes]]) -> pa.Table:
    names = ["bucket", "block", "hashes", "more", "ids"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _ask_anchors(table: pa.Table, width: int, buckets: int) -> pa.Table:
    block = Block(table["__id"], table["__text"], width, buckets)
    number = table["block"][0].as_py()
    return _asked([(b, number, block.anchors[i:j].tobytes(), b"", b"") for b, i, j in block.parts(block.anchors)])


def _ask_windows(table: pa.Table, answered: pa.Table, width: int, buckets: int) -> pa.Table:
    if not table.num_rows:
        return _asked([])
    block = Block(table["__id"], table["__text"], width, buckets)
    block.windows(answered)
    number = table["block"][0].as_py()
    return _asked(
        [(b, number, block.one[i:j].tobytes(), block.two[i:j].tobytes(), _planes(block.least[i:j])) for b, i, j in block.parts(block.one)]
    )


def _answer(table: pa.Table, kind: int) -> pa.Table:
    """Bits for each asking block: of anchors, whether another block has it; of windows, whether one has it with a smaller id."""
    numbers = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]]
    sizes = np.array([len(x) for x in numbers], np.int64)
    one = np.concatenate(numbers)
    if kind:
        two = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["more"]])
        ids = np.concatenate([_unplanes(x.as_py(), "<i8") for x in table["ids"]])
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    else:
        order = np.argsort(one, kind="stable")
        same = one[order][1:] == one[order][:-1]
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    group = np.cumsum(np.concatenate([[0], ~same]))
    found = np.empty(len(one), bool)
    if kind:
        found[order] = np.minimum.reduceat(ids[order], heads)[group] < ids[order]
    else:
        found[order] = np.diff(np.append(heads, len(one)))[group] > 1
    places = np.concatenate([[0], np.cumsum(sizes)])
    rows = [
        (bucket.as_py(), block.as_py(), np.packbits(found[i:j]).tobytes())
        for bucket, block, i, j in zip(table["bucket"], table["block"], places[:-1], places[1:])
        if found[i:j].any()
    ]
    return pa.table(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([kind] * len(rows), pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "block", "kind", "bits"],
    )


def _results(table: pa.Table, answered: pa.Table, width: int, buckets: int, id: str, keep: bool) -> pa.Table:
    columns: dict[str, pa.Array] = {}
    if table.num_rows:
        block = Block(table["__id"], table["__text"], width, buckets)
        block.windows(answered)
        gone = block.removed(answered)
        starts, ends = block.starts[~gone], block.ends[~gone]
        sizes = ends - starts + 1
        at = np.concatenate([[0], np.cumsum(sizes)])
        take = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
        joined = block.data[np.minimum(take, max(len(block.data) - 1, 0))]
        joined[at[1:] - 1] = 32
        held = joined.tobytes()
        lost = np.concatenate([[0], np.cumsum(gone)])[block.before]
        first = at[block.before - lost].tolist()
        texts = [held[i : max(i, j - 1)] for i, j in zip(first[:-1], first[1:])]
        columns = {
            id: table["__id"],
            "n_words": pa.array(np.diff(block.before)),
            "n_removed": pa.array(np.diff(lost)),
            "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
        } | ({"kept": pa.array([t.decode() for t in texts])} if keep else {})
        return pa.table(columns)
    kinds = {id: table.schema.field("__id").type, "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()} | ({"kept": pa.string()} if keep else {})
    return pa.schema(list(kinds.items())).empty_table()


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 13, keep: bool = False) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` of each row; with ``keep`` also ``kept``, the text that is left.

    Words are runs without ASCII white space, unchanged.  A word goes if a
    window of ``width`` words covers it whose words also start in a document
    with a smaller id; windows are judged on the input.  Texts are shuffled
    once and read from there three times: to ask about anchors, to ask about
    windows, and to write the results.

    ``id`` is an integer.  Rows of one id do not remove each other's words,
    and a null id is after all others.  A null text has no words; a text of
    fewer than ``width`` words stays as it is.  One row per input row.
    """
    if width < 2 * PERIOD - 1:
        raise ValueError(f"windows must have at least {2 * PERIOD - 1} words")
    total = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, buckets = total // BLOCK_BYTES + 1, total // BUCKET_BYTES + 1
    rows = docs.select(F.col(id).cast("long").alias("__id"), F.col(text).alias("__text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("__id", "__text"), F.lit(blocks))).repartition("block")

    def ask_anchors(table: pa.Table) -> pa.Table:
        return _ask_anchors(table, width, buckets)

    def ask_windows(table: pa.Table, answered: pa.Table) -> pa.Table:
        return _ask_windows(table, answered, width, buckets)

    def answer_anchors(table: pa.Table) -> pa.Table:
        return _answer(table, 0)

    def answer_windows(table: pa.Table) -> pa.Table:
        return _answer(table, 1)

    def results(table: pa.Table, answered: pa.Table) -> pa.Table:
        return _results(table, answered, width, buckets, id, keep)

    schema = f"`{id}` long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep
    asked = rows.groupBy("block").applyInArrow(ask_anchors, _ASKED)
    several = asked.groupBy("bucket").applyInArrow(answer_anchors, _ANSWERED)
    asked = rows.groupBy("block").cogroup(several.groupBy("block")).applyInArrow(ask_windows, _ASKED)
    smaller = asked.groupBy("bucket").applyInArrow(answer_windows, _ANSWERED)
    answers = several.unionByName(smaller)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(results, schema)
