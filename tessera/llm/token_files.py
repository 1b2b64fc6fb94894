"""Token ids in files of directly addressable codes.

An id is split into chunks of 8 bits.  Level 0 holds the lowest chunk of every
id, and a bitmap that says which ids go on; level 1 holds the next chunk of
those, and so on.  A rank directory counts the set bits before every 512th, so
the place of an id's next chunk is one directory entry and at most 512 bits
away: any token is read without decoding its neighbours.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.batches import SPACE, Memo, flat, pieces, slices, steps
from tessera.llm.token_counts import balanced, json_tokenizer, splits_safely

#: Tokens of a segment; a longer document is a segment of its own.
SEGMENT = 1 << 19
#: Bits between two entries of a rank directory.
BLOCK = 512
#: Pieces whose ids a worker keeps, twice.
KEPT = 300_000
#: Ends of pieces that are white space in Unicode (and U+180E, which was).
BLANK = tuple(chr(c).encode() for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
BLANK_ENDS = frozenset(x[-1] for x in BLANK)
#: Pieces that are encoded in a row.
ROW = 500
#: Bytes of text of a step.
STEP = 4 << 20

LEVELS = "levels array<struct<chunks:binary,more:binary,ranks:binary>>"


def to_levels(ids: np.ndarray) -> list[dict]:
    """The levels of ``ids`` (unsigned)."""
    levels, left = [], ids.astype(np.uint64)
    while len(left):
        more = left > 255
        bits = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(np.bitwise_count(bits).astype(np.uint32), np.arange(0, len(bits), BLOCK // 8))
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4")
        levels.append({"chunks": (left & np.uint64(255)).astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        left = left[more] >> np.uint64(8)
    return levels


def from_levels(levels: list[dict]) -> np.ndarray:
    """All ids of a segment."""
    ids = np.zeros(0, np.uint64)
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], np.uint8).astype(np.uint64)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunks), bitorder="little").astype(bool)
        chunks[more] |= ids << np.uint64(8)
        ids = chunks
    return ids


def id_at(levels: list[dict], place: int) -> int:
    """One id of a segment, from one chunk, bit and rank of each level."""
    found = shift = 0
    for level in levels:
        found |= level["chunks"][place] << shift
        if not level["more"][place >> 3] >> (place & 7) & 1:
            break
        block = place // BLOCK
        before = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        bits = int.from_bytes(level["more"][block * BLOCK // 8 : (place >> 3) + 1], "little")
        place = before + (bits & ((1 << (place - block * BLOCK)) - 1)).bit_count()
        shift += 8
    return found


def token_sizes(tokenizer) -> np.ndarray:
    """Bytes that each id of a byte-level vocabulary spells: a character for each, but for added tokens."""
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    held = tokenizer.get_vocab(with_added_tokens=True)
    sizes = np.zeros(max(held.values()) + 1, np.int64)
    for token, i in held.items():
        sizes[i] = len(token.encode()) if token in added else len(token)
    return sizes


SPACE_AT = SPACE.tolist()


def listed(texts: pa.Array) -> list[bytes]:
    """The values of a large binary array without nulls, cut from its buffer at once."""
    data, places = flat(texts)
    held, ends = data.tobytes(), places.tolist()
    return [held[i:j] for i, j in zip(ends[:-1], ends[1:])]


def encoder(path: str):
    """A function from Arrow texts to (ids of all texts, the n + 1 places where texts begin)."""
    tokenizer = json_tokenizer(path)
    safe = splits_safely(tokenizer)

    def encode(texts: list[bytes]) -> list[bytes]:
        found: list[bytes] = []
        for part in balanced([t.decode() for t in texts]):
            found += [np.array(x.ids, np.uint32).tobytes() for x in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return found

    if safe:
        sizes_of = token_sizes(tokenizer)

    def encode_pieces(texts: list[bytes]) -> list[bytes]:
        """Like ``encode``, with many pieces in a row: what tokens spell tells where a piece ends."""
        # What begins a text, or ends one with white space, would join what stands next to it in a row.
        alone = np.array([not SPACE_AT[t[0]] or (t[-1] in BLANK_ENDS and t.endswith(BLANK)) for t in texts])
        found: list[bytes] = [b""] * len(texts)
        for i, x in zip(np.flatnonzero(alone).tolist(), encode([t for t, own in zip(texts, alone) if own])):
            found[i] = x
        rest = np.flatnonzero(~alone).tolist()
        for start in range(0, len(rest), ROW):
            own = rest[start : start + ROW]
            row = [texts[i] for i in own]
            ids = np.array(tokenizer.encode_batch_fast([b"".join(row).decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.searchsorted(np.cumsum(sizes_of[ids]), np.cumsum([len(t) for t in row])) + 1
            held = ids.tobytes()
            before = 0
            for i, end in zip(own, (4 * ends).tolist()):
                found[i] = held[before:end]
                before = end
        return found

    kept = Memo(encode_pieces, KEPT)

    def run(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, places = flat(texts)
        if not safe:
            each = encode(slices(data, places[:-1], places[1:]).to_pylist())
            return np.frombuffer(b"".join(each), np.uint32), np.concatenate([[0], np.cumsum([len(x) // 4 for x in each])]).astype(np.int64)
        starts, before = pieces(data, places)
        coded = slices(data, starts, np.append(starts[1:], len(data))[: len(starts)]).dictionary_encode()
        each = kept(listed(coded.dictionary))
        codes = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        take = np.repeat(at[codes] - ends[:-1], sizes[codes]) + np.arange(ends[-1])
        return np.frombuffer(b"".join(each), np.uint32)[take], ends[before]

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", end: int = 0) -> None:
    """Write the ids of all whole texts, each followed by ``end``, in ascending order of ``id``.

    The table at ``path`` has a row for each segment: ``part`` and ``seq``
    (its order), ``at`` (tokens of the part before it), ``n_tokens``, ``ids``
    and ``counts`` (its documents and their tokens) and the levels.  Rows are
    range partitioned before they are encoded, so each is encoded once, and
    each task streams its documents into segments.

    A null text counts as empty and so holds ``end`` alone.  Null ids come
    first; rows of one id are in order of their texts' hash, then text, and
    may be spread over tasks.  An empty table writes no segments.
    """
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        names, counts, ids = [], [], []
        seq = at = held = 0

        def segment() -> pa.RecordBatch:
            row = {"part": part, "seq": seq, "at": at, "n_tokens": held, "ids": names, "counts": counts, "levels": to_levels(np.concatenate(ids))}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in steps(batches, text, STEP):
            schema = pa.schema(
                [("part", pa.int32()), ("seq", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(batch.schema.field(id).type)),
                 ("counts", pa.list_(pa.int64())), ("levels", pa.list_(pa.struct([(n, pa.binary()) for n in ("chunks", "more", "ranks")])))]
            )
            tokens, places = encode(batch.column(text))
            tokens = np.insert(tokens, places[1:], end)
            places = places + np.arange(len(places))
            first = 0
            keys = batch.column(id).to_pylist()
            while first < len(keys):
                # As many documents as fit into the segment, at least one.
                last = max(first + 1, int(np.searchsorted(places, places[first] + SEGMENT - held, "right")) - 1)
                names += keys[first:last]
                counts += np.diff(places[first : last + 1]).tolist()
                ids.append(tokens[places[first] : places[last]])
                held += int(places[last] - places[first])
                first = last
                if held >= SEGMENT or first < len(keys):
                    yield segment()
                    names, counts, ids = [], [], []
                    seq, at, held = seq + 1, at + held, 0
        if held:
            yield segment()

    order = [F.col(id), F.xxhash64(text)]
    rows = docs.select(id, text).repartitionByRange(*order).sortWithinPartitions(*order, text)
    segments = rows.mapInArrow(run, f"part int, seq int, at long, n_tokens long, ids array<{kind}>, counts array<long>, {LEVELS}")
    segments.write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``: tokens of the whole collection before each."""
    segments = spark.read.parquet(path)
    # One row per part: the window and the broadcast are bounded by the writer's task count.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("__n")).select(
        "part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return segments.join(F.broadcast(parts), "part").withColumn("start", F.col("__before") + F.col("at")).drop("__before")


def read_documents(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each written document, from the files."""
    segments = read_segments(spark, path)
    kind = segments.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                counts = np.array(row.column("counts")[0].as_py(), np.int64)
                held = from_levels(row.column("levels")[0].as_py()).astype("<u4").tobytes()
                places = np.concatenate([[0], np.cumsum(counts)])
                sums = [zlib.crc32(held[4 * a : 4 * b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [row.column("ids")[0].values, pa.array(row.column("start")[0].as_py() + places[:-1]), pa.array(counts), pa.array(sums, pa.int64())],
                    [id, "start", "n_tokens", "ids_crc32"],
                )

    wanted = segments.select("start", "ids", "counts", "levels")
    return wanted.mapInArrow(run, f"{id} {kind}, start long, n_tokens long, ids_crc32 long")


def tokens_at(spark: SparkSession, path: str, wanted: DataFrame, position: str = "position") -> DataFrame:
    """``position, token_id`` for places of the whole collection; places outside it give no row.

    Places meet segments by blocks of ``SEGMENT`` places, then each token is
    read alone through the levels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [id_at(row["levels"], row["__place"]) for row in batch.select(["levels", "__place"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(position), pa.array(found, pa.int64())], [position, "token_id"])

    segments = read_segments(spark, path).select("start", "n_tokens", "levels")
    last = F.col("start") + F.col("n_tokens") - 1
    blocks = segments.withColumn("__block", F.explode(F.sequence(F.expr(f"start div {SEGMENT}"), F.floor(last / SEGMENT))))
    asked = wanted.select(F.col(position).cast("long").alias(position)).withColumn("__block", F.expr(f"{position} div {SEGMENT}"))
    met = asked.join(blocks, "__block").filter((F.col(position) >= F.col("start")) & (F.col(position) <= last))
    return met.select(position, "levels", (F.col(position) - F.col("start")).alias("__place")).mapInArrow(run, f"{position} long, token_id long")
