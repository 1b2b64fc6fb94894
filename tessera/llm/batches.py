"""Texts of Arrow batches as flat arrays: bytes, words, pieces and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that one step of a batch function looks at; a single longer text is a step of its own.
STEP_BYTES = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: One random number for each byte, and the odd base of the running byte hash (counts letters' runs; it tells no words apart).
_NUMBERS = np.random.default_rng(20240607).integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

#: Two odd factors and a seed for each of the two word hashes.
_MIXERS = np.random.default_rng(20241130).integers(1, 2**63, (2, 3), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Masks of the first k of eight bytes, and the bytes of a word that numpy hashes.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
LONG = 64


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``, so that memory does not follow the row count."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(start, end - start)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of ``texts`` (null: empty) in one array, and the n + 1 places where texts begin."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[places[0] : places[-1]] if held is not None and held.size else np.zeros(0, np.uint8)
    return data, places - places[0]


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The pieces ``data[start:end]`` as a binary array; pieces that adjoin are not copied."""
    if len(starts) and not np.array_equal(starts[1:], ends[:-1]):
        sizes = ends - starts
        places = np.concatenate([[0], np.cumsum(sizes)])
        data = data[np.repeat(starts - places[:-1], sizes) + np.arange(places[-1])]
    else:
        places = np.append(starts, ends[-1:] if len(ends) else [0])
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.ascontiguousarray(places, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def words(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, and the number of runs before each text (n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(places), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, places)


def pieces(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces of texts that byte-level tokenizers treat alone, and the number of pieces before each text.

    Such a tokenizer's pattern takes white space only at the beginning of a
    match, so none crosses from a character that is no white space to ASCII
    white space.  Other white space before such a place is no safe boundary.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(places), np.int64)
    space = SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    before = [data[np.maximum(at - k, 0)] for k in (1, 2, 3)]
    odd = (before[0] >= 0x1C) & (before[0] <= 0x1F)
    odd |= (before[1] == 0xC2) & ((before[0] == 0x85) | (before[0] == 0xA0))
    odd |= (before[2] >= 0xE1) & (before[2] <= 0xE3) & np.isin(before[1], (0x80, 0x81, 0x9A, 0xA0))
    first = np.zeros(len(data) + 1, bool)
    first[at[~odd]] = True
    first[places[:-1]] = True
    starts = np.flatnonzero(first[:-1])
    return starts, np.searchsorted(starts, places)


_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(which: int, sign: int, n: int) -> np.ndarray:
    """The first ``n`` powers of a base (sign 1) or of its inverse (-1); kept, as every step needs them."""
    kept = _POWERS.get((which, sign))
    if kept is None or len(kept) < n:
        kept = np.full(max(n, STEP_BYTES // 2), pow(_BASES[which], sign, 2**64), np.uint64)
        kept[0] = 1
        np.multiply.accumulate(kept, out=kept)
        if n <= 2 * STEP_BYTES:
            _POWERS[which, sign] = kept
    return kept[:n]


def running(data: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the byte hash over prefixes (n + 1), and the factor that moves a place to 0."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_NUMBERS[which][data] * _powers(which, 1, n), out=sums[1:])
    return sums, _powers(which, -1, n + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word; ``which`` picks one of two hashes without a common structure.

    Eight bytes are taken in at a time, each between two mixings of all bits,
    so that no sum of powers can cancel; words of up to eight bytes and one
    length never collide.  The rest of a word of over ``LONG`` bytes is
    hashed by XXH64.
    """
    odd, more, seed = _MIXERS[which]
    sizes = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    # The eight bytes from every place on.
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    found = mixed(sizes.astype(np.uint64) * odd + seed)
    found = mixed(found ^ (eight[starts] & _FIRST[np.minimum(sizes, 8)]) * odd)
    at, left = 8, np.flatnonzero(sizes > 8)
    while len(left) and at < LONG:
        rest = sizes[left] - at
        found[left] = mixed(found[left] * more ^ (eight[starts[left] + at] & _FIRST[np.minimum(rest, 8)]) * odd)
        at, left = at + 8, left[rest > 8]
    for i in left.tolist():
        found[i] = mixed(found[i : i + 1] * more ^ np.uint64(xxhash.xxh64_intdigest(data[starts[i] + at : ends[i]].tobytes(), int(seed))))[0]
    return found


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` neighbouring word hashes (``len - width + 1`` of them)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total *= np.uint64(0xC6BC279692B5CC83)
        total += hashes[k : k + n]
    return mixed(total)


class Memo:
    """Results of the most recent keys, two generations of at most ``limit`` units of size each."""

    def __init__(self, make: Callable[[list], list], limit: int, size: Callable[[object], int] = lambda x: 1):
        self.make, self.limit, self.size = make, limit, size
        self.new: dict = {}
        self.old: dict = {}
        self.held = 0

    def __call__(self, keys: list) -> list:
        """The result of each key; ``make`` gets the keys that are not known."""
        new, old = self.new, self.old
        found = list(map(new.get, keys))
        missing = [i for i, x in enumerate(found) if x is None]
        unknown = []
        for i in missing:
            x = found[i] = old.get(keys[i])
            if x is None:
                unknown.append(i)
        if unknown:
            for i, x in zip(unknown, self.make([keys[i] for i in unknown]), strict=True):
                found[i] = x
        if self.held > self.limit:
            self.new, self.old, self.held = {}, new, 0
            new = self.new
        for i in missing:
            new[keys[i]] = found[i]
            self.held += self.size(found[i])
        return found
