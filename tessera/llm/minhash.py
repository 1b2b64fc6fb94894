"""Near duplicates by MinHash, with sequential Bayesian verification.

Bands of minima propose pairs.  Their signatures are compared in batches: after
each batch the posterior of the similarity (a uniform prior, each further
minimum equal with the similarity's probability) says how likely the pair still
reaches the threshold, and pairs below the chosen miss probability are dropped.
Survivors are verified on their whole sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import mixed, steps
from tessera.llm.verified import Once, class_of, links, set_name, shingle_sets
from tessera.runtime import cut

#: Bands, minima of each, and minima of a batch of verification.
BANDS, ROWS, BATCH = 32, 5, 32
#: Shingles whose minima are taken at a time.
SHINGLES = 1 << 18


@cache
def _factors() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.default_rng(20240911).integers(1, 2**32, (2, BANDS * ROWS), dtype=np.uint32)
    return numbers[0] | np.uint32(1), numbers[1]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of each set under ``BANDS * ROWS`` permutations of 32-bit numbers (an empty set: all ones)."""
    times, plus = _factors()
    sizes = np.array([len(x) for x in sets], np.int64)
    found = np.full((len(sets), len(times)), np.iinfo(np.uint32).max, np.uint32)
    some = np.flatnonzero(sizes)
    if not len(some):
        return found
    ends = np.cumsum(sizes[some])
    numbers = (mixed(np.concatenate([sets[i] for i in some.tolist()])) >> np.uint64(32)).astype(np.uint32)
    # Runs of whole sets of about SHINGLES members; a larger set is a run of its own.
    run = (ends - 1) // SHINGLES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(some)]
    for i, j in zip(cuts[:-1], cuts[1:]):
        low = ends[i - 1] if i else 0
        own, heads = numbers[low : ends[j - 1]], np.concatenate([[0], ends[i : j - 1] - low])
        for k in range(len(times)):
            found[some[i:j], k] = np.minimum.reduceat(own * times[k] + plus[k], heads)
    return found


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each signature."""
    bands = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(minima), BANDS))
    for k in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
    return keys


def least_matches(similarity: float, miss: float, total: int = BANDS * ROWS, batch: int = BATCH, extra: float = 1 / 256) -> list[tuple[int, int]]:
    """``(compared, least)`` after each batch: with fewer matches the similarity is reached with a probability below ``miss``.

    Minima are compared by one byte, so unlike ones match with the probability
    ``extra``; the threshold is that of matches.  The posterior's tail is that
    of a beta distribution with whole parameters, a binomial sum.
    """
    matched = similarity + (1 - similarity) * extra

    def reached(matches: int, n: int) -> float:
        """The probability that the similarity is at least the threshold after ``matches`` of ``n``."""
        return sum(comb(n + 1, j) * matched**j * (1 - matched) ** (n + 1 - j) for j in range(matches + 1))

    return [(n, next(m for m in range(n + 1) if reached(m, n) >= miss)) for n in range(batch, total + 1, batch)]


def _equal_bands(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each row the bands whose minima are the same in both sketches; what follows the minima does not count."""
    return (others[..., : BANDS * ROWS] == one[..., : BANDS * ROWS]).reshape(-1, BANDS, ROWS).all(2)


class FirstBand(Once):
    """A pair is compared where the first band that it shares is the key's."""

    def prepare(self, sketch: np.ndarray) -> np.ndarray:
        """The bands that all rows of the tile share; the key's own is one of them."""
        bands = sketch[:, : BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
        return (bands == bands[0]).all(2).all(0)

    def here(self, one: np.ndarray, others: np.ndarray, about: np.ndarray) -> np.ndarray:
        same = _equal_bands(one, others)
        # Rows may also meet under keys that are no bands.
        return about[same.argmax(1)] | ~same.any(1)


SKETCHED = "name binary, n long, sketch binary, keys array<long>"


def sketched(texts: pa.Array, width: int) -> list[pa.Array]:
    """The columns of ``SKETCHED`` of texts: names of their sets, sizes, minima by one byte each, and keys of the bands."""
    sets = shingle_sets(texts, width)
    minima = signatures(sets)
    keys = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * BANDS, band_keys(minima).view(np.int64).ravel())
    sketches = minima.astype(np.uint8)
    return [pa.array([set_name(x) for x in sets], pa.binary()), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sketches], pa.binary()), keys]


def set_links(
    texts: DataFrame, sets: DataFrame, keys: Column, words_each: int, percent: int, miss: float,
    close: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``src, dst``: verified links that connect ``sets (own, least, name, n, sketch)`` which meet under ``keys``.

    ``texts (id, text)`` has a row with the id ``least`` that has the set.
    With ``close``, keys may be others than those of bands; rows that share
    no band are candidates only if it says so of what follows their minima.
    """
    bounds = least_matches(percent / 100, miss)

    def test(na: np.ndarray, nb: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good = 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)
        if close is not None:
            some = np.flatnonzero(good)
            good[some] = close(a[some, BANDS * ROWS :], b[some, BANDS * ROWS :]) | _equal_bands(a[some], b[some]).any(1)
        left, matches, before = np.flatnonzero(good), np.zeros(len(good), np.int64), 0
        for compared, least in bounds:
            matches[left] += (a[left, before:compared] == b[left, before:compared]).sum(1)
            left, before = left[matches[left] >= least], compared
        good[:] = False
        good[left] = True
        return good

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            own = shingle_sets(batch.column("text"), words_each)
            yield pa.RecordBatch.from_arrays([pa.array([set_name(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], ["name", "members"])

    def load(owns: DataFrame) -> DataFrame:
        """Whole sets, from one row each that has the set."""
        asked = cut(sets.join(owns, "own").select("own", "name", "least"))
        ids = asked.select(F.col("least").alias("one")).distinct()
        some = texts.join(ids, F.col("id").eqNullSafe(F.col("one")), "left_semi").select("text")
        return some.mapInArrow(whole, "name binary, members binary").join(asked.select("own", "name"), "name").dropDuplicates(["own"]).select("own", "members")

    keyed = sets.filter("n > 0").select(F.explode(keys).alias("key"), "own", "n")
    return links(sets, keyed, load, test, lambda x, y, both: 100 * both >= percent * (x + y - both), percent / 100, FirstBand())


def distinct_sets(rows: DataFrame, *more: str) -> DataFrame:
    """A row for each set of ``rows``: its number ``own``, its smallest id ``least``, and its sketch."""
    held = [F.first(c).alias(c) for c in ("n", "sketch", "keys", *more)]
    return cut(rows.groupBy("name").agg(F.min("row").alias("own"), F.min("id").alias("least"), *held))


def minhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 85, miss: float = 1e-9
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of each row.

    A text's set has its shingles of ``words_each`` words (ASCII letters
    lowered); fewer words are one shingle.  Sets link if 100 times their
    intersection is at least ``percent`` times their union, counted on whole
    sets; ``component_id`` is the smallest id that links reach, and ``kept``
    says whether that is the row's own.  Two sets at the threshold share no
    band with a probability of 7e-9 for 85 percent, and are refused by their
    signatures with about ``miss`` for each batch.

    Null and empty texts and texts without words have empty sets, which link
    with nothing.  A row without an id takes part with its set; its
    ``component_id`` is null where no row of the class has an id, and it is
    ``kept`` only then.  Rows of one id are rows of their own; equal ones have
    equal results.  One row per input row.
    """
    kind = docs.schema[id].dataType.simpleString()
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), *sketched(batch.column("text"), words_each)], ["id", "row", "name", "n", "sketch", "keys"])

    rows = cut(texts.select("id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(describe, f"id {kind}, row long, {SKETCHED}"))
    sets = distinct_sets(rows.filter("n > 0"))
    classes = class_of(sets, set_links(texts, sets, F.col("keys"), words_each, percent, miss))
    found = rows.select("id", "name", "n").join(classes, "name", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return found.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept")
    )
