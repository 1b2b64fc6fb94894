"""Quality of texts by regularised quadratic discriminant analysis.

Document statistics are transformed so that each class is near to a normal
distribution; a class has its mean and its covariance, shrunk to the diagonal,
as a Cholesky factor.  The score is the posterior from the difference of the
two log densities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import SPACE, flat, running, steps, word_hashes, words, mixed
from tessera.runtime import cut

FEATURES = (
    "words", "word_length", "spread", "symbols", "marks", "capitals", "shouted", "bars", "digits",
    "odd_ends", "repeated", "distinct", "lines", "equal_lines", "not_ascii",
)

_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = _LOWER[97:123] = _DIGIT[48:58] = True
_SYMBOL[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~[]"]] = True
_MARK[[ord(c) for c in "!?"]] = True
_PLAIN_END = _UPPER | _LOWER | _DIGIT
_PLAIN_END[[ord(c) for c in ".,;:?)\"'"]] = True
_PLAIN_END[128:] = True


def part(id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(of)), F.lit(0))


def statistics(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The transformed statistics of texts, a row for each."""
    starts, ends, before = words(data, places)
    n_bytes, n_words = np.diff(places), np.diff(before)
    owner = np.repeat(np.arange(len(n_bytes)), n_words)

    def bytes_in(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[places[1:]] - total[places[:-1]]

    def words_in(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, len(n_bytes))

    # A few more in the denominator keep very short texts near the others.
    share = lambda count, of: np.arcsin(np.sqrt(np.clip(count / (of + 6), 0, 1)))
    upper = _UPPER[data]
    capitals = np.concatenate([[0], np.cumsum(upper, dtype=np.int64)])
    sizes = ends - starts
    hashes = word_hashes(data, starts, ends)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct = _distinct(owner, hashes, len(n_bytes))

    line = data == 10
    edge = np.concatenate([np.flatnonzero(line), places[1:]])
    edge.sort()
    begins = np.concatenate([[0], edge[:-1]])
    begins = np.where(line[np.minimum(begins, max(len(data) - 1, 0))] & (begins < edge), begins + 1, begins) if len(data) else begins
    some = np.flatnonzero(edge > begins)
    sums, down = running(data)
    whole = mixed((sums[edge[some]] - sums[begins[some]]) * down[begins[some]])
    of_line = np.searchsorted(places, begins[some], "right") - 1
    n_lines = np.bincount(of_line, minlength=len(n_bytes))

    length = words_in(sizes) / np.maximum(n_words, 1)
    square = words_in(sizes.astype(float) ** 2) / np.maximum(n_words, 1)
    letters = bytes_in(upper | _LOWER[data])
    solid = n_bytes - bytes_in(SPACE[data])
    return np.stack(
        [
            np.log1p(n_words),
            np.log1p(length),
            np.log1p(np.sqrt(np.maximum(square - length**2, 0))),
            share(bytes_in(_SYMBOL[data]), solid),
            share(bytes_in(_MARK[data]), solid),
            share(capitals[places[1:]] - capitals[places[:-1]], letters),
            share(words_in((capitals[ends] - capitals[starts]) * 2 > sizes), n_words),
            share(bytes_in(data == 124), n_words),
            share(bytes_in(_DIGIT[data]), solid),
            share(words_in(~_PLAIN_END[data[ends - 1]]), n_words),
            share(words_in(same), n_words),
            np.log1p(distinct) / np.log1p(np.maximum(n_words, 1)),
            np.log1p(n_words / np.maximum(n_lines, 1)),
            share(n_lines - _distinct(of_line, whole, len(n_bytes)), n_lines),
            share(bytes_in(data > 127), solid),
        ],
        axis=1,
    )


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """The number of distinct hashes of each owner."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return np.bincount(owner[new], minlength=n)


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of the two classes, and the constant of their log ratio."""

    means: np.ndarray
    factors: np.ndarray
    constant: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The posterior of class 1."""
        away = [(((x - m) @ f.T) ** 2).sum(1) for m, f in zip(self.means, self.factors)]
        return 1 / (1 + np.exp(-np.clip(self.constant + (away[0] - away[1]) / 2, -700, 700)))


def fit(counts: list[int], sums: np.ndarray, squares: np.ndarray, shrink: float, ridge: float) -> Discriminant | None:
    """The discriminant from each class's count, sums and sums of products; None without rows of both."""
    if min(counts) == 0:
        return None
    means, factors, logs = [], [], []
    for n, s, q in zip(counts, sums, squares):
        mean = s / n
        cov = q / n - np.outer(mean, mean)
        cov = (1 - shrink) * cov + shrink * np.diag(np.diag(cov)) + ridge * np.eye(len(mean))
        root = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(root))
        logs.append(np.log(np.diag(root)).sum())
    return Discriminant(np.array(means), np.array(factors), float(np.log(counts[1] / counts[0]) + logs[0] - logs[1]))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    parts: int = 5,
    threshold: float = 0.3,
    shrink: float = 0.1,
    ridge: float = 1e-3,
) -> DataFrame:
    """``id, held_out, score, predicted`` of each row's whole text.

    Statistics are taken in one pass over the texts and written; classes are
    fitted from sums over all labelled rows whose ``part`` is not 0, so what
    comes to the driver has a fixed size.  Labels meet statistics, not texts.

    A null text counts as empty and has a score like any other.  Labels other
    than 0 and 1 are not used; a label that is repeated counts as often.  If
    the rows to learn from are not of both classes, the score is the share of
    class 1 (0.5 without any).  A null id is held out.
    """
    kind = docs.schema[id].dataType.simpleString()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            x = statistics(*flat(batch.column(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES), x.ravel())], ["__id", "__x"]
            )

    rows = cut(docs.select(id, text).mapInArrow(take, f"__id {kind}, __x array<double>"))
    taught = labels.select(F.col(id).alias("__id"), F.col(label).alias("__y")).filter("__y in (0, 1)").filter(part(F.col("__id"), parts) != 0)
    d = range(len(FEATURES))
    x = [F.col("__x")[i] for i in d]
    pairs = [(i, j) for i in d for j in d if i <= j]
    moments = rows.join(taught, "__id").groupBy("__y").agg(
        F.count("*").alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"), F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("q")
    )
    found = {r["__y"]: r for r in moments.collect()}
    counts = [found[y]["n"] if y in found else 0 for y in (0, 1)]
    sums = np.array([found[y]["s"] if y in found else [0.0] * len(d) for y in (0, 1)])
    squares = np.zeros((2, len(d), len(d)))
    for y in found:
        for (i, j), v in zip(pairs, found[y]["q"]):
            squares[y, i, j] = squares[y, j, i] = v
    model = fit(counts, sums, squares, shrink, ridge)
    share = counts[1] / sum(counts) if sum(counts) else 0.5

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("__x").flatten().to_numpy().reshape(-1, len(FEATURES))
            y = model.score(x) if model else np.full(len(x), share)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(y)], [id, "score"])

    scored = rows.mapInArrow(score, f"`{id}` {kind}, score double")
    return scored.select(id, (part(F.col(id), parts) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
