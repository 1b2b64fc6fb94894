"""Language of texts by a bidirectional gated recurrent network over bytes.

A word's bytes are read from both ends; each position gets a distribution over
the languages, and a text pools the log probabilities of all its positions.
Words are read alone, so each distinct word of a step is read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.batches import LOWER, Memo, flat, slices, steps, words

#: Units of each direction; bytes that are read at once, longer words are cut.
UNITS, LONGEST = 16, 24
#: Words a worker keeps the result of, twice.
KEPT = 300_000
#: Positions whose log probabilities count as one when they are pooled to a score.
POOLED = 8.0
#: Texts of a step, in bytes.
STEP_BYTES = 4 << 20


def part(id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(of)), F.lit(0))


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words (A-Z lowered) in stretches of at most ``LONGEST`` bytes, and the number of them before each text."""
    data, places = flat(texts)
    data = LOWER[data]
    starts, ends, before = words(data, places)
    if not len(starts):
        return pa.array([], pa.large_binary()), before
    n = -(-(ends - starts) // LONGEST)
    at = np.concatenate([[0], np.cumsum(n)])
    own = np.repeat(np.arange(len(starts)), n)
    begin = starts[own] + (np.arange(at[-1]) - at[own]) * LONGEST
    return slices(data, begin, np.minimum(begin + LONGEST, ends[own])), at[before]


class Network:
    """Weights of two gated recurrent layers, one for each direction, and of the labels of positions."""

    def __init__(self, labels: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        h = UNITS
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
            self.w["u" + d] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32)
            self.w["c" + d] = np.zeros(3 * h, np.float32)
        self.w["v"] = rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, labels)).astype(np.float32)
        self.w["a"] = np.zeros(labels, np.float32)

    def layer(self, x: np.ndarray, d: str, keep: list | None = None) -> list[np.ndarray]:
        """States after each byte of ``x`` (words by bytes), in the order of reading."""
        table, u, h = self.w["x" + d] + self.w["c" + d], self.w["u" + d], UNITS
        state = np.zeros((len(x), h), np.float32)
        states = []
        for t in range(x.shape[1]):
            own = table[x[:, t]]
            gates = own[:, : 2 * h] + state @ u[:, : 2 * h]
            gates = 0.5 * np.tanh(0.5 * gates) + 0.5
            update, reset = gates[:, :h], gates[:, h:]
            back = state @ u[:, 2 * h :]
            new = np.tanh(own[:, 2 * h :] + reset * back)
            if keep is not None:
                keep.append((state, update, reset, back, new))
            state = new + update * (state - new)
            states.append(state)
        return states

    def log_labels(self, x: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Log probabilities, words by bytes by labels."""
        kept = {d: [] for d in "fb"} if keep is not None else {"f": None, "b": None}
        f = self.layer(x, "f", kept["f"])
        b = self.layer(x[:, ::-1], "b", kept["b"])[::-1]
        both = np.concatenate([np.stack(f, 1), np.stack(b, 1)], axis=2)
        s = both @ self.w["v"] + self.w["a"]
        s -= s.max(2, keepdims=True)
        s -= np.log(np.exp(s).sum(2, keepdims=True))
        if keep is not None:
            keep.update(kept, both=both)
        return s

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy of all positions, by backpropagation through time."""
        kept: dict = {}
        p = np.exp(self.log_labels(x, kept))
        n, length, _ = p.shape
        p[np.arange(n)[:, None], np.arange(length)[None], y[:, None]] -= 1
        p /= n * length
        h = UNITS
        flat_p, both = p.reshape(n * length, -1), kept["both"].reshape(n * length, -1)
        found = {"v": both.T @ flat_p, "a": flat_p.sum(0)}
        into = (flat_p @ self.w["v"].T).reshape(n, length, 2 * h)
        for d, part_, order in (("f", into[:, :, :h], range(length - 1, -1, -1)), ("b", into[:, ::-1, h:], range(length - 1, -1, -1))):
            read = x if d == "f" else x[:, ::-1]
            u = self.w["u" + d]
            du, dx, dc = np.zeros_like(u), np.zeros_like(self.w["x" + d]), np.zeros(3 * h, np.float32)
            carry = np.zeros((n, h), np.float32)
            for t in order:
                state, update, reset, back, new = kept[d][t]
                dh = carry + part_[:, t]
                d_new = dh * (1 - update) * (1 - new * new)
                d_gate = np.concatenate([dh * (state - new) * update * (1 - update), d_new * back * reset * (1 - reset)], axis=1)
                d_back = d_new * reset
                whole = np.concatenate([d_gate, d_new], axis=1)
                du[:, : 2 * h] += state.T @ d_gate
                du[:, 2 * h :] += state.T @ d_back
                one = np.zeros((n, 256), np.float32)
                one[np.arange(n), read[:, t]] = 1
                dx += one.T @ whole
                dc += whole.sum(0)
                carry = dh * update + d_gate @ u[:, : 2 * h].T + d_back @ u[:, 2 * h :].T
            found |= {"u" + d: du, "x" + d: dx, "c" + d: dc}
        return found

    def train(self, held: list[bytes], labels: np.ndarray, weights: np.ndarray, updates: int, size: int = 256, rate: float = 0.01, seed: int = 5) -> None:
        """Adam over words drawn by weight; a batch has words of one length."""
        rng = np.random.default_rng(seed)
        lengths = np.array([len(w) for w in held])
        groups = []
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            x = np.frombuffer(b"".join([held[i] for i in which]), np.uint8).reshape(-1, n)
            groups.append((x, labels[which], np.cumsum(weights[which]) / weights[which].sum(), weights[which].sum()))
        chance = np.array([g[3] for g in groups]) / weights.sum()
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, updates + 1):
            x, y, chances, _ = groups[rng.choice(len(groups), p=chance)]
            some = np.minimum(np.searchsorted(chances, rng.random(size)), len(x) - 1)
            now = rate * (1 - 0.9 * step / updates)
            for k, g in self.gradients(x[some], y[some]).items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.w[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)

    def pooled(self, held: list[bytes]) -> list[np.ndarray]:
        """Of each word, the sum of its positions' log probabilities."""
        found: list[np.ndarray] = [np.zeros(0)] * len(held)
        lengths = np.array([len(w) for w in held])
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            for start in range(0, len(which), 2048):
                some = which[start : start + 2048].tolist()
                x = np.frombuffer(b"".join([held[i] for i in some]), np.uint8).reshape(-1, n)
                sums = self.log_labels(x).sum(1).astype(np.float32)
                for i, row in zip(some, sums):
                    found[i] = row
        return found


def teach(docs: DataFrame, id: str, text: str, lang: str, texts_each: int, words_each: int, updates: int) -> tuple[list[str], Network | None]:
    """The languages and the network, from at most ``texts_each`` texts and ``words_each`` distinct words of each language.

    Texts are those of the smallest hash of their id, words those of the
    smallest hash of their own, so the sample is the same each time; the
    driver gets words of at most ``LONGEST`` bytes.
    """
    by = [F.xxhash64(id), F.col(id)]
    ranked = docs.select(id, lang).withColumn("__n", F.row_number().over(Window.partitionBy(lang).orderBy(*by)))
    # At most texts_each rows for each language.
    chosen = F.broadcast(ranked.filter(F.col("__n") <= texts_each).select(F.col(id).alias("__id")).distinct())
    sample = docs.join(chosen, F.col(id) == F.col("__id"), "left_semi").select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            held, before = cut_words(batch.column("text"))
            own = np.repeat(np.arange(batch.num_rows), np.diff(before))
            yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(own)), held.cast(pa.binary())], ["lang", "word"])

    counted = sample.mapInArrow(take, "lang string, word binary").groupBy("lang", "word").agg(F.count("*").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word")
    rows = counted.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") <= words_each).select("lang", "word", "n").collect()
    rows.sort(key=lambda r: (r["lang"], r["word"]))
    languages = sorted({r["lang"] for r in rows})
    if len(languages) < 2:
        return languages, None
    labels = np.array([languages.index(r["lang"]) for r in rows])
    weights = np.sqrt(np.array([r["n"] for r in rows], float))
    weights /= np.bincount(labels, weights)[labels]  # languages weigh the same
    network = Network(len(languages))
    network.train([bytes(r["word"]) for r in rows], labels, weights, updates)
    return languages, network


def languages(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 4, left: int = 2,
    texts_each: int = 400, words_each: int = 20_000, updates: int = 400,
) -> DataFrame:
    """``id, held_out, lang_pred, score`` of each row's whole text.

    Learns from rows with a text and a language whose ``part`` is not
    ``left`` (see ``teach`` for the sample's bounds).  ``score`` is the
    predicted language's share of the pooled probabilities.

    A text that is null or has no letter is ``und`` with score 0, and so is
    every text if there is nothing to learn from; with one language to learn,
    all others are that one with score 1.  A null id is not held out.  One row
    per input row.
    """
    kind = docs.schema[id].dataType.simpleString()
    taught = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & (part(F.col(id), parts) != left))
    names, network = teach(taught, id, text, lang, texts_each, words_each, updates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = Memo(network.pooled, KEPT) if network else None
        labels = np.array(names, object)
        for batch in steps(batches, text, STEP_BYTES):
            texts = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
            known = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
            if not names:
                known[:] = False
            best, score = np.zeros(len(known), np.int64), np.ones(len(known))
            if kept:
                held, before = cut_words(texts)
                coded = held.dictionary_encode()
                each = np.array(kept(coded.dictionary.to_pylist()), np.float64).reshape(-1, len(names))
                sums = np.zeros((len(held) + 1, len(names)))
                np.cumsum(each[coded.indices.to_numpy()], axis=0, out=sums[1:])
                pooled = (sums[before[1:]] - sums[before[:-1]]) / POOLED
                pooled -= pooled.max(1, keepdims=True)
                shares = np.exp(pooled)
                shares /= shares.sum(1, keepdims=True)
                best = shares.argmax(1)
                score = shares[np.arange(len(best)), best]
            pred = np.where(known, labels[best] if names else "und", "und")
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(pred.tolist(), pa.string()), pa.array(np.where(known, score, 0.0))], [id, "lang_pred", "score"])

    found = docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, lang_pred string, score double")
    return found.select(id, (part(F.col(id), parts) == left).alias("held_out"), "lang_pred", "score")
