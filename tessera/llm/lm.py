"""Log probability of texts: unigrams, and a hashed maximum-entropy model.

The model's softmax has two factors.  The class of the next token (the end,
one of the most frequent words, or a class of word endings) comes from a
maximum-entropy model with hashed features of the words before it: the last
word, the last two, and the second and third last alone.  A word's share of
its class comes from the counts of the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm.batches import LOWER, flat, mixed, steps, word_hashes, words
from tessera.runtime import cut

#: Classes: the end, frequent words, and endings.
FREQUENT, ENDINGS = 31, 32
CLASSES = 1 + FREQUENT + ENDINGS
#: Features of a token, and hash buckets of each.
FEATURES, BUCKETS = 4, 1 << 12
#: Tokens of one gradient update, and its rate.
UPDATE, RATE = 4096, 0.3
#: Tokens of an update that share a row and are summed beside those of other rows.
RUN = 12
#: Bytes of text of a block of documents, of a step, and for which there is a bucket of words.
BLOCK_BYTES, STEP_BYTES, BUCKET_BYTES = 6 << 20, 4 << 20, 16 << 20
#: Bytes of text from which one learner makes its updates, in a row.
LEARNER_BYTES = 16 << 20

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True
_COUNTED = "bucket long, words binary, counts binary, endings binary"
_ASKED = "bucket long, block long, words binary"
_ANSWERED = "block long, bucket long, counts binary"


def part(id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; 0 for a null id."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(of)), F.lit(0))


def read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (A-Z lowered), their endings' class, and the number of words before each text."""
    data, places = flat(texts)
    data = LOWER[data]
    starts, ends, before = words(data, places)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8), before
    # The last two bytes but for punctuation behind them.
    last = ends - 1
    for _ in range(2):
        last = np.where(~_LETTER[data[last]] & (last > starts), last - 1, last)
    pair = data[last].astype(np.uint64) << np.uint64(8) | np.where(last > starts, data[last - 1], 0).astype(np.uint64)
    return word_hashes(data, starts, ends), (mixed(pair) % np.uint64(ENDINGS)).astype(np.uint8), before


def parts(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """``(bucket, start, end)`` of the buckets that sorted hashes meet."""
    if not len(hashes):
        return []
    of = hashes // np.uint64(-(-(2**64) // buckets)) if buckets > 1 else np.zeros(len(hashes), np.uint64)
    heads = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
    return list(zip(of[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(hashes)]))


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a bucket's rows, their counts summed, and their endings' classes."""
    own = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["words"]])
    counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in table["counts"]])
    endings = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table["endings"]])
    order = np.argsort(own, kind="stable")
    own = own[order]
    heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    return own[heads], np.add.reduceat(counts[order], heads), endings[order][heads]


@dataclass
class Model:
    """What a corpus has taught: counts, classes and weights."""

    total: int  # tokens, ends too
    distinct: int
    ends: int
    frequent: np.ndarray  # hashes, sorted
    frequent_class: np.ndarray
    mass: np.ndarray  # of each class: its counts, each distinct token and one unknown with 0.1 more
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES * BUCKETS, CLASSES), np.float32))

    def __post_init__(self) -> None:
        self.bias = np.log(self.mass / self.mass.sum()).astype(np.float32)

    def classes(self, hashes: np.ndarray, endings: np.ndarray) -> np.ndarray:
        found = 1 + FREQUENT + endings.astype(np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            found = np.where(self.frequent[at] == hashes, self.frequent_class[at], found)
        return found

    def examples(self, hashes: np.ndarray, endings: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens, ends too: hash (of an end: 0), class, features; and the number of tokens before each text."""
        n = len(before) - 1
        at = before + np.arange(n + 1)
        token = np.zeros(at[-1], np.uint64)
        kind = np.zeros(at[-1], np.int64)
        inside = np.ones(at[-1], bool)
        inside[at[1:] - 1] = False
        token[inside] = hashes
        kind[inside] = self.classes(hashes, endings)
        place = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
        back = [np.where(place >= k, np.roll(token, k), np.uint64(k)) for k in (1, 2, 3)]
        seeds = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
        made = [back[0] * seeds[0], back[1] * seeds[1], back[0] * seeds[2] + mixed(back[1]), back[2] * seeds[3]]
        features = np.stack([(mixed(x) % np.uint64(BUCKETS)).astype(np.int32) + k * BUCKETS for k, x in enumerate(made)], axis=1)
        return token, kind, features, at

    def logits(self, features: np.ndarray, into: np.ndarray | None = None, room: np.ndarray | None = None) -> np.ndarray:
        """Unnormalised log probabilities of the classes, the largest 0; written to ``into``, with ``room`` of the same shape."""
        into = np.empty((len(features), CLASSES), np.float32) if into is None else into
        room = np.empty_like(into) if room is None else room
        s = np.take(self.weights, features[:, 0], axis=0, out=into, mode="clip")
        for k in range(1, FEATURES):
            s += np.take(self.weights, features[:, k], axis=0, out=room, mode="clip")
        s += self.bias
        s -= s.max(1, keepdims=True)
        return s

    def learn(self, kind: np.ndarray, features: np.ndarray, squares: np.ndarray, seen: np.ndarray) -> None:
        """Gradient updates in the order of the tokens; ``squares`` has the sums of squared gradients.

        The gradients of an update's rows are summed for all rows at once: the
        first token of each, then the second of those that have one, and so
        on; the few rows that more than ``RUN`` tokens share, row by row.
        """
        room = np.empty((3, FEATURES * UPDATE, CLASSES), np.float32)
        for i in range(0, len(kind), UPDATE):
            own = features[i : i + UPDATE]
            n = len(own)
            p = self.logits(own, room[0, :n], room[1, :n])
            np.exp(p, out=p)
            p /= p.sum(1, keepdims=True)
            p[np.arange(n), kind[i : i + UPDATE]] -= 1
            column = own.T.ravel().astype(np.uint16)
            order = np.argsort(column, kind="stable")
            column, token = column[order], order % n
            heads = np.flatnonzero(np.diff(column, prepend=-1))
            counts = np.diff(np.append(heads, len(column)))
            most_first = np.argsort((n - counts).astype(np.uint16), kind="stable")
            heads, counts = heads[most_first], counts[most_first]
            rows = column[heads].astype(np.int64)
            step = np.take(p, token[heads], axis=0, out=room[1, : len(rows)], mode="clip")
            more = np.searchsorted(-counts, -np.arange(1, RUN + 1))
            for k in range(1, RUN):
                m = more[k - 1]
                step[:m] += np.take(p, token[heads[:m] + k], axis=0, out=room[2, :m], mode="clip")
            for g in range(more[RUN - 1]):
                step[g] += p[token[heads[g] + RUN : heads[g] + counts[g]]].sum(0)
            sums = np.take(squares, rows, axis=0, out=room[2, : len(rows)], mode="clip")
            sums += np.square(step, out=room[0, : len(rows)])
            squares[rows] = sums
            sums += 1
            np.sqrt(sums, out=sums)
            step *= RATE
            step /= sums
            moved = np.take(self.weights, rows, axis=0, out=room[0, : len(rows)], mode="clip")
            moved -= step
            self.weights[rows] = moved
            seen[rows] += counts

    def log_class(self, kind: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural log probability of each token's class."""
        found = np.empty(len(kind))
        room = np.empty((2, UPDATE, CLASSES), np.float32)
        for i in range(0, len(kind), UPDATE):
            own = features[i : i + UPDATE]
            s = self.logits(own, *room[:, : len(own)])
            at = s[np.arange(len(s)), kind[i : i + UPDATE]]
            found[i : i + UPDATE] = at - np.log(np.exp(s, out=s).sum(1))
        return found


def count(training: DataFrame, text: str, buckets: int) -> DataFrame:
    """A row for each bucket of words with its distinct words, their counts and endings; one task a bucket."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text, STEP_BYTES):
            hashes, endings, _ = read(batch.column(text))
            own, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            rows = [(b, own[i:j].tobytes(), counts[i:j].astype(np.uint64).tobytes(), endings[first[i:j]].tobytes()) for b, i, j in parts(own, buckets)]
            yield _rows(rows, ["bucket", "words", "counts", "endings"])

    def merge(table: pa.Table) -> pa.Table:
        own, counts, endings = merged(table)
        return pa.Table.from_batches([_rows([(table["bucket"][0].as_py(), own.tobytes(), counts.tobytes(), endings.tobytes())], ["bucket", "words", "counts", "endings"])])

    return training.select(text).mapInArrow(take, _COUNTED).groupBy("bucket").applyInArrow(merge, _COUNTED)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64() if n in ("bucket", "block") else pa.binary() for n in names]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def summary(counted: DataFrame, ends: int) -> Model:
    """The classes: what comes to the driver is a few rows of fixed size for each bucket, merged by Spark."""

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, counts, endings = (np.frombuffer(batch.column(n)[i].as_buffer(), k) for n, k in (("words", np.uint64), ("counts", np.uint64), ("endings", np.uint8)))
                top = np.lexsort((own, -counts.astype(np.int64)))[:FREQUENT]
                held = np.bincount(endings, counts, ENDINGS).astype(np.int64)
                kinds = np.bincount(endings, minlength=ENDINGS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.zeros(len(top), np.int32), np.ones(ENDINGS, np.int32)])), pa.array(np.concatenate([own[top].view(np.int64), np.arange(ENDINGS)])),
                     pa.array(np.concatenate([counts[top].astype(np.int64), held])), pa.array(np.concatenate([endings[top], kinds]).astype(np.int64))],
                    ["what", "name", "n", "more"],
                )

    rows = cut(counted.mapInArrow(most, "what int, name long, n long, more long"))
    top = [r for r in rows.filter("what = 0").orderBy(F.col("n").desc(), "name").limit(FREQUENT).collect()]
    held = {r["name"]: r for r in rows.filter("what = 1").groupBy("name").agg(F.sum("n").alias("n"), F.sum("more").alias("more")).collect()}
    counts = np.zeros(CLASSES)
    kinds = np.zeros(CLASSES)
    for name, r in held.items():
        counts[1 + FREQUENT + name], kinds[1 + FREQUENT + name] = r["n"], r["more"]
    total, distinct = int(counts.sum()) + ends, int(kinds.sum()) + (ends > 0)
    for k, r in enumerate(top):
        counts[1 + k] = r["n"]
        counts[1 + FREQUENT + r["more"]] -= r["n"]
        kinds[1 + FREQUENT + r["more"]] -= 1
    counts[0] = ends
    frequent = np.array([r["name"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    mass = counts + 0.1 * kinds
    mass[1 + FREQUENT :] += 0.1
    mass[: 1 + FREQUENT] += 0.1
    return Model(total, distinct, ends, frequent[order], 1 + order, mass)


def train(training: DataFrame, id: str, text: str, model: Model, learners: int, rounds: int) -> None:
    """Each round, learners make gradient updates from the common weights; a feature's new weights are the mean over
    learners, by how often each has seen it.

    A learner has about ``LEARNER_BYTES`` of text at any size of the corpus,
    which a row's id and text deal to it and which it reads in the order of
    ids, so weights depend neither on partitions nor on tasks.  What is sent
    has a fixed size for each learner.
    """
    spark = training.sparkSession
    rows = training.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("learner", F.pmod(F.xxhash64("id", "text"), F.lit(learners)))
    fixed = (model.total, model.distinct, model.ends, model.frequent, model.frequent_class, model.mass)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((fixed, model.weights))

        def run(table: pa.Table) -> pa.Table:
            common, weights = sent.value
            own = Model(*common, weights.copy())
            squares, seen = np.zeros_like(own.weights), np.zeros(len(own.weights), np.int64)
            ordered = table.sort_by([("id", "ascending"), ("text", "ascending")]).combine_chunks()
            for batch in steps(iter(ordered.to_batches()), "text", STEP_BYTES):
                _, kind, features, _ = own.examples(*read(batch.column("text")))
                own.learn(kind, features, squares, seen)
            some = np.flatnonzero(seen)
            values = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * CLASSES, own.weights[some].ravel())
            return pa.table({"row": some, "n": seen[some], "w": values})

        made = rows.groupBy("learner").applyInArrow(run, "row long, n long, w array<float>")
        means = [(F.sum(F.col("w")[k].cast("double") * F.col("n")) / F.sum("n")).cast("float") for k in range(CLASSES)]
        # Never more rows than the model has.
        for r in made.groupBy("row").agg(F.array(*means).alias("w")).collect():
            model.weights[r["row"]] = r["w"]
        sent.unpersist()


def lm_scores(docs: DataFrame, id: str = "doc_id", text: str = "text", parted: int = 10, rounds: int = 1) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row's whole text.

    Learns from rows whose ``part`` is not 0.  Counts are taken by buckets of
    words that tasks fill with sums; documents ask for the counts of their
    words by blocks, each distinct word once for a block, so the volume is far
    below one row for each token, and frequent words weigh no more than
    others.  Words are told apart by 64-bit hashes.

    ``base_score`` is the sum of log10((c + 0.1) / (N + 0.1 (V + 1))); ``score``
    the model's log10 probability, where each class has one unknown word.  A
    null text counts as empty: one token, the end.  A null id is held out.
    One row per input row; without rows to learn from all scores are those of
    untaught models.
    """
    kind = docs.schema[id].dataType.simpleString()
    total = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, buckets = total // BLOCK_BYTES + 1, total // BUCKET_BYTES + 1
    training = docs.filter(part(F.col(id), parted) != 0)
    counted = cut(count(training, text, buckets))
    model = summary(counted, training.count())
    train(training, id, text, model, total // LEARNER_BYTES + 1, rounds)
    # Plain arrays, which workers without this package can read.
    sent = docs.sparkSession.sparkContext.broadcast((model.total, model.distinct, model.ends, model.frequent, model.frequent_class, model.mass, model.weights))

    rows = docs.select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("__id", "__text"), F.lit(blocks))).repartition("block")

    def ask(table: pa.Table) -> pa.Table:
        own = np.unique(read(table["__text"].combine_chunks())[0])
        number = table["block"][0].as_py()
        return pa.Table.from_batches([_rows([(b, number, own[i:j].tobytes()) for b, i, j in parts(own, buckets)], ["bucket", "block", "words"])])

    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        known = np.frombuffer(held["words"][0].as_buffer(), np.uint64) if held.num_rows else np.zeros(1, np.uint64)
        counts = np.frombuffer(held["counts"][0].as_buffer(), np.uint64) if held.num_rows else np.zeros(1, np.uint64)
        found = []
        for bucket, block, x in zip(asked["bucket"].to_pylist(), asked["block"].to_pylist(), asked["words"]):
            own = np.frombuffer(x.as_buffer(), np.uint64)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            c = np.where(known[at] == own, counts[at], 0).astype("<u8")
            # The bytes of all counts, lowest first: mostly zeros, which pack well.
            found.append((block, bucket, np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes()))
        return pa.Table.from_batches([_rows(found, ["block", "bucket", "counts"])])

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        own = Model(*sent.value)
        hashes, endings, before = read(table["__text"].combine_chunks())
        distinct, which = np.unique(hashes, return_inverse=True)
        counts = np.zeros(len(distinct), np.uint64)
        for (_, i, j), x in zip(parts(distinct, buckets), sorted(zip(answers["bucket"].to_pylist(), answers["counts"]), key=lambda r: r[0])):
            counts[i:j] = np.ascontiguousarray(np.frombuffer(x[1].as_buffer(), np.uint8).reshape(8, -1).T).view("<u8").ravel()
        _, klass, features, at = own.examples(hashes, endings, before)
        inside = np.ones(len(klass), bool)
        inside[at[1:] - 1] = False
        c = np.full(len(klass), own.ends, np.float64)
        c[inside] = counts[which]
        base = np.log10((c + 0.1) / (own.total + 0.1 * (own.distinct + 1)))
        # Ends and frequent words are their classes' only tokens.
        alone = klass <= FREQUENT
        share = np.where(alone, 0.0, np.log10((c + 0.1) / own.mass[klass]))
        full = own.log_class(klass, features) / np.log(10) + share
        sums = lambda x: np.add.reduceat(x, at[:-1])
        return pa.table(
            [table["__id"], pa.array(np.diff(at)), pa.array(sums((c > 0).astype(np.int64))), pa.array(sums(base)), pa.array(sums(full))], schema=schema
        )

    schema = pa.schema(
        [("__id", to_arrow_type(docs.schema[id].dataType)), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )
    asked = rows.groupBy("block").applyInArrow(ask, _ASKED)
    answers = asked.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(answer, _ANSWERED)
    scored = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"__id {kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        F.col("__id").alias(id), (part(F.col("__id"), parted) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
