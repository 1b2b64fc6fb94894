"""Benchmark passages in documents, within an edit distance.

The CGK walk turns edit distance into Hamming distance: at each step it emits
the word it stands on and goes on to the next word, or stays, by a random bit
of the step and the word.  Texts that differ by few edits walk in step for
long, so bits (here: words) sampled from the two walks are often all equal.  A
repetition has its own bits, its own sampled steps and its own start inside
each item; a document's words walk from every place.  Places whose samples
equal an item's are candidates, and the exact edit distance decides.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.batches import flat, mixed, steps, word_hashes

#: Steps of a walk and samples of it (fewer for items of fewer words, see ``lengths``).
STEPS, SAMPLES = 12, 4
#: Repetitions at most; 64 give a recall of over 0.99 at one edit in four words.
MOST = 64
#: Items that are looked for in one pass over the documents.
ITEMS = 20_000
#: Cells of the distance table that are worked off at a time.
CELLS = 1 << 22

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def found_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (letters, digits and all that is not ASCII), and the number of them before each text."""
    data, places = flat(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(places), np.int64)
    solid = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[places] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return word_hashes(data, starts, ends), np.searchsorted(starts, places)


class Walks:
    """Repetitions of the walk for items that allow the same number of steps."""

    def __init__(self, symbols: int, length: int, repetitions: int, seed: int):
        rng = np.random.default_rng([seed, length])
        self.length = length
        self.bits = rng.integers(0, 1 << 16, (repetitions, symbols), np.uint16)
        self.shares = rng.random(repetitions)
        n = min(SAMPLES, length) - 1
        self.sampled = [sorted([0, *(1 + rng.choice(length - 1, n, replace=False)).tolist()]) if n else [0] for _ in range(repetitions)]

    def start(self, words: int, repetition: int) -> int:
        """Where in an item of that many words the walk begins."""
        return int(self.shares[repetition] * (words - self.length + 1))

    def keys(self, text: np.ndarray, at: np.ndarray, repetition: int, known: list[np.ndarray] | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """Walk from ``at``; the places left and their keys after each sample.  ``known``: drop what is in none of these."""
        bits, sampled = self.bits[repetition], self.sampled[repetition]
        place, key, keys = at, None, []
        for step in range(sampled[-1] + 1):
            here = text[place]
            if step in sampled:
                word = here.astype(np.uint64)
                key = word if key is None else mixed(key * np.uint64(0x9E3779B97F4A7C15) + word)
                if known is not None:
                    held = known[len(keys)]
                    going = held[np.minimum(np.searchsorted(held, key), len(held) - 1)] == key
                    at, place, key, here = at[going], place[going], key[going], here[going]
                keys.append(key)
                if not len(at):
                    return at, [np.zeros(0, np.uint64)] * len(sampled)
            place = place + (bits[here] >> step & 1)
        return at, keys


class Items:
    """Items as symbols, the tables of their keys, and the search."""

    def __init__(self, ids: list, texts: list, rate: float, recall: float, seed: int):
        hashes, before = found_words(pa.array(texts, pa.string()))
        self.words, coded = np.unique(hashes, return_inverse=True)
        held = [coded[i:j] + 1 for i, j in zip(before[:-1], before[1:])]  # 0: a word of no item
        some = [i for i, x in enumerate(held) if len(x)]
        self.ids = [ids[i] for i in some]
        self.items = [held[i].astype(np.int64) for i in some]
        self.sizes = np.array([len(x) for x in self.items], np.int64)
        self.budgets = np.floor(self.sizes * rate).astype(np.int64)
        self.kinds = []
        lengths = self.lengths()
        # Short items of other budgets are simulated alone, so that easy ones do not hide what others lose.
        budgets = np.where(lengths < STEPS, self.budgets, -1)
        for length, budget in sorted(set(zip(lengths.tolist(), budgets.tolist()))):
            which = np.flatnonzero((lengths == length) & (budgets == budget))
            walks = Walks(len(self.words) + 1, length, MOST, seed)
            n = self.repetitions(walks, which, recall, seed)
            self.kinds.append((walks, n, which, [self.table(walks, which, r) for r in range(n)]))

    def lengths(self) -> np.ndarray:
        """Steps of each item's walks: of more starts than edits are allowed, so that no edited words are in the way of all."""
        return np.where(self.sizes - STEPS >= self.budgets, STEPS, np.maximum(self.sizes - 2 * self.budgets, 1))

    def table(self, walks: Walks, which: np.ndarray, r: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Known keys after each sample; the items (and their starts) in the order of their last key."""
        starts = np.array([walks.start(int(n), r) for n in self.sizes[which]], np.int64)
        at = np.concatenate([[0], np.cumsum(self.sizes[which])])[:-1] + starts
        text = np.concatenate([self.items[i] for i in which] + [np.zeros(STEPS, np.int64)])
        _, keys = walks.keys(text, at, r)
        order = np.argsort(keys[-1], kind="stable")
        return [np.unique(k) for k in keys], keys[-1][order], which[order], starts[order]

    def repetitions(self, walks: Walks, which: np.ndarray, recall: float, seed: int) -> int:
        """Repetitions that find ``recall`` of items edited at random as much as is allowed (of 400 copies or a few more)."""
        rng = np.random.default_rng(seed)
        met = np.zeros(MOST, np.int64)
        some = which[np.linspace(0, len(which) - 1, min(len(which), 100)).astype(int)]
        tries = 0
        for i in some:
            for _ in range(-(-400 // len(some))):
                item, copy, at = self.items[i], [], []
                left = rng.choice(len(item), min(int(self.budgets[i]), len(item)), replace=False)
                kinds = dict(zip(left.tolist(), rng.integers(0, 3, len(left)).tolist()))
                for k, word in enumerate(item.tolist()):
                    at.append(len(copy))
                    # Changed, left out, or with another word before it.
                    copy += {None: [word], 0: [0], 1: [], 2: [0, word]}[kinds.get(k)]
                    at[-1] += kinds.get(k) == 2
                text = np.array(copy + [0] * (STEPS + 1), np.int64)
                whole = np.concatenate([item, np.zeros(STEPS, np.int64)])
                tries += 1
                for r in range(MOST):
                    start = walks.start(len(item), r)
                    _, own = walks.keys(whole, np.array([start]), r)
                    _, other = walks.keys(text, np.array([at[start]]), r)
                    if own[-1][0] == other[-1][0]:
                        met[r] += 1
                        break
        reached = np.cumsum(met) >= recall * tries
        if not reached.any():
            warnings.warn(f"{MOST} repetitions find {met.sum() / tries:.3f} of passages of items of {self.sizes[which].min()} to {self.sizes[which].max()} words, not {recall}")
            return MOST
        return int(np.argmax(reached)) + 1

    def candidates(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and the places of their first words that equal keys suggest; each once."""
        n = len(text)
        padded = np.concatenate([text, np.zeros(STEPS + 1, text.dtype)])
        found = []
        for walks, repetitions, _, tables in self.kinds:
            for r, (known, last, items, starts) in enumerate(tables[:repetitions]):
                first = np.zeros(len(self.words) + 1, bool)
                first[known[0].astype(np.int64)] = True
                at, keys = walks.keys(padded, np.flatnonzero(first[text]), r, known)
                if not len(at):
                    continue
                a, b = np.searchsorted(last, keys[-1], "left"), np.searchsorted(last, keys[-1], "right")
                take = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
                found.append(np.unique(items[take] * (n + 2**20) + np.repeat(at, b - a) - starts[take] + 2**19))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.concatenate(found))
        return both // (n + 2**20), both % (n + 2**20) - 2**19

    def distances(self, text: np.ndarray, ends: np.ndarray, item: int, places: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least edit distance between an item and a passage near each place, and where the best passage ends.

        A distance over the budget is only told to be over it.  ``begins`` and ``ends`` bound each place's document.  Passages may
        begin and end up to the allowed edits before or after the item would.
        """
        word, budget = self.items[item], int(self.budgets[item])
        width = len(word) + 2 * budget
        at = places[:, None] - budget + np.arange(width)
        inside = (at >= begins[:, None]) & (at < ends[:, None])
        there = np.where(inside, text[np.clip(at, 0, max(len(text) - 1, 0))], -1)
        # A passage within the budget has all words of the item but as many.
        member = np.zeros(len(self.words) + 2, bool)
        member[word] = True
        hopeful = np.flatnonzero(member[there].sum(1) >= len(word) - budget)
        away, end = np.full(len(places), budget + 1), places.copy()
        if not len(hopeful):
            return away, end
        there = there[hopeful]
        step = np.arange(width + 1)
        row = np.zeros((len(hopeful), width + 1), np.int64)
        for w in word:
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (there != w), out=new[:, 1:])
            row = np.minimum.accumulate(new - step, axis=1) + step
        best = row.argmin(1)
        away[hopeful] = row[np.arange(len(hopeful)), best]
        end[hopeful] = places[hopeful] - budget + best
        return away, end

    def leaks(self, hashes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, item, distance, end)``: of each text and item within the budget, the best passage (the first of equals)."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        text = np.where(self.words[at] == hashes, at + 1, 0) if len(self.words) else np.zeros(len(hashes), np.int64)
        items, places = self.candidates(text)
        # The place of an item's first word may lie before its document; the candidate's own place does not.
        middle = np.clip(places + self.sizes[items] // 2, 0, max(len(text) - 1, 0)) if len(items) else places
        rows = []
        for item in np.unique(items):
            mine = np.flatnonzero(items == item)
            size = max(1, CELLS // int(self.sizes[item] + 2 * self.budgets[item] + 1))
            for i in range(0, len(mine), size):
                some = mine[i : i + size]
                owner = np.searchsorted(before, middle[some], "right") - 1
                away, end = self.distances(text, before[1:][owner], int(item), places[some], before[:-1][owner])
                good = away <= self.budgets[item]
                rows.append(np.stack([owner[good], np.full(good.sum(), item), away[good], end[good] - before[:-1][owner[good]]]))
        if not rows:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        owner, item, away, end = np.concatenate(rows, axis=1)
        order = np.lexsort((end, away, item, owner))
        owner, item, away, end = owner[order], item[order], away[order], end[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
        return owner[new], item[new], away[new], end[new]


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    rate: float = 0.2,
    recall: float = 0.99,
    seed: int = 7,
) -> DataFrame:
    """``id, item, edits, item_words, end_word``: each row that holds a passage within ``rate`` edits a word of an item.

    Words are lower-cased runs of letters, digits and other characters that
    are not ASCII; ``edits`` is the least number of words put in, left out or
    changed, and the best passage ends before word ``end_word``.  What is
    returned is exact; ``recall`` is the share of passages with as many edits
    as allowed that the repetitions are to find (fewer edits: more).

    Items are read in blocks of ``ITEMS``, each looked for in one pass over
    all rows, so what tasks hold does not grow with the items.  Null and empty
    texts hold nothing; items without words are in nothing; an empty table of
    either gives no rows.  A row that is repeated gives its rows as often.
    """
    kinds = [docs.schema[id].dataType.simpleString(), items.schema[item].dataType.simpleString()]
    schema = f"`{id}` {kinds[0]}, `{item}` {kinds[1]}, edits long, item_words long, end_word long"
    spark = docs.sparkSession

    def search(block: list) -> DataFrame:
        held = Items([r[0] for r in block], [r[1] for r in block], rate, recall, seed)
        # With the class itself, so that workers need no copy of this package.
        sent = spark.sparkContext.broadcast(cloudpickle.dumps(held))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = cloudpickle.loads(sent.value)
            kind = None
            for batch in steps(batches, text):
                kind = kind or pa.array(own.ids).type
                row, which, away, end = own.leaks(*found_words(batch.column(text)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id).take(pa.array(row)), pa.array([own.ids[i] for i in which], kind), pa.array(away), pa.array(own.sizes[which]), pa.array(end)],
                    [id, item, "edits", "item_words", "end_word"],
                )

        return docs.select(id, text).mapInArrow(run, schema)

    found, block = None, []
    for r in items.select(F.col(item), F.coalesce(F.col(item_text), F.lit(""))).toLocalIterator():
        block.append(r)
        if len(block) == ITEMS:
            found, block = search(block) if found is None else found.union(search(block)), []
    if block or found is None:
        found = search(block) if found is None else found.union(search(block))
    return found
