"""SentencePiece encoding and decoding of merge-type vocabularies.

A text is a row of symbols, at first its characters.  The agenda holds the
adjacent pairs that join to a piece; the pair of the best score (of equals the
leftmost) is joined and its neighbours' entries are renewed, until no pair is
left.  Many short strings are worked off side by side: each has its agenda in a
row of a matrix.  Long ones have a heap of their own.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.batches import Memo, flat, slices, steps

#: The sign that stands for a space in pieces.
SIGN = "▁"
#: Characters of the longest string in a matrix.
SHORT = 48
#: Units whose results a worker keeps, twice.
KEPT = 150_000

_NONE = np.float32(-np.inf)


def load(path: str):
    """The library's processor of a model."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Vocabulary:
    """Pieces, scores and joins of a model."""

    def __init__(self, model):
        n = model.get_piece_size()
        self.n = n
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        scores = np.array([model.get_score(i) for i in range(n)], np.float32)
        plain = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for i in range(n)]
        if any(model.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.bytes = np.full(256, -1, np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.bytes[int(self.pieces[i][3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("only models with byte fallback are supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if plain[i]}
        #: Symbol of each character: its piece, or n and more for one that has none.
        self.characters = np.arange(0x110000, dtype=np.int64) + n
        for p, i in self.ids.items():
            if len(p) == 1:
                self.characters[ord(p)] = i
        keys, joined = [], []
        for p, i in self.ids.items():
            for cut in range(1, len(p)):
                left, right = self.symbol(p[:cut]), self.symbol(p[cut:])
                if left is not None and right is not None:
                    keys.append(left << 22 | right)
                    joined.append(i)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.joined = np.array(joined, np.int64)[order]
        self.scores = scores
        self.joins = dict(zip(self.keys.tolist(), self.joined.tolist()))
        #: What each id stands for in a text.
        self.raw = [p.replace(SIGN, " ").encode() if plain[i] else b"" for i, p in enumerate(self.pieces)]
        for value, i in enumerate(self.bytes):
            self.raw[i] = bytes([value])
        self.unknown = model.unk_id()

    def symbol(self, text: str) -> int | None:
        """The piece ``text``, or the symbol of a single character."""
        return self.ids.get(text, int(self.characters[ord(text)]) if len(text) == 1 else None)

    def join(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece of each pair and its score, or -1 and minus infinity."""
        key = left << 22 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        piece = np.where(found, self.joined[at], -1)
        return piece, np.where(found, self.scores[piece], _NONE)

    def agendas(self, symbols: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Symbols of strings of one length (rows), joined: (rows, their symbols) for each final length."""
        done = []
        rows = np.arange(len(symbols))
        piece, score = self.join(symbols[:, :-1], symbols[:, 1:])
        while symbols.shape[1] > 1 and len(rows):
            best = score.argmax(1)  # the first of equals
            going = score[np.arange(len(rows)), best] != _NONE
            if not going.all():
                done.append((rows[~going], symbols[~going]))
                rows, symbols, piece, score, best = rows[going], symbols[going], piece[going], score[going], best[going]
                if not len(rows):
                    return done
            each = np.arange(len(rows))
            symbols[each, best] = piece[each, best]
            width = symbols.shape[1]
            gone = np.ones(symbols.shape, bool)
            gone[each, best + 1] = False
            symbols = symbols[gone].reshape(-1, width - 1)
            if width == 2:
                break
            kept = np.ones(piece.shape, bool)
            kept[each, best] = False
            piece, score = piece[kept].reshape(-1, width - 2), score[kept].reshape(-1, width - 2)
            for side, some in ((best - 1, best > 0), (best, best < width - 2)):
                at, row = side[some], each[some]
                piece[row, at], score[row, at] = self.join(symbols[row, at], symbols[row, at + 1])
        done.append((rows, symbols))
        return done

    def agenda(self, symbols: list[int]) -> list[int]:
        """Symbols of one string of any length, joined with a heap."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int, int, int]] = []

        def enter(left: int, right: int) -> None:
            if left >= 0 and right < n:
                joined = self.joins.get(symbols[left] << 22 | symbols[right])
                if joined is not None:
                    heapq.heappush(heap, (-float(self.scores[joined]), left, symbols[left], symbols[right], joined))

        for i in range(n - 1):
            enter(i, i + 1)
        while heap:
            _, left, a, b, joined = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != a or right >= n or symbols[right] != b:
                continue  # one of the two has been joined meanwhile
            symbols[left], symbols[right] = joined, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            enter(before[left], left)
            enter(left, after[left])
        return [s for s in symbols if s >= 0]

    def spelled(self, symbols: list[int]) -> list[int]:
        """Ids of symbols; a character without a piece becomes its bytes."""
        if max(symbols, default=0) < self.n:
            return symbols
        return [i for s in symbols for i in ([s] if s < self.n else self.bytes[list(chr(s - self.n).encode())].tolist())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each string, whose spaces are signs already and which has its first sign."""
        found: list[list[int]] = [[]] * len(texts)
        lengths = np.array([len(t) for t in texts])
        for length in np.unique(lengths):
            which = np.flatnonzero(lengths == length)
            if length == 0:
                continue
            if length > SHORT:
                for i in which:
                    points = np.frombuffer(texts[i].encode("utf-32-le"), np.uint32)
                    found[i] = self.spelled(self.agenda(self.characters[points].tolist()))
                continue
            points = np.frombuffer("".join([texts[i] for i in which]).encode("utf-32-le"), np.uint32)
            for rows, symbols in self.agendas(self.characters[points].reshape(len(which), length)):
                for i, row in zip(which[rows].tolist(), symbols.tolist()):
                    found[i] = self.spelled(row)
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, as the library has it: one leading space goes, wrong bytes become U+FFFD."""
        whole, run = [], bytearray()

        def flush() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        whole.append(bytes(run[at : at + size]).decode())
                        break
                    except UnicodeDecodeError:
                        size = 0
                if not size:
                    whole.append("�")
                at += size or 1
            run.clear()

        for i in ids:
            if self.pieces[i] and self.bytes[0] <= i < self.bytes[0] + 256 and self.raw[i]:
                run.extend(self.raw[i])
                continue
            flush()
            whole.append(" ⁇ " if i == self.unknown else self.raw[i].decode())
        flush()
        text = "".join(whole)
        return text[1:] if ids and self.pieces[ids[0]].startswith(SIGN) else text


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Strings that pieces never cross, each with its leading spaces, and the number of them before each text.

    A text gets the space that the model puts first.  Pieces have signs only
    at their beginning, so no piece crosses from another character to a space;
    a sign in the text itself counts as a space.
    """
    data, places = flat(texts)
    some = np.diff(places) > 0
    data = np.insert(data, places[:-1][some], 32)
    places = places + np.concatenate([[0], np.cumsum(some)])
    first = np.zeros(len(data) + 1, bool)
    first[places[:-1]] = True
    at = np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1
    sign = (data[at - 1] == 0x81) & (data[np.maximum(at - 2, 0)] == 0x96) & (data[np.maximum(at - 3, 0)] == 0xE2)
    first[at[~sign]] = True
    starts = np.flatnonzero(first[:-1])
    return slices(data, starts, np.append(starts[1:], len(data))[: len(starts)]), np.searchsorted(starts, places)


class Coder:
    """Encodes and decodes Arrow arrays of texts in one worker, and compares with the library."""

    def __init__(self, path: str, check: bool = True):
        self.model = load(path)
        self.vocabulary = Vocabulary(self.model)
        if any(SIGN in p.lstrip(SIGN) for p in self.vocabulary.pieces):
            raise ValueError("pieces with signs inside are not supported")
        # The model must put a space first and change nothing else.
        if self.vocabulary.decode(self.model.encode(" a \tB\u00e9\ufb01  ")) != " a \tB\u00e9\ufb01  ":
            raise ValueError("models that normalise texts are not supported")
        self.check = check
        self.kept = Memo(self.made, KEPT)

    def made(self, keys: list[bytes]) -> list[tuple[int, bytes, bytes, bool]]:
        """Of each unit: number of ids, ids as text, decoded bytes, whether the library has other ids."""
        texts = [k.decode() for k in keys]
        ids = self.vocabulary.encode([t.replace(" ", SIGN) for t in texts])
        unlike = [a != b for a, b in zip(ids, self.library(texts))] if self.check else [False] * len(keys)
        raw = self.vocabulary.raw
        return [(len(x), ",".join(map(str, x)).encode(), b"".join([raw[i] for i in x]), bad) for x, bad in zip(ids, unlike)]

    def library(self, texts: list[str]) -> list[list[int]]:
        """The library's ids of units; it puts the first space itself, but not to an empty text."""
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [x if len(t) > 1 else self.model.encode("a" + t)[len(self.model.encode("a")) :] for x, t in zip(found, texts)]

    def run(self, texts: pa.Array) -> tuple[np.ndarray, list[bytes], list[bytes], np.ndarray]:
        """Of each text: number of ids, ids joined by commas, the decoded text, units whose ids the library has otherwise."""
        cut, before = units(texts)
        coded = cut.dictionary_encode()
        each = self.kept(coded.dictionary.to_pylist())
        codes = coded.indices

        def total(k: int) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(np.array([x[k] for x in each], np.int64)[codes.to_numpy()])])
            return sums[before[1:]] - sums[before[:-1]]

        def joined(k: int, by: bytes) -> list[bytes]:
            taken = pa.array([x[k] for x in each], pa.large_binary()).take(codes)
            return pc.binary_join(pa.LargeListArray.from_arrays(before, taken), pa.scalar(by, pa.large_binary())).to_pylist()

        # What is decoded is whole characters, so only the model's first space goes.
        return total(0), joined(1, b","), [x[1:] if x[:1] == b" " else x for x in joined(2, b"")], total(3)


def encode_decode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", check: bool = True, keep: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256, n_unlike`` of each row's whole text; with ``keep`` also ``ids, decoded``.

    Ids come from the agenda; ``n_unlike`` counts the units for which the
    library, given each new unit of an Arrow batch, has other ids (0 if all
    agree; not compared without ``check``).

    One row per input row, repeated rows too.  A null text counts as empty:
    no ids, and the hash of the empty string twice.  A null id stays null.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = f"{id} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_unlike long" + ", ids array<int>, decoded string" * keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path, check)
        for batch in steps(batches, text):
            counts, ids, decoded, unlike = coder.run(batch.column(text))
            columns = {
                id: batch.column(id),
                "n_tokens": pa.array(counts),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                "n_unlike": pa.array(unlike),
            }
            if keep:
                columns["ids"] = pa.array([[int(i) for i in x.split(b",")] if x else [] for x in ids], pa.list_(pa.int32()))
                columns["decoded"] = pa.array([x.decode(errors="replace") for x in decoded])
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select(id, text).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of its array of ids; null ids give a null text."""
    others = [f for f in rows.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(load(path))
        for batch in batches:
            found = [None if x is None else vocabulary.decode(x) for x in batch.column(ids).to_pylist()]
            names = [f.name for f in others]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, pa.string())], [*names, text])

    return rows.select(*[f.name for f in others]).mapInArrow(run, schema)
