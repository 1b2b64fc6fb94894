"""Token counts: batches balanced by bytes are encoded, and only lengths come back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.batches import Memo, flat, pieces, slices, steps

#: Texts given to the tokenizer in one call, by bytes.
CALL_BYTES = 256 << 10
#: Pieces whose lengths a worker keeps, twice.
KEPT = 300_000


def json_tokenizer(path: str):
    """The tokenizers library's encoder of a .json file, as it is by default but for one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def balanced(texts: list[str], limit: int = CALL_BYTES) -> Iterator[list[str]]:
    """``texts`` in order, in lists of about ``limit`` bytes."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def splits_safely(tokenizer) -> bool:
    """Whether the tokenizer treats the pieces of ``batches.pieces`` alone."""
    import json

    held = json.loads(tokenizer.to_str())
    before = held.get("pre_tokenizer") or {}
    plain = held.get("normalizer") is None and held["model"]["type"] == "BPE"
    own = all(not (t["lstrip"] or t["rstrip"] or set(t["content"]) & set(" \t\n\v\f\r")) for t in held.get("added_tokens", []))
    return plain and own and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")


def token_counts(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of each row's whole text.

    Texts are cut where a byte-level tokenizer never joins them (before ASCII
    white space that follows another character); the distinct pieces of a
    step are encoded in calls of like byte size, lengths are kept for later
    steps, and a text's count is the sum over its pieces.  Other .json
    tokenizers, and .model files, get whole texts.

    One row per input row, repeated rows too.  A null text counts as empty:
    0 bytes, 0 tokens.  A null id stays null.  An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            lengths: Callable = lambda texts: [len(x) for x in model.encode([t.decode() for t in texts], num_threads=1)]
            safe = False
        else:
            tokenizer = json_tokenizer(path)
            safe = splits_safely(tokenizer)

            def lengths(texts: list[bytes]) -> list[int]:
                found: list[int] = []
                for part in balanced([t.decode() for t in texts]):
                    found += map(len, tokenizer.encode_batch_fast(part, add_special_tokens=False))
                return found

        kept = Memo(lengths, KEPT)
        for batch in steps(batches, text):
            data, places = flat(batch.column(text))
            if safe:
                starts, before = pieces(data, places)
                coded = slices(data, starts, np.append(starts[1:], len(data))[: len(starts)]).dictionary_encode()
                each = np.array(kept(coded.dictionary.to_pylist()), np.int64)
                total = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
                counts = total[before[1:]] - total[before[:-1]]
            else:
                counts = np.array(lengths(slices(data, places[:-1], places[1:]).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), pa.array(np.diff(places)), pa.array(counts), pa.array(counts > limit)],
                [id, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"{id} {kind}, n_bytes long, n_tokens long, over_limit boolean")
