"""Token counts, token files and SentencePiece against the libraries."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import pieces, token_files
from tessera.llm.token_counts import json_tokenizer, token_counts
from tessera.runtime import new_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

PARTS = ["a", "b", " ", "  ", "\n", "é", " ", "\xa0", "漢", "🙂", "the", "ing", "\t", "!!!", "1", "\x00", "'s", "<|endoftext|>", "\x1c", "\u0085", "　", "à", "…", "▁"]


def strings(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "  ", "a" * 9000, "ab " * 5000]


@pytest.mark.parametrize("path", [BYTES, public_tokenizers.path("word_bpe_49k.json"), PIECES])
def test_counts_are_the_librarys(spark, odd, path):
    rows, docs = odd
    if path.endswith(".model"):
        count = lambda t: len(pieces.load(path).encode(t))
    else:
        own = json_tokenizer(path)
        count = lambda t: len(own.encode(t, add_special_tokens=False).ids)
    want = Counter((i, len((t or "").encode()), count(t or "")) for i, t in rows)
    got = token_counts(docs, path).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_pieces_of_texts_join_to_the_librarys_ids():
    texts = strings(3000, 3)
    own, encode = json_tokenizer(BYTES), token_files.encoder(BYTES)
    for _ in range(2):  # the second time from what is kept
        ids, places = encode(pa.array(texts))
        for text, a, b in zip(texts, places[:-1], places[1:]):
            assert ids[a:b].tolist() == own.encode(text, add_special_tokens=False).ids, text


def test_empty_tables(spark, none):
    assert token_counts(none, BYTES).count() == 0
    assert pieces.encode_decode(none, PIECES).count() == 0
    path = new_path(spark, "none")
    token_files.write_tokens(none, path, BYTES)
    assert token_files.read_documents(spark, path).count() == 0


def test_levels_give_every_id():
    rng = np.random.default_rng(1)
    for ids in ([], [0], [255, 256, 65535, 65536, 2**32 - 1, 0], rng.integers(0, 60000, 5000), rng.integers(0, 2**32, 1500), [7] * 600):
        ids = np.array(ids, np.uint32)
        levels = token_files.to_levels(ids)
        assert token_files.from_levels(levels).tolist() == ids.tolist()
        assert [token_files.id_at(levels, i) for i in range(len(ids))] == ids.tolist()


def test_files_hold_all_documents_in_order(spark, odd, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 4096)
    rows, docs = odd
    own = json_tokenizer(BYTES)
    path = new_path(spark, "tokens")
    token_files.write_tokens(docs.repartition(5), path, BYTES)
    got = token_files.read_documents(spark, path).collect()
    want = Counter()
    whole = {}
    for i, t in rows:
        ids = np.array(own.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
        whole[i, zlib.crc32(ids.tobytes())] = ids
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    # Any place alone.
    total = got[-1].start + got[-1].n_tokens
    places = [0, 1, total - 1, total, -1, *range(5, total, 997)]
    found = {r.position: r.token_id for r in token_files.tokens_at(spark, path, spark.createDataFrame([(p,) for p in places], "position long")).collect()}
    assert sorted(found) == sorted(p for p in places if 0 <= p < total)
    ids = np.concatenate([whole[r.doc_id, r.ids_crc32] for r in got])
    assert all(ids[p] == t for p, t in found.items())


def test_agenda_and_heap_give_the_librarys_ids():
    coder = pieces.Coder(PIECES)
    texts = strings(3000, 5) + ["x" * 60 + " y", "thethe" * 20]
    counts, ids, decoded, unlike = coder.run(pa.array([*texts, None]))
    assert unlike.sum() == 0 and counts[-1] == 0 and ids[-1] == b""
    for text, n, a, b in zip(texts, counts, ids, decoded):
        want = coder.model.encode(text)
        assert n == len(want) and a.decode() == ",".join(map(str, want)) and b.decode() == coder.model.decode(want)
        symbols = coder.vocabulary.characters[[ord(c) for c in ("▁" + text.replace(" ", "▁")) * bool(text)]].tolist()
        assert coder.vocabulary.spelled(coder.vocabulary.agenda(symbols)) == want


def test_decoding_any_ids():
    coder, rng = pieces.Coder(PIECES), random.Random(6)
    for _ in range(2000):
        ids = [rng.randrange(3, 32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 12))]
        assert coder.vocabulary.decode(ids) == coder.model.decode(ids)


def test_sentencepiece_of_a_table(spark, odd):
    rows, docs = odd
    model = pieces.load(PIECES)
    want = Counter()
    for i, t in rows:
        ids = model.encode(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest(), 0] += 1
    found = pieces.encode_decode(docs, PIECES, keep=True)
    got = found.collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_unlike) for r in got) == want
    again = pieces.decode(found.select("doc_id", "ids", F.lit("old").alias("decoded")), PIECES).collect()
    assert Counter((r.doc_id, r.decoded) for r in again) == Counter((r.doc_id, r.decoded) for r in got)
