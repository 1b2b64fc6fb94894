"""Quality, language and likelihood: held-out accuracy, exact parts, and odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import lm
from tessera.llm.language import Network, cut_words, languages
from tessera.llm.lm import lm_scores
from tessera.llm.quality import FEATURES, fit, quality_scores, statistics

from .conftest import frame

DATA = "/root/testdata/sf0.01"


def crc(i):
    return zlib.crc32(str(i).encode()) if i is not None else 0


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_quality_of_held_out_documents(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = {r.doc_id: r for r in quality_scores(documents, labels).collect()}
    known = duckdb.sql(f"SELECT doc_id, quality FROM '{DATA}/labels.parquet'").fetchall()
    held = [(got[i], q) for i, q in known if crc(i) % 5 == 0]
    assert len(got) == documents.count() and all(r.held_out == (crc(i) % 5 == 0) for i, r in got.items())
    assert sum(r.predicted == q for r, q in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_quality_learns_from_the_right_rows(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    whole = {r.doc_id: r.score for r in quality_scores(documents, labels).collect()}
    # Other labels of held-out rows change nothing.
    other = labels.selectExpr("doc_id", "CASE WHEN pmod(crc32(cast(doc_id AS string)), 5) = 0 THEN 1 - quality ELSE quality END AS quality", "toxic")
    again = {r.doc_id: r.score for r in quality_scores(documents, other).collect()}
    assert all(abs(again[i] - s) < 1e-9 for i, s in whole.items())


def test_quality_of_odd_rows(spark, odd, none):
    rows, docs = odd
    labels = spark.createDataFrame([(8, 1), (8, 1), (9, 0), (11, None), (None, 1), (12, 7)], "doc_id long, quality int")
    got = quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows) and all(0 <= r.score <= 1 for r in got)
    for some, share in ((labels.limit(0), 0.5), (labels.filter("quality = 1"), 1.0)):
        assert {r.score for r in quality_scores(docs, some).collect()} == {share}
    assert quality_scores(none, labels).count() == 0


def test_statistics_and_discriminant():
    from tessera.llm.batches import flat
    import pyarrow as pa

    x = statistics(*flat(pa.array(["", None, "One two two\nOne two two\n", "A!! | #$ é", "x"])))
    assert x.shape == (5, len(FEATURES)) and np.isfinite(x).all() and (x[0] == x[1]).all()
    assert x[2, 0] == np.log1p(6)
    assert x[2, FEATURES.index("equal_lines")] == pytest.approx(np.arcsin(np.sqrt(1 / 8)))
    assert x[2, FEATURES.index("repeated")] == pytest.approx(np.arcsin(np.sqrt(2 / 12)))
    # Against the density itself.
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, (300, 3)), rng.normal(1, 2, (500, 3))
    model = fit([300, 500], np.array([a.sum(0), b.sum(0)]), np.array([a.T @ a, b.T @ b]), 0.1, 1e-3)

    def density(x, d):
        mean, cov = d.mean(0), np.cov(d.T, bias=True)
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 1e-3 * np.eye(3)
        away = x - mean
        return math.exp(-0.5 * away @ np.linalg.solve(cov, away)) / math.sqrt(np.linalg.det(2 * math.pi * cov)) * len(d)

    for x in rng.normal(0, 2, (20, 3)):
        assert model.score(x[None])[0] == pytest.approx(density(x, b) / (density(x, a) + density(x, b)))


def test_gradients_of_the_network():
    network = Network(3)
    for k in network.w:
        network.w[k] = network.w[k].astype(np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (5, 4)), np.array([0, 1, 2, 0, 1])
    found = network.gradients(x, y)

    def loss():
        return -network.log_labels(x)[np.arange(5)[:, None], np.arange(4)[None], y[:, None]].mean()

    for k, w in network.w.items():
        i = (x[1, 2], 7) if k[0] == "x" else tuple(rng.integers(0, m) for m in w.shape)
        old = w[i]
        w[i] = old + 1e-4
        up = loss()
        w[i] = old - 1e-4
        assert found[k][i] == pytest.approx((up - loss()) / 2e-4, abs=1e-6)
        w[i] = old


def test_language_of_held_out_documents(documents):
    got = {r.doc_id: r for r in languages(documents, updates=150).collect()}
    known = duckdb.sql(f"SELECT doc_id, lang FROM '{DATA}/documents.parquet'").fetchall()
    held = [got[i].lang_pred == lang for i, lang in known if crc(i) % 4 == 2]
    assert len(got) == len(known) and all(r.held_out == (crc(i) % 4 == 2) for i, r in got.items())
    assert sum(held) / len(held) > 0.97


def test_language_of_odd_rows(spark, none):
    rows = [(1, "the house and the garden", "en"), (2, "das Haus und der Garten", "de"), (3, "das", None), (4, None, "de"), (5, "", "en"), (6, "12 34 !?", "en"), (7, "漢字", "zz"), (None, "the", "en"), (2, "das Haus", "de"), (8, "u" * 5000, "en")]
    got = languages(frame(spark, rows), updates=20).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (4, 5, 6)] == ["und"] * 3 and by[4].score == 0
    assert all(r.lang_pred in {"en", "de", "zz", "und"} and 0 <= r.score <= 1 for r in got)
    one = languages(frame(spark, [(1, "the", "en"), (2, "das", None), (3, "7", None)]), updates=5).collect()
    assert {(r.doc_id, r.lang_pred) for r in one} == {(1, "en"), (2, "en"), (3, "und")}
    assert {r.lang_pred for r in languages(frame(spark, [(1, "the"), (2, "das")]), updates=5).collect()} == {"und"}
    assert languages(none, updates=5).count() == 0


def test_long_words_are_cut():
    import pyarrow as pa

    held, before = cut_words(pa.array(["A" * 50 + " b", None, "cd"]))
    assert held.to_pylist() == [b"a" * 24, b"a" * 24, b"aa", b"b", b"cd"] and before.tolist() == [0, 4, 4, 5]


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def unigrams(rows, parted=10):
    own = [(i, WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]) for i, t in rows]
    counts = Counter()
    for i, w in own:
        if crc(i) % parted:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for i, w in own]


def same_base(got, rows):
    # round() joins what sums in another order
    want = Counter((i, n, k, t, round(b, 4)) for i, n, k, t, b in unigrams(rows))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want


def test_unigrams_of_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 50_000)
    rows, docs = odd
    got = lm_scores(docs).collect()
    same_base(got, rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scores(none).count() == 0
    untaught = [(i, "a b") for i in range(200) if crc(i) % 10 == 0][:3]
    same_base(lm_scores(frame(spark, untaught)).collect(), untaught)


def test_model_beats_unigrams_on_held_out_texts(documents):
    got = lm_scores(documents).collect()
    same_base(got, duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (crc(r.doc_id) % 10 == 0) for r in got)
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.1


def test_model_is_a_distribution():
    """Over all known words, the end and the unknown words of all classes, whatever stands before."""
    rng = random.Random(3)
    vocabulary = [f"{rng.choice('abc')}{i}{rng.choice(['ed', 'ing', 'er', 's'])}" for i in range(60)]
    import pyarrow as pa

    texts = pa.array([" ".join(rng.choice(vocabulary) for _ in range(30)) for _ in range(20)])
    hashes, endings, before = lm.read(texts)
    own, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    kinds = endings[first]
    top = np.argsort(-counts, kind="stable")[: lm.FREQUENT]
    rest = np.setdiff1d(np.arange(len(own)), top)
    mass = np.concatenate([[20.1], counts[top] + 0.1, 0.1 + np.bincount(kinds[rest], counts[rest] + 0.1, lm.ENDINGS)])
    order = np.argsort(own[top])
    model = lm.Model(int(counts.sum()) + 20, len(own) + 1, 20, own[top][order], 1 + order, mass)
    _, kind, features, _ = model.examples(hashes, endings, before)
    start = model.log_class(kind, features).mean()
    for _ in range(5):
        model.learn(kind, features, np.zeros_like(model.weights), np.zeros(len(model.weights), np.int64))
    assert model.log_class(kind, features).mean() > start
    each = np.array([np.exp(model.log_class(np.full(50, k), features[:50])) for k in range(lm.CLASSES)])
    assert each.sum(0) == pytest.approx(np.ones(50), abs=1e-4)
    shares = np.zeros(lm.CLASSES)
    classes = model.classes(own, kinds)
    np.add.at(shares, classes, np.where(classes <= lm.FREQUENT, 1, (counts + 0.1) / mass[classes]))
    shares[1 + lm.FREQUENT :] += 0.1 / mass[1 + lm.FREQUENT :]
    shares[0] = 1
    assert shares == pytest.approx(np.ones(lm.CLASSES))


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    """The same documents over 1, 4 and 64 partitions, with several learners, have the same scores; and something is learnt."""
    monkeypatch.setattr(lm, "LEARNER_BYTES", 400_000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = [{r.doc_id: (r.base_score, r.score, r.held_out, r.n_tokens) for r in lm_scores(docs.repartition(n)).collect()} for n in (1, 4, 64)]
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        assert all(abs(other[i][1] - x[1]) < 1e-6 * abs(x[1]) and abs(other[i][0] - x[0]) < 1e-6 * abs(x[0]) for i, x in found[0].items())
    held = [x for x in found[0].values() if x[2]]
    assert sum(x[1] - x[0] for x in held) / sum(x[3] for x in held) > 0.05


def test_updates_are_those_of_each_feature_by_itself():
    """Rows of one token, of a few and of more than ``RUN`` get the summed gradients of their tokens."""
    rng = np.random.default_rng(3)
    n = lm.UPDATE + 500
    kind = rng.integers(0, lm.CLASSES, n)
    features = (np.minimum(rng.zipf(1.4, (n, lm.FEATURES)), lm.BUCKETS) - 1).astype(np.int32) + np.arange(lm.FEATURES, dtype=np.int32) * lm.BUCKETS
    assert (np.bincount(features[: lm.UPDATE, 0]) > lm.RUN).any()
    model = lm.Model(1, 1, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.ones(lm.CLASSES))
    squares, seen = np.zeros_like(model.weights), np.zeros(len(model.weights), np.int64)
    model.learn(kind, features, squares, seen)
    weights, sums = np.zeros(model.weights.shape), np.zeros(model.weights.shape)
    for i in range(0, n, lm.UPDATE):
        own = features[i : i + lm.UPDATE]
        p = np.exp(weights[own].sum(1) + model.bias)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(p)), kind[i : i + lm.UPDATE]] -= 1
        step = np.zeros(weights.shape)
        np.add.at(step, own, p[:, None, :])
        sums += step * step
        weights -= lm.RATE * step / np.sqrt(sums + 1)
    assert np.allclose(model.weights, weights, atol=1e-4) and np.allclose(squares, sums, rtol=1e-3, atol=1e-4)
    assert (seen == np.bincount(features.ravel(), minlength=len(seen))).all()
