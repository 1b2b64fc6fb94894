"""MinHash groups against all pairs, and the bounds of sequential verification."""

import random
from collections import Counter

import numpy as np

from tessera.llm import verified
from tessera.llm.batches import word_hashes
from tessera.llm.minhash import least_matches, minhash_groups, signatures
from tests.llm.conftest import frame
from tests.llm.test_duplicates import edited, shingles


def expected(rows, percent=85):
    """``(id, n, component, kept)`` of each row by links of all pairs."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and part[a] != part[b]:
                old, new = part[a], part[b]
                part = [new if p == old else p for p in part]
    least = {}
    for p, (i, _) in zip(part, rows):
        least[p] = min((x for x in (least.get(p), i) if x is not None), default=None)
    return Counter((i, len(s), least[p], least[p] == i) for p, s, (i, _) in zip(part, sets, rows))


def found(spark, rows):
    return Counter(tuple(r) for r in minhash_groups(frame(spark, rows).repartition(3)).collect())


def test_odd_rows(spark, odd):
    assert found(spark, odd[0]) == expected(odd[0])


def test_edited_copies_and_templates(spark, monkeypatch):
    monkeypatch.setattr(verified, "TILE", 8)
    monkeypatch.setattr(verified, "TOGETHER", 3)
    rng = random.Random(31)
    draw = lambda n: [f"w{rng.randrange(10**5)}" for _ in range(n)]
    rows = []
    for i in range(50):
        text = draw(rng.randint(3, 200))
        rows += [(5 * i + k, edited(rng, text, rng.choice([0, 0.005, 0.01, 0.015, 0.02]))) for k in range(3)]
    template = draw(150)
    for i in range(40):
        tail = draw(60) if i % 2 == 0 else [*tail[:-1], "other"]
        rows.append((1000 - i, template + tail))
    rows += [(2000 + i, edited(rng, template, 0.01)) for i in range(40)]
    rng.shuffle(rows)
    rows = [(i, " ".join(t)) for i, t in rows]
    want = expected(rows)
    assert 60 < sum(k for (_, _, _, kept), k in want.items() if kept) < len(rows) - 40
    assert found(spark, rows) == want


def test_words_that_a_polynomial_hash_confuses(spark):
    """Two unlike words of 1,024 letters whose polynomial hashes modulo 2^64 agree under every odd base."""
    bits = [0]
    while len(bits) < 1024:
        bits += [1 - x for x in bits]
    one, two = ("".join(map(lambda x: "ab"[x ^ flip], bits)) for flip in (0, 1))
    data = np.frombuffer((one + two).encode(), np.uint8)
    for which in (0, 1):
        a, b = word_hashes(data, np.array([0, 1024]), np.array([1024, 2048]), which)
        assert a != b
    rows = [(1, " ".join(["x"] * 4 + [one])), (2, " ".join(["x"] * 4 + [two]))]
    assert found(spark, rows) == expected(rows)


def test_posterior_bounds():
    bounds = least_matches(0.85, 1e-9)
    assert [n for n, _ in bounds] == [32, 64, 96, 128, 160] and all(0 < m < n for n, m in bounds)
    rng = np.random.default_rng(1)
    for share, kept in ((0.85, True), (0.3, False)):
        matches = (rng.random((4000, 160)) < share).cumsum(1)
        alive = np.all([matches[:, n - 1] >= m for n, m in bounds], axis=0)
        assert alive.all() if kept else not alive.any()


def test_minima_estimate_the_index():
    rng = np.random.default_rng(6)
    members = rng.integers(0, 2**63, 1000).astype(np.uint64)
    a, b, none = signatures([np.sort(members[:850]), np.sort(members[150:]), np.zeros(0, np.uint64)])
    assert abs((a == b).mean() - 0.7) < 0.12 and (none == 2**32 - 1).all()


def test_no_rows(spark, none):
    empty = minhash_groups(none)
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]
