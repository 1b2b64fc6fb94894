"""Hard negatives against plain sorting of all scores."""

import math
import random

import numpy as np
import pytest

from tessera.llm import negatives
from tessera.llm.negatives import Index, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor long, score double, own string"


def expected(rows):
    held = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.zeros(6, np.int64)
        x[: len(v)] = [math.floor(256 * float(np.float32(y))) for y in v]
        held[i] = (x, (label + 1) % 10 if i % 7 == 0 else label)
    found = set()
    for a in sorted(held):
        if a % 100:
            continue
        score = {i: int(held[a][0] @ x) for i, (x, _) in held.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if held[i][1] == held[a][1]][:5]:
            fit = [i for i in order if held[i][1] != held[a][1] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            found |= {(a, p, k, i, score[p], score[i]) for k, i in enumerate(fit[:5], 1)}
    return found


@pytest.mark.parametrize("blocks", [(8192, 4096), (40, 3)])
def test_hard_negatives(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ROWS", blocks[0])
    monkeypatch.setattr(negatives, "ANCHORS", blocks[1])
    monkeypatch.setattr(negatives, "TOGETHER", 2)
    monkeypatch.setattr(negatives, "STRIDE", 2)
    rng = random.Random(5)
    draw = lambda scale=0.3: [rng.gauss(0, scale) for _ in range(6)]
    base = [draw() for _ in range(8)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in base[i % 8]], rng.randrange(4)) for i in range(-100, 500)]
    rows += [(i, base[1], i % 3) for i in range(500, 640)]  # ties
    rows += [(900, [0.0] * 6, 1), (1000, [], 2), (1001, [0.5], 2), (1100, [5000.0, -3.0, 200.0, 1.0, 0.0, 0.0], 3), (1101, [4000.0, 1.0, 0.0, 0.0, 0.0, 0.0], 3), (1102, [4500.0] + [0.0] * 5, 1)]
    rows += [(1200, draw(), 77), (1300, None, 1), (1301, [None] * 6, 1), (1302, [float("nan")] * 6, 1), (1400, [float("inf")] + [0.0] * 5, 1), (None, draw(), 1), (1500, draw(), None)]
    docs = spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in hard_negatives(docs).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    want = expected(rows)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_one_row_for_an_id_and_no_rows(spark):
    rows = [(100, [1.0, 0.0], 3), (100, [0.0, 1.0], 2), (1, [0.5, 1.0], 2), (2, [0.5, 0.9], 4)] * 2
    got = [tuple(r) for r in hard_negatives(spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], SCHEMA)).collect()]
    assert got == [(100, 1, 1, 2, 256 * 256, 256 * 230)]
    for some in ([], [(5, [1.0], 1)], [(100, [1.0], 1)]):
        assert hard_negatives(spark.createDataFrame([(*r, 1, 0.5, "x") for r in some], SCHEMA)).collect() == []


def test_index_leaves_dimensions_out_and_misses_nothing():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(0, 40, (300, 16)) * np.linspace(2, 0.1, 16))
    q = np.floor(rng.normal(0, 40, (20, 16)) * np.linspace(2, 0.1, 16))
    norms = np.sqrt((q * q).sum(1))
    for share in (0.0, 60.0, 150.0):
        index = Index(x, share)
        assert share == 0 or index.kept.sum() < x.size
        got = {(a, b): s for i, j, score in index.above(q, share * norms) for a, b, s in zip(i.tolist(), j.tolist(), score.tolist())}
        scores = q @ x.T
        assert got == {(a, b): scores[a, b] for a in range(20) for b in range(300) if scores[a, b] >= share * norms[a]}
