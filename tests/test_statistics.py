import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluate as ev
from tessera.operators import expression as ex
from tessera.operators import spatial_stats as sp
from tessera.operators import tiles
from tessera.runtime import number_rows
from tessera.sources.catalogue import apply_changes


def test_false_discovery(spark):
    p = np.random.default_rng(7).uniform(size=300) ** 2
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(p)], "id int, pvalue double")
    got = sp.false_discovery(df).toPandas().sort_values("id").qvalue.to_numpy()
    order = np.argsort(p)
    want = np.empty(300)
    want[order] = np.minimum.accumulate((p[order] * 300 / np.arange(1, 301))[::-1])[::-1]
    assert got == pytest.approx(np.minimum(want, 1))


def test_hypergeometric_tail(spark):
    df = spark.createDataFrame([(3, 20, 7, 5), (0, 20, 7, 5), (6, 20, 7, 5)], "k bigint, n bigint, m bigint, d bigint")
    got = [r[0] for r in df.select(sp.hypergeometric_tail("k", "n", "m", "d")).collect()]
    c = math.comb
    assert got == pytest.approx([sum(c(7, i) * c(13, 5 - i) for i in range(3, 6)) / c(20, 5), 1.0, 0.0])


def test_hypergeometric_tail_against_fractions():
    from fractions import Fraction

    rng = np.random.default_rng(0)
    rows = []
    for _ in range(200):
        n = int(rng.integers(2, 2500))
        m, d = int(rng.integers(0, n + 1)), int(rng.integers(0, n + 1))
        k = int(rng.integers(0, min(m, d) + 2))
        hits = sum(math.comb(m, i) * math.comb(n - m, d - i) for i in range(k, min(m, d) + 1))
        rows.append((k, n, m, d, float(Fraction(hits, math.comb(n, d)))))
    k, n, m, d, want = (pd.Series(v) for v in zip(*rows))
    got = sp.hypergeometric_tail.func(k, n, m, d)
    good = want > 1e-250
    assert got[good].to_numpy() == pytest.approx(want[good].to_numpy(), rel=1e-8)


def test_hypergeometric_tail_of_large_counts():
    """With an expected count of 10 the tail nears that of a Poisson variable as the population grows."""
    poisson = lambda k: math.exp(-10) * sum(10.0**i / math.factorial(i) for i in range(k, k + 200) if i < 170)
    for total in (10**9, 10**12, 10**15, 10**17, 10**18):
        drawn = math.isqrt(total)
        marked = total * 10 // drawn
        for k in (5, 15, 60):
            got = sp.hypergeometric_tail.func(*[pd.Series([v]) for v in (k, total, marked, drawn)])[0]
            assert got == pytest.approx(poisson(k), rel=2e-3 if total < 10**10 else 1e-4)
    # Both sides of the number of terms that are summed one by one.
    for spread in (200, 260, 10**4, 10**6):
        total = 4 * (4 * spread**2)
        x = total // 4 + spread
        got = sp.hypergeometric_tail.func(*[pd.Series([v]) for v in (x, total, total // 2, total // 2)])[0]
        sd = math.sqrt(total / 16)
        assert got == pytest.approx(0.5 * math.erfc((x - 0.5 - total / 4) / sd / math.sqrt(2)), rel=1e-3)


def test_colocalisation_of_rarely_shared_cells(spark):
    """A meets C in 40 cells, and B in one alone: the pairs of A with B are judged in that one."""
    rows = []
    for cell in range(40):
        rows += [(f"c{cell}", "A", 0.0, float(i)) for i in range(3)] + [(f"c{cell}", "C", 1.0, float(i)) for i in range(3)]
    rows += [("last", "A", 0.0, float(i)) for i in range(3)] + [("last", "B", 1.0, float(i)) for i in range(3)]
    t = spark.createDataFrame(rows, "cell_id string, gene string, x double, y double")
    got = {(r.gene_a, r.gene_b): r for r in sp.colocalisation(t).collect()}
    # In the last cell all 30 ordered pairs are near: 15 start at A, 9 of which end at B.
    for pair in (("A", "B"), ("B", "A")):
        r = got[pair]
        assert (r.n, r.expected) == (9, 15 * 15 / 30)
        c = math.comb
        assert r.pvalue == pytest.approx(sum(c(15, i) * c(15, 15 - i) for i in range(9, 16)) / c(30, 15))


def test_enrichment_matches_all_relabellings(spark):
    import itertools

    edges = [(0, 1), (1, 2), (2, 3), (3, 0), (0, 2), (3, 4)]
    both = edges + [(b, a) for a, b in edges]
    labels = "aabbb"
    got = sp.neighbourhood_enrichment(
        spark.createDataFrame(both, "src bigint, dst bigint"),
        spark.createDataFrame(list(enumerate(labels)), "cell_no bigint, cluster string"), empty=True,
    ).toPandas().set_index(["a", "b"])
    for pair in (("a", "a"), ("a", "b"), ("b", "b")):
        counts = [sum((l[i], l[j]) == pair for i, j in both) for l in itertools.permutations(labels)]
        observed = sum((labels[i], labels[j]) == pair for i, j in both)
        assert got.loc[pair, "z_score"] == pytest.approx((observed - np.mean(counts)) / np.std(counts))


def test_pair_histogram_with_copies_and_small_tiles(spark):
    rng = np.random.default_rng(8)
    xy = np.concatenate([rng.uniform(0, 10, (150, 2)), np.full((80, 2), 5.0)])
    pdf = pd.DataFrame({"x": xy[:, 0], "y": xy[:, 1], "cluster": rng.choice(list("ab"), 230)})
    edges = [-1.0, 0.0, 2.0, 4.0]
    got = sp.pair_histogram(spark.createDataFrame(pdf), edges, limit=16).toPandas()
    d = np.hypot(pdf.x.to_numpy()[:, None] - pdf.x.to_numpy(), pdf.y.to_numpy()[:, None] - pdf.y.to_numpy())
    np.fill_diagonal(d, np.inf)
    for r in got.itertuples():
        a, b = (pdf.cluster == r.a).to_numpy(), (pdf.cluster == r.b).to_numpy()
        part = d[np.ix_(a, b)]
        assert r.n == ((part > edges[r.interval]) & (part <= edges[r.interval + 1])).sum()
    assert got.n.sum() == (d <= 4.0).sum()


def test_rand_index_of_equal_labels(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "l string, r string")
    assert ev.adjusted_rand(df, "l", "r").first()[0] == 1.0


def test_silhouette_in_blocks_and_degenerate(spark):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.normal(0, 1, (30, 3)), rng.normal(4, 1, (30, 3))])
    df = spark.createDataFrame([(i, [float(a) for a in r], str(i // 30)) for i, r in enumerate(v)], "cell_id bigint, vector array<double>, label string")
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    own = np.arange(60) // 30
    a = np.array([d[i, own == own[i]].sum() / 29 for i in range(60)])
    b = np.array([d[i, own != own[i]].mean() for i in range(60)])
    assert ev.silhouette(df, "vector", "label", block=16).first()["value"] == pytest.approx(((b - a) / np.maximum(a, b)).mean())
    assert ev.silhouette(df.withColumn("label", F.lit("x")), "vector", "label").first()["value"] is None
    assert ev.silhouette_squared(df.withColumn("label", F.lit("x")), "vector", "label").first()["value"] is None


def test_silhouette_of_copies_rows_without_label_and_far_from_zero(spark):
    rng = np.random.default_rng(12)
    v = np.concatenate([rng.normal(1000, 1, (90, 3)), rng.normal(1003, 1, (50, 3))])
    v = np.concatenate([v, np.repeat(v[:20], 4, axis=0), v[90:100]])
    label = np.r_[np.arange(140) % 7 // 3, np.repeat(np.arange(20) % 7 // 3, 4), np.arange(10) % 2].astype(object)
    label[::11] = None
    df = spark.createDataFrame([(i, r.tolist(), None if c is None else str(c)) for i, (r, c) in enumerate(zip(v, label))], "cell_id bigint, vector array<double>, label string")
    d, total = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)), 0.0
    for i, c in enumerate(label):
        if c is not None:
            a = d[i, label == c].sum() / ((label == c).sum() - 1)
            b = min(d[i, label == o].mean() for o in (0, 1, 2) if o != c)
            total += (b - a) / max(a, b)
    for block in (8, 512):
        assert ev.silhouette(df, "vector", "label", block=block).first()["value"] == pytest.approx(total / len(v), abs=1e-12)


def test_components_recover_variance_and_sign(spark):
    rng = np.random.default_rng(10)
    v = rng.normal(size=(40, 4)) * [5, 2, 1, 0.1]
    df = spark.createDataFrame([(str(i), [float(a) for a in r]) for i, r in enumerate(v)], "cell_id string, vector array<double>")
    got = np.stack(ex.principal_components(df).orderBy(F.col("cell_id").cast("int")).toPandas().pcs.to_numpy())
    values = np.linalg.eigvalsh(np.cov(v.T))[::-1]
    assert got.var(axis=0, ddof=1) == pytest.approx(values[: got.shape[1]])


def test_tree_orders_a_line(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(60)], "cell_id bigint, pcs array<double>")
    nodes, placed = sp.principal_tree(df, k=6)
    time = placed.orderBy("cell_id").toPandas().pseudotime.to_numpy()
    steps = np.diff(time)
    assert nodes.filter("is_tip").count() == 2 and ((steps >= -1e-9).all() or (steps <= 1e-9).all())


def test_number_rows_is_dense(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    rows = number_rows(df, F.col("k")).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(1, 1001))
    assert [r["k"] for r in rows] == sorted(r["k"] for r in rows)


def test_changes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    changes = spark.createDataFrame([(1, None, "update"), (3, None, "delete"), (4, "d", "insert"), (9, "x", "update"), (2, "z", "insert")], "id int, v string, action string")
    assert sorted((r["id"], r["v"]) for r in apply_changes(rows, changes).fillna("-").collect()) == [(1, "-"), (2, "z"), (4, "d")]


def test_morans_i_without_edges_is_null(spark):
    values = spark.createDataFrame([(0, "A", 1.0), (1, "B", 2.0), (2, "A", 3.0)], "cell_no bigint, gene string, value double")
    cells = spark.createDataFrame([(i,) for i in range(4)], "cell_no bigint")
    none = spark.createDataFrame([], "src bigint, dst bigint, w double")
    got = sp.morans_i(values, none, cells).collect()
    assert sorted(r.gene for r in got) == ["A", "B"] and all(r.I is None and r.pval_norm is None for r in got)


def test_permuted_morans_i_in_blocks(spark, monkeypatch):
    """Permutations scored densely; blocks of 8 cells, one of them in parts."""
    monkeypatch.setattr(sp, "BLOCK_CELLS", 8)
    monkeypatch.setattr(sp, "whole_groups", lambda *a, **k: calls.append(k["n"]) or whole(*a, **k))
    calls, whole = [], tiles.whole_groups
    rng = np.random.default_rng(13)
    n, count, genes = 60, 7, 70
    x = np.where(rng.random((n, genes)) < 0.3, rng.random((n, genes)), 0.0)
    x[:30, 0], x[:, 1] = 5.0, 1.0
    w = np.where(rng.random((n, n)) < 0.1, rng.random((n, n)), 0.0)
    w[3] = rng.random(n)
    values = spark.createDataFrame([(int(i), f"g{j:02}", float(x[i, j])) for i, j in zip(*np.nonzero(x))], "cell_no bigint, gene string, value double")
    graph = spark.createDataFrame([(int(i), int(j), float(w[i, j])) for i, j in zip(*np.nonzero(w))], "src bigint, dst bigint, w double")
    cells = spark.range(n).withColumnRenamed("id", "cell_no")
    got = {r.gene: (r.I, r.pval_sim) for r in sp.permuted_morans_i(values, graph, cells, count).collect()}

    def score(x):
        z = x - x.mean(axis=0)
        return n / w.sum() * (z * (w @ z)).sum(0) / np.maximum((z * z).sum(0), 1e-300)

    h = cells.select("cell_no", *[F.xxhash64(F.col("cell_no").alias("id"), F.lit(p)).alias(f"h{p}") for p in range(count)]).toPandas()
    own, hits = score(x), np.ones(genes)
    for p in range(count):
        moved = x[h.sort_values([f"h{p}", "cell_no"]).cell_no.to_numpy()]
        hits += score(moved) >= own
    for j in range(genes):
        i, tail = got[f"g{j:02}"]
        if j == 1:
            assert i is None and tail is None
        else:
            assert i == pytest.approx(own[j]) and tail == pytest.approx(hits[j] / (count + 1))
    assert len(calls) == 1
