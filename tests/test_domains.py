import numpy as np
import pandas as pd
import pytest

from tessera.operators import domains as dm


def brute_dbscan(x, y, eps, least):
    near = [np.flatnonzero((x - a) ** 2 + (y - b) ** 2 <= eps * eps) for a, b in zip(x, y)]
    core = np.array([len(n) >= least for n in near])
    label = np.full(len(x), -1)
    k = 0
    for i in range(len(x)):
        if label[i] >= 0 or not core[i]:
            continue
        stack = [i]
        label[i] = k
        while stack:
            for j in near[stack.pop()]:
                if label[j] < 0:
                    label[j] = k
                    if core[j]:
                        stack.append(j)
        k += 1
    return ["noise" if v < 0 else str(v) for v in label]


@pytest.mark.parametrize("eps", [0.6, 1.3])
def test_dbscan(spark, eps):
    rng = np.random.default_rng(3)
    frames = []
    # Cell b holds most rows: a line of touching blobs, scattered points and a third at one place.
    b = np.concatenate([rng.normal((i * 2.2, i % 2), 0.35, (45, 2)) for i in range(6)] + [rng.uniform(-5, 20, (80, 2)), np.full((150, 2), 7.0)])
    for cell, xy in (("a", rng.uniform(0, 6, (70, 2))), ("b", b), ("c", rng.uniform(0, 1, (4, 2)))):
        frames.append(pd.DataFrame({"cell_id": cell, "x": xy[:, 0], "y": xy[:, 1]}))
    pdf = pd.concat(frames, ignore_index=True).sample(frac=1, random_state=0).reset_index(drop=True)
    pdf["row_id"] = range(len(pdf))
    got = dm.dbscan(spark.createDataFrame(pdf), eps, 6).toPandas().sort_values("row_id")
    for cell, part in pdf.groupby("cell_id"):
        want = ["0"] * len(part) if len(part) < 6 else brute_dbscan(part.x.to_numpy(), part.y.to_numpy(), eps, 6)
        assert got[got.cell_id == cell].subcellular_domain.tolist() == want


def test_hdbscan_finds_two_blobs(spark):
    rng = np.random.default_rng(4)
    xy = np.concatenate([rng.normal(0, 0.3, (60, 2)), rng.normal(8, 0.3, (60, 2)), [[4.0, 30.0]]])
    pdf = pd.DataFrame({"row_id": range(121), "cell_id": "a", "x": xy[:, 0], "y": xy[:, 1]})
    small = pd.DataFrame({"row_id": range(200, 205), "cell_id": "b", "x": 0.0, "y": np.arange(5.0)})
    got = dm.hdbscan(spark.createDataFrame(pd.concat([pdf, small])), 30, 5).toPandas().set_index("row_id").subcellular_domain.sort_index()
    assert set(got[:60]) <= {"0", "noise"} and (got[:60] == "0").mean() > 0.9
    assert set(got[60:120]) <= {"1", "noise"} and (got[60:120] == "1").mean() > 0.9
    assert got[120] == "noise"
    assert (got.loc[200:] == "0").all()


def test_weighted_locations_give_the_labels_of_their_points():
    rng = np.random.default_rng(11)
    base = np.concatenate([rng.normal(c, 0.5, (50, 2)) for c in ((0, 0), (6, 0), (6, 5))] + [rng.uniform(-4, 10, (20, 2))])
    weight = rng.integers(1, 4, len(base))
    full = np.repeat(base, weight, axis=0)
    d = np.sort(np.hypot(full[:, None, 0] - full[None, :, 0], full[:, None, 1] - full[None, :, 1]), axis=1)[:, 5]
    first = np.r_[0, np.cumsum(weight)[:-1]]

    def groups(labels):
        return {frozenset(np.flatnonzero(labels == c).tolist()) for c in set(labels.tolist()) - {-1}}

    points = dm._hierarchy(full[:, 0], full[:, 1], d, np.ones(len(full), int), 20)
    places = dm._hierarchy(base[:, 0], base[:, 1], d[first], weight, 20)
    assert len(groups(points)) == 3
    assert groups(points) == groups(np.repeat(places, weight))


def test_hdbscan_refuses_what_it_cannot_hold(spark):
    df = spark.createDataFrame([(i, "a", float(i), 0.0) for i in range(20)], "row_id bigint, cell_id string, x double, y double")
    with pytest.raises(ValueError):
        dm.hdbscan(df, largest=10)


def test_graph_domains(spark):
    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.normal(0, 1, (40, 2)), rng.normal(50, 1, (40, 2))])
    pdf = pd.DataFrame({"row_id": range(80), "cell_id": "a", "x": xy[:, 0], "y": xy[:, 1]})
    for made in (dm.graph_domains(spark.createDataFrame(pdf), 10), dm.phenograph_domains(spark.createDataFrame(pdf), 10, 5)):
        got = made.toPandas().set_index("row_id").subcellular_domain.sort_index()
        assert len(got) == 80 and not set(got[:40]) & set(got[40:]) - {"-1"}


def test_domain_count():
    assert [dm.domain_count(n) for n in (1, 16, 100, 10**6)] == [2, 4, 7, 12]


def test_first_resolution_that_gives_the_count(spark):
    cliques = [(6 * c + i, 6 * c + j) for c in range(4) for i in range(6) for j in range(6) if i != j]
    chain = [(6 * c + a, 6 * c + b) for c in range(3) for a, b in ((5, 6), (6, 5))]
    graph = spark.createDataFrame(cliques + chain, "src bigint, dst bigint")
    found, resolution = dm.communities_for_count(graph, spark.range(24), 4, step=0.1, together=16)
    rows = found.collect()
    assert len(rows) == 24 and len({r["label"] for r in rows}) == 4 and 0.1 <= resolution <= 3.0
    none, lowest = dm.communities_for_count(graph, spark.range(24), 23, step=0.5, together=3)
    assert none.count() == 24 and lowest in (0.1, 0.6, 1.1, 1.6, 2.1, 2.6)


def test_graphs_of_cells_in_tasks_are_those_of_tables(spark, monkeypatch):
    """Cells on a small grid with many ties and copies, one too large for a task, one too small for domains, rows without a place."""
    rng = np.random.default_rng(12)
    frames = [pd.DataFrame({"cell_id": c, "x": rng.integers(0, s, n).astype(float), "y": rng.integers(0, 9, n).astype(float)}) for c, n, s in (("a", 70, 9), ("b", 90, 12), ("c", 4, 3), ("d", 130, 30))]
    pdf = pd.concat(frames, ignore_index=True)
    pdf["row_id"] = rng.permutation(len(pdf))
    pdf.loc[3, "x"] = None
    t = spark.createDataFrame(pdf.replace({np.nan: None}).astype({"row_id": "int64"}), "cell_id string, x double, y double, row_id bigint")
    for make in (lambda: dm.graph_domains(t, 6, 0.5), lambda: dm.phenograph_domains(t, 7, 5)):
        got = []
        for whole in (0, 100, 1000):
            monkeypatch.setattr(dm, "WHOLE", whole)
            got.append({r["row_id"]: (r["cell_id"], r["subcellular_domain"]) for r in make().collect()})
        assert len(got[0]) == len(pdf) and len(set(got[0].values())) > 6
        assert got[0] == got[1] == got[2]


def test_small_cells_make_no_table_of_shared_neighbours(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("pairs of neighbours as a table")

    monkeypatch.setattr(dm, "jaccard_graph", refuse)
    monkeypatch.setattr(dm, "communities", refuse)
    rows = spark.range(200).selectExpr("id AS row_id", "cast(id % 4 AS string) AS cell_id", "cast(id % 13 AS double) AS x", "cast(id % 11 AS double) AS y")
    assert dm.phenograph_domains(rows, 8, 4).count() == dm.graph_domains(rows, 8).count() == 200
