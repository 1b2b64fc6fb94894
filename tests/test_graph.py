import itertools

from pyspark.sql import functions as F

from tessera.operators import graph as gr


def _two_cliques(spark):
    edges = [(a, b) for s in (range(0, 6), range(6, 12)) for a, b in itertools.permutations(s, 2)] + [(5, 6), (6, 5)]
    return spark.createDataFrame(edges, "src bigint, dst bigint"), spark.range(13)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 160)]
    vertices = spark.range(31).unionByName(spark.range(100, 161))
    got = {r["id"]: r["component"] for r in gr.components(spark.createDataFrame(edges, "src bigint, dst bigint"), vertices).collect()}
    assert all(got[i] == 0 for i in range(31))
    assert all(got[i] == 100 for i in range(100, 160))
    assert got[160] == 160


def test_components_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(gr, "PIECE", 7)
    edges = [(3 * i, 3 * i + 3) for i in range(40)] + [(1, 301), (301, 4), (4, 1), (2, 2)]
    got = {r["id"]: r["component"] for r in gr.components(spark.createDataFrame(edges, "src bigint, dst bigint").repartition(9), spark.range(302)).collect()}
    assert len(got) == 302 and all(got[3 * i] == 0 for i in range(41))
    assert got[1] == got[301] == got[4] == 1 and got[2] == 2 and got[5] == 5


def test_communities_find_the_cliques(spark):
    edges, vertices = _two_cliques(spark)
    weighted = edges.withColumn("w", F.lit(1.0))
    found = gr.canonical_labels(gr.communities(weighted, vertices))
    got = {r["id"]: r["label"] for r in found.collect()}
    assert len({got[i] for i in range(6)}) == 1 and len({got[i] for i in range(6, 12)}) == 1
    assert got[0] == "0" and got[6] == "1" and got[12] == "2"
    one = vertices.select("id", F.lit(0).alias("label"))
    assert gr.modularity(weighted, found) > gr.modularity(weighted, one) - 1e-12


def test_graph_metrics(spark):
    edges, vertices = _two_cliques(spark)
    m = gr.graph_metrics(edges, vertices).first()
    assert (m["n_nodes"], m["n_edges"], m["connected_components"], m["median_degree"]) == (13, 31, 2, 5.0)


def _both_ways(spark, edges):
    return spark.createDataFrame(edges + [(b, a) for a, b in edges], "src bigint, dst bigint").withColumn("w", F.lit(1.0))


def _improving(edges, label):
    """Vertices that one move would better, by the definition of modularity."""
    around, m2 = {}, len(edges)
    for a, b in edges:
        around.setdefault(a, []).append(b)
    tot = {}
    for v, near in around.items():
        tot[label[v]] = tot.get(label[v], 0) + len(near)

    def worth(v, c):
        rest = tot[c] - len(around[v]) * (label[v] == c)
        return sum(label[u] == c for u in around[v]) - len(around[v]) * rest / m2

    return [v for v in around if any(worth(v, label[u]) > worth(v, label[v]) + 1e-9 for u in around[v])]


def test_communities_of_known_graphs(spark):
    """Four graphs as groups of one call: a grid, a ring of cliques, a star, and a vertex alone."""
    n, k, m = 4, 3, 4
    grid = [(i * n + j, i * n + j + 1) for i in range(n) for j in range(n - 1)] + [(i * n + j, i * n + n + j) for i in range(n - 1) for j in range(n)]
    ring = [(c * m + i, c * m + j) for c in range(k) for i in range(m) for j in range(i)] + [(c * m, (c + 1) % k * m + 1) for c in range(k)]
    star = [(0, i) for i in range(1, 12)]
    graphs = [grid, ring, star, []]
    edges = [(1000 * g + a, 1000 * g + b) for g, own in enumerate(graphs) for a, b in own]
    vertices = sorted({v for e in edges for v in e} | {3000})
    named = spark.createDataFrame([(v, v // 1000) for v in vertices], "id bigint, g bigint")
    rows = gr.communities(_both_ways(spark, edges), named, group="g").collect()
    label = {r["id"]: r["label"] for r in rows}
    assert len(rows) == len(label) == len(vertices)
    # The quarters of the grid, with 16 of 24 edges inside, have 0.417.
    both = [(a, b) for e in grid for a, b in (e, e[::-1])]
    tot = {}
    for a, _ in both:
        tot[label[a]] = tot.get(label[a], 0) + 1
    assert sum(label[a] == label[b] for a, b in both) / len(both) - sum((t / len(both)) ** 2 for t in tot.values()) >= 0.4
    assert _improving(both, label) == []
    assert all(len({label[1000 + c * m + i] for i in range(m)}) == 1 for c in range(k)) and len({label[1000 + v] for v in range(k * m)}) == k
    assert len({label[2000 + v] for v in range(12)}) == 1


def _grid(n):
    return [(i * n + j, i * n + j + 1) for i in range(n) for j in range(n - 1)] + [(i * n + j, i * n + n + j) for i in range(n - 1) for j in range(n)]


def test_communities_of_a_grid_over_many_blocks(spark, monkeypatch):
    """Blocks of a few vertices: what they settle is bettered across them, with frontiers of few vertices a block."""
    monkeypatch.setattr(gr, "BLOCK_EDGES", 120)
    monkeypatch.setattr(gr, "BLOCK_MOVERS", 8)
    grid = _grid(8)
    edges = _both_ways(spark, grid)
    found = gr.communities(edges, spark.range(64)).collect()
    label = {r["id"]: r["label"] for r in found}
    assert len(found) == len(label) == 64
    both = [(a, b) for e in grid for a, b in (e, e[::-1])]
    tot = {}
    for a, _ in both:
        tot[label[a]] = tot.get(label[a], 0) + 1
    assert sum(label[a] == label[b] for a, b in both) / len(both) - sum((t / len(both)) ** 2 for t in tot.values()) >= 0.55
    assert _improving(both, label) == []


def test_communities_of_a_grid(spark):
    edges = _both_ways(spark, _grid(10))
    assert gr.modularity(edges, gr.communities(edges, spark.range(100))) >= 0.63


def test_resolution_of_a_group(spark):
    """One graph twice, under resolutions that join and part its cliques."""
    edges, _ = _two_cliques(spark)
    pairs = [(r["src"], r["dst"]) for r in edges.collect()]
    both = spark.createDataFrame([(a + 100 * g, b + 100 * g) for a, b in pairs for g in (0, 1)], "src bigint, dst bigint").withColumn("w", F.lit(1.0))
    vertices = spark.createDataFrame([(v + 100 * g, g, (0.01, 1.0)[g]) for v in range(12) for g in (0, 1)], "id bigint, g int, r double")
    label = {r["id"]: r["label"] for r in gr.communities(both, vertices, "r", group="g").collect()}
    assert len({label[v] for v in range(12)}) == 1 and len({label[100 + v] for v in range(12)}) == 2


def test_graphs_that_fit_a_block_are_done_in_it(spark, monkeypatch):
    """Two grids, each more than a shared block: no table of moves is made, and no move of a vertex or of a community is better."""
    monkeypatch.setattr(gr, "SHARED_EDGES", 64)
    grid = _grid(9)
    edges = [(a + 1000 * g, b + 1000 * g) for g in (0, 1) for a, b in grid]
    named = spark.createDataFrame([(1000 * g + v, g) for g in (0, 1) for v in range(81)], "id bigint, g int")
    both = gr.cut(_both_ways(spark, edges))
    nodes = gr.cut(named.selectExpr("id", "g").join(both.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k")), "id").withColumn("two_m", F.lit(float(2 * len(grid)))))
    state, whole = gr._settled_blocks(both, nodes)
    assert whole and gr._wishes(both, state).isEmpty()
    above, parts = gr._merge(both, state)
    assert gr._wishes(above, parts.withColumn("label", F.col("id"))).isEmpty()

    def refuse(*_):
        raise AssertionError("moves as a table")

    monkeypatch.setattr(gr, "_wishes", refuse)
    got = {r["id"]: r["label"] for r in gr.communities(both, named, group="g").collect()}
    assert got == {r["id"]: r["label"] for r in state.select("id", "label").collect()} and len(got) == 162
