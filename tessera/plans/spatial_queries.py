"""Queries over space: domains, subcellular domains, spatial statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import domains as dm
from tessera.operators import evaluate as ev
from tessera.operators import expression as ex
from tessera.operators import neighbours as nb
from tessera.operators import spatial_stats as sp
from tessera.operators.graph import communities, components, modularity
from tessera.operators.transcripts import distribution
from tessera.plans.cell_queries import _pcs
from tessera.plans.inputs import ORACLES, QUERIES, Inputs, query, r6
from tessera.sources import sinks
from tessera.runtime import cut, new_path


@query("domains_kmeans")
def domains_kmeans(t: Inputs):
    return dm.spatial_kmeans(t.cells())


@query("domains_graph")
def domains_graph(t: Inputs):
    return dm.spatial_communities(t.graph(), t.cells())


def _eight(t: Inputs):
    def make():
        found, resolution = dm.communities_for_count(t.graph(), t.cells(), 8, id="cell_no")
        return found.withColumn("resolution", F.lit(resolution))

    return t.kept("eight_domains", make)


@query("domains_for_count")
def domains_for_count(t: Inputs):
    """Communities at the first resolution that gives eight domains."""
    return _eight(t)


@query(
    "domains_for_count_properties",
    "SELECT count(*) AS n_cells, count(*) AS n_labelled, 1::BIGINT AS n_resolutions, true AS on_ladder FROM cells",
)
def domains_for_count_properties(t: Inputs):
    """Each cell once and with a domain, and one resolution of the ladder."""
    r = F.max("resolution")
    return _eight(t).agg(
        F.countDistinct("id").alias("n_cells"), F.count("label").alias("n_labelled"), F.countDistinct("resolution").alias("n_resolutions"),
        ((r >= 0.1) & (r <= 3.0) & (F.abs(r * 100 - F.round(r * 100)) < 1e-6)).alias("on_ladder"),
    )


@query(
    "domain_summary",
    "SELECT spatial_domain AS value, count(*) AS n FROM cells GROUP BY 1",
)
def domain_summary(t: Inputs):
    return distribution(t.cells(), "spatial_domain")


@query("subcellular_none", "SELECT cell_id, row_id, '0' AS subcellular_domain FROM seg")
def subcellular_none(t: Inputs):
    return dm.no_domains(t.numbered().filter("cell_id is not null")).select("cell_id", "row_id", "subcellular_domain")


@query(
    "subcellular_dbscan",
    """WITH RECURSIVE core AS (SELECT a.cell_id, a.x, a.y, min(a.row_id) AS first FROM
        (SELECT DISTINCT cell_id, x, y, row_id FROM seg) a JOIN
        (SELECT p.cell_id, p.x, p.y FROM (SELECT DISTINCT cell_id, x, y FROM seg) p JOIN seg q ON p.cell_id = q.cell_id
          AND (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 9 GROUP BY 1, 2, 3 HAVING count(*) >= 9) k
        ON a.cell_id = k.cell_id AND a.x = k.x AND a.y = k.y GROUP BY 1, 2, 3),
    link AS MATERIALIZED (SELECT a.first AS src, b.first AS dst FROM core a JOIN core b ON a.cell_id = b.cell_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 9),
    reach AS (SELECT first AS id, first AS root FROM core UNION SELECT link.dst, r.root FROM reach r JOIN link ON r.id = link.src WHERE r.root < link.dst),
    comp AS MATERIALIZED (SELECT core.*, m.root, dense_rank() OVER (PARTITION BY cell_id ORDER BY m.root) - 1 AS k FROM core JOIN (SELECT id, min(root) AS root FROM reach GROUP BY 1) m ON core.first = m.id),
    near AS (SELECT s.row_id, min(k) AS k FROM seg s JOIN comp c ON s.cell_id = c.cell_id AND (s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y) <= 9 GROUP BY 1),
    own AS (SELECT s.row_id, c.k FROM seg s JOIN comp c ON s.cell_id = c.cell_id AND s.x = c.x AND s.y = c.y)
    SELECT s.cell_id, s.row_id, CASE WHEN z.n < 9 THEN '0' ELSE coalesce(CAST(coalesce(own.k, near.k) AS VARCHAR), 'noise') END AS subcellular_domain
    FROM seg s JOIN (SELECT cell_id, count(*) AS n FROM seg GROUP BY 1) z ON s.cell_id = z.cell_id
    LEFT JOIN own ON s.row_id = own.row_id LEFT JOIN near ON s.row_id = near.row_id""",
)
def subcellular_dbscan(t: Inputs):
    """Density clusters inside each cell, at a radius that leaves several of them."""
    return _dbscan(t).select("cell_id", "row_id", "subcellular_domain")


def _dbscan(t: Inputs):
    return t.kept("dbscan", lambda: dm.dbscan(t.numbered(), 3.0, 9))


@query("subcellular_hdbscan")
def subcellular_hdbscan(t: Inputs):
    return dm.hdbscan(t.numbered(), 30, 5).select("cell_id", "row_id", "subcellular_domain")


@query("subcellular_graph")
def subcellular_graph(t: Inputs):
    return dm.graph_domains(t.numbered()).select("cell_id", "row_id", "subcellular_domain")


@query("subcellular_phenograph")
def subcellular_phenograph(t: Inputs):
    return dm.phenograph_domains(t.numbered()).select("cell_id", "row_id", "subcellular_domain")


_LABELLED = "WITH d AS (SELECT cell_id, CASE WHEN fov = 6 OR x % 100 > 45 THEN 'noise' ELSE CAST(CAST(y AS BIGINT) % 3 AS VARCHAR) END AS dom FROM seg)"
_STATS = _LABELLED + """, g AS (SELECT cell_id, dom, count(*) AS n FROM d GROUP BY 1, 2),
    s AS (SELECT cell_id, count(*) FILTER (WHERE dom <> 'noise') AS n_subcellular_domains, CAST(coalesce(sum(n) FILTER (WHERE dom = 'noise'), 0) AS BIGINT) AS n_noise,
      string_agg(dom || ':' || CAST(n AS VARCHAR), ',' ORDER BY dom) AS subcellular_domain_distribution FROM g GROUP BY 1)"""


def _labelled(t: Inputs):
    return t.segmented().withColumn(
        "subcellular_domain",
        F.when((F.col("fov") == 6) | (F.col("x") % 100 > 45), "noise").otherwise((F.col("y").cast("bigint") % 3).cast("string")),
    )


@query("subcellular_stats", _STATS + " SELECT * FROM s")
def subcellular_stats(t: Inputs):
    return dm.subcellular_stats(_labelled(t))


@query(
    "subcellular_summary",
    _STATS
    + """ SELECT 'dbscan' AS subcellular_spatial_domain_backend, count(*) AS n_cells_processed, count(*) FILTER (WHERE n_subcellular_domains >= 2) AS n_cells_with_multiple_domains,
    round(count(*) FILTER (WHERE n_subcellular_domains >= 2) / CAST(count(*) AS DOUBLE), 4) AS fraction_multi_domain, round(avg(n_subcellular_domains), 3) AS mean_domains_per_cell,
    CAST(sum(n_noise) AS BIGINT) AS total_noise_transcripts FROM s""",
)
def subcellular_summary(t: Inputs):
    return dm.subcellular_summary(dm.subcellular_stats(_labelled(t)), "dbscan")


@query(
    "evaluate_subcellular",
    _STATS
    + """ SELECT count(*) FILTER (WHERE n_subcellular_domains > 1) AS n_cells_with_multiple_domains, round(avg(CASE WHEN n_subcellular_domains > 1 THEN 1.0 ELSE 0.0 END), 9) AS fraction_multi_domain,
    round(avg(n_subcellular_domains), 9) AS mean_domains_per_cell,
    (SELECT count(*) FROM d WHERE cell_id IN (SELECT cell_id FROM s WHERE n_subcellular_domains > 1)) AS n_transcripts_in_multi_domain_cells FROM s""",
)
def evaluate_subcellular(t: Inputs):
    labelled = _labelled(t)
    e = ev.evaluate_subcellular(dm.subcellular_stats(labelled), labelled)
    return e.withColumns({"fraction_multi_domain": r6("fraction_multi_domain", 9), "mean_domains_per_cell": r6("mean_domains_per_cell", 9)})


_MORAN = """WITH w AS (SELECT g.src, g.dst, 1.0 / d.k AS w FROM graph g JOIN (SELECT src, count(*) AS k FROM graph GROUP BY 1) d ON g.src = d.src),
    genes AS (SELECT DISTINCT gene FROM lognorm), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cells),
    x AS (SELECT c.cell_no AS id, genes.gene, coalesce(l.v, 0) AS v FROM cells c CROSS JOIN genes LEFT JOIN lognorm l ON l.cell_id = c.cell_id AND l.gene = genes.gene),
    z AS (SELECT id, x.gene, v - m AS z FROM x JOIN (SELECT gene, avg(v) AS m FROM x GROUP BY 1) a ON x.gene = a.gene),
    num AS (SELECT a.gene, sum(w * a.z * b.z) AS c FROM w JOIN z a ON w.src = a.id JOIN z b ON w.dst = b.id AND a.gene = b.gene GROUP BY 1),
    den AS (SELECT gene, sum(z * z) AS q FROM z GROUP BY 1),
    i AS (SELECT num.gene, n / (SELECT sum(w) FROM w) * c / q AS I FROM num JOIN den ON num.gene = den.gene, n),
    sym AS (SELECT src, dst, sum(w) AS t FROM (SELECT src, dst, w FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY 1, 2),
    s AS (SELECT (SELECT sum(w) FROM w) AS s0, (SELECT sum(t * t) / 2 FROM sym) AS s1, (SELECT sum(k * k) FROM (SELECT sum(t) AS k FROM sym GROUP BY src)) AS s2),
    v AS (SELECT (n * n * s1 - n * s2 + 3 * s0 * s0) / ((n * n - 1) * s0 * s0) - 1 / ((n - 1) * (n - 1)) AS var, -1 / (n - 1) AS e FROM s, n)"""


def _moran(t: Inputs):
    number = t.cells().select("cell_id", "cell_no")
    values = ex.lognorm(t.counts()).join(number, "cell_id").select("cell_no", "gene", "value")
    return values, sp.row_standardised(t.graph()), t.cells()


@query("morans_i", _MORAN + ' SELECT gene, round(I, 8) AS "I", round((I - e) / sqrt(var), 6) AS z_norm FROM i, v')
def morans_i(t: Inputs):
    return sp.morans_i(*_moran(t)).select("gene", r6("I", 8).alias("I"), r6("z_norm").alias("z_norm"))


@query("morans_i_pvalues")
def morans_i_pvalues(t: Inputs):
    return sp.morans_i(*_moran(t)).select("gene", "pval_norm")


@query("morans_i_permuted")
def morans_i_permuted(t: Inputs):
    return sp.permuted_morans_i(*_moran(t))


@query("top_spatial_genes", _MORAN + ' SELECT gene, round(I, 8) AS "I", (SELECT count(*) FROM i) AS n_tested FROM i ORDER BY I DESC LIMIT 100')
def top_spatial_genes(t: Inputs):
    return sp.top_spatial_genes(sp.morans_i(*_moran(t))).select("gene", r6("I", 8).alias("I"), "n_tested")


_ENRICH = """WITH k AS (SELECT cluster, CAST(count(*) AS DOUBLE) AS n FROM cells GROUP BY 1),
    deg AS (SELECT sum(d) AS s0, sum(d * (d - 1)) AS q FROM (SELECT CAST(count(*) AS DOUBLE) AS d FROM graph GROUP BY src)),
    tot AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM cells),
    o AS (SELECT a.cluster AS a, b.cluster AS b, count(*) AS c FROM graph g JOIN cells a ON g.src = a.cell_no JOIN cells b ON g.dst = b.cell_no GROUP BY 1, 2),
    p AS (SELECT x.cluster AS a, y.cluster AS b, x.n AS na, y.n AS nb, coalesce(o.c, 0) AS c FROM k x CROSS JOIN k y LEFT JOIN o ON o.a = x.cluster AND o.b = y.cluster),
    m AS (SELECT p.*, s0, q, s0 * s0 - 2 * s0 - 4 * q AS r,
      CASE WHEN a = b THEN na * (na - 1) ELSE na * nb END / (n * (n - 1)) AS p2,
      CASE WHEN a = b THEN 4 * na * (na - 1) * (na - 2) ELSE na * nb * (nb - 1) + nb * na * (na - 1) END / (n * (n - 1) * (n - 2)) AS p3,
      CASE WHEN a = b THEN na * (na - 1) * (na - 2) * (na - 3) ELSE na * (na - 1) * nb * (nb - 1) END / (n * (n - 1) * (n - 2) * (n - 3)) AS p4 FROM p, deg, tot)"""


@query(
    "neighbourhood_enrichment",
    _ENRICH
    + """ SELECT a, b, c AS "count", round(s0 * p2, 6) AS expected,
    round((c - s0 * p2) / sqrt(s0 * CASE WHEN a = b THEN 2 ELSE 1 END * p2 + q * p3 + r * p4 - s0 * p2 * s0 * p2), 6) AS z_score FROM m""",
)
def neighbourhood_enrichment(t: Inputs):
    e = sp.neighbourhood_enrichment(t.graph(), t.cells(), empty=True)
    return e.select("a", "b", "count", r6("expected").alias("expected"), r6("z_score").alias("z_score"))


_OCC = """WITH e AS (SELECT sqrt((max(x) - min(x)) * (max(x) - min(x)) + (max(y) - min(y)) * (max(y) - min(y))) / 50 AS width FROM cells),
    d AS (SELECT a.cluster AS a, b.cluster AS b, least(49, CAST(ceil(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / width) - 1 AS INTEGER)) AS "interval"
      FROM cells a JOIN cells b ON a.cell_no <> b.cell_no CROSS JOIN e),
    n AS (SELECT "interval", a, b, count(*) AS n FROM d WHERE "interval" >= 0 GROUP BY 1, 2, 3)"""


@query("pair_histogram", _OCC + ' SELECT "interval", a, b, n FROM n')
def pair_histogram(t: Inputs):
    """Pairs of cells by label and distance, over the whole extent."""
    return sp.pair_histogram(t.cells(), sp.distance_edges(t.cells())).select("interval", "a", "b", "n")


@query(
    "co_occurrence",
    _OCC
    + """ SELECT n."interval", a, b, n, round((n / CAST(sum(n) OVER (PARTITION BY "interval", a) AS DOUBLE)) / (sum(n) OVER (PARTITION BY "interval", b) / CAST(sum(n) OVER (PARTITION BY "interval") AS DOUBLE)), 8) AS ratio FROM n""",
)
def co_occurrence(t: Inputs):
    return sp.co_occurrence(t.cells()).withColumn("ratio", r6("ratio", 8))


@query(
    "radial_distance",
    """SELECT s.cell_id, round(avg(sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y))), 6) AS mean_rna_radial_distance,
    round(max(sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y))), 6) AS max_radial_distance FROM seg s JOIN cells c ON s.cell_id = c.cell_id GROUP BY 1""",
)
def radial_distance(t: Inputs):
    d = sp.radial_distance(t.segmented(), t.cells())
    return d.select("cell_id", r6("mean_rna_radial_distance").alias("mean_rna_radial_distance"), r6("max_radial_distance").alias("max_radial_distance"))


@query(
    "radial_distance_nuclear",
    """SELECT s.cell_id, round(avg(sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y))), 6) AS mean_rna_radial_distance FROM seg s
    JOIN (SELECT cell_id, avg(x) AS x, avg(y) AS y FROM seg WHERE CellComp = 'Nuclear' GROUP BY 1) c ON s.cell_id = c.cell_id GROUP BY 1""",
)
def radial_distance_nuclear(t: Inputs):
    d = sp.radial_distance(t.segmented(), t.cells(), of="nuclear")
    return d.select("cell_id", r6("mean_rna_radial_distance").alias("mean_rna_radial_distance"))


@query(
    "radial_summary",
    """SELECT count(d) AS n_cells_analyzed, round(avg(coalesce(d, 0)), 6) AS mean_distance_overall FROM cells k LEFT JOIN
    (SELECT s.cell_id, avg(sqrt((s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y))) AS d FROM seg s JOIN cells c ON s.cell_id = c.cell_id WHERE CAST(s.cell_id AS BIGINT) % 3 > 0 GROUP BY 1) r ON k.cell_id = r.cell_id""",
)
def radial_summary(t: Inputs):
    """Cells of every third supplier lose their transcripts and count as 0."""
    some = t.segmented().filter("cast(cell_id as bigint) % 3 > 0")
    s = sp.radial_summary(t.cells(), sp.radial_distance(some, t.cells()))
    return s.withColumn("mean_distance_overall", r6("mean_distance_overall"))


@query(
    "compartment_ratio",
    """SELECT cell_id, count(*) FILTER (WHERE CellComp = 'Cytoplasm') AS n_cytoplasm, count(*) FILTER (WHERE CellComp = 'Nuclear') AS n_nuclear,
    round(count(*) FILTER (WHERE CellComp = 'Cytoplasm') / CAST(count(*) FILTER (WHERE CellComp = 'Nuclear') AS DOUBLE), 9) AS radial_ratio FROM seg GROUP BY 1""",
)
def compartment_ratio(t: Inputs):
    return sp.compartment_ratio(t.segmented()).withColumn("radial_ratio", r6("radial_ratio", 9))


@query(
    "pairs_within_radius",
    """SELECT a.cell_id, a.row_id AS row_id_a, b.row_id AS row_id_b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS dist
    FROM seg a JOIN seg b ON a.cell_id = b.cell_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 17""",
)
def pairs_within_radius(t: Inputs):
    return nb.pairs_within(t.numbered(), 4.16).withColumn("dist", r6("dist"))


@query(
    "gene_pair_counts",
    """SELECT a.gene AS gene_a, b.gene AS gene_b, count(*) AS n FROM seg a JOIN seg b ON a.cell_id = b.cell_id AND a.row_id <> b.row_id
    AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 17 GROUP BY 1, 2""",
)
def gene_pair_counts(t: Inputs):
    return sp.gene_pair_counts(t.segmented())


@query(
    "gene_pair_counts_nine_grid",
    """SELECT a.gene AS gene_a, b.gene AS gene_b, count(*) AS n FROM seg a JOIN seg b ON a.cell_id = b.cell_id AND a.row_id <> b.row_id
    AND abs(floor(a.x / 4.16) - floor(b.x / 4.16)) <= 1 AND abs(floor(a.y / 4.16) - floor(b.y / 4.16)) <= 1 GROUP BY 1, 2""",
)
def gene_pair_counts_nine_grid(t: Inputs):
    return sp.gene_pair_counts(t.segmented(), mode="nine_grid")


@query(
    "colocalisation_expected",
    """WITH c AS (SELECT cell_id, gene, count(*) AS c FROM seg GROUP BY 1, 2), z AS (SELECT cell_id, count(*) AS s FROM seg GROUP BY 1),
    n AS (SELECT a.cell_id, a.gene AS gene_a, b.gene AS gene_b, count(*) AS n FROM seg a JOIN seg b ON a.cell_id = b.cell_id AND a.row_id <> b.row_id
      AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 17 GROUP BY 1, 2, 3),
    p AS (SELECT gene_a, gene_b, sum(n) AS n FROM n GROUP BY 1, 2),
    holding AS (SELECT p.gene_a, p.gene_b, l.cell_id, r.c, z.s FROM p JOIN c l ON l.gene = p.gene_a JOIN c r ON r.gene = p.gene_b AND r.cell_id = l.cell_id JOIN z ON z.cell_id = l.cell_id),
    near AS (SELECT cell_id, gene_a, sum(n) AS reach FROM n GROUP BY 1, 2)
    SELECT p.gene_a, p.gene_b, CAST(max(p.n) AS BIGINT) AS n, round(CAST(sum(coalesce(reach, 0)) AS DOUBLE) * CAST(sum(h.c * (h.s - 1)) AS DOUBLE) / CAST(sum(h.s * (h.s - 1)) AS DOUBLE), 5) AS expected
    FROM p JOIN holding h ON p.gene_a = h.gene_a AND p.gene_b = h.gene_b LEFT JOIN near ON near.cell_id = h.cell_id AND near.gene_a = p.gene_a GROUP BY 1, 2""",
)
def colocalisation_expected(t: Inputs):
    return _coloc(t).select("gene_a", "gene_b", "n", r6("expected", 5).alias("expected"))


def _coloc(t: Inputs):
    return t.kept("colocalisation", lambda: sp.colocalisation(t.segmented()))


@query("colocalisation")
def colocalisation(t: Inputs):
    """Gene pairs with enrichment, probability and adjusted probability."""
    return _coloc(t)


@query("colocalisation_all_background")
def colocalisation_all_background(t: Inputs):
    return sp.colocalisation(t.segmented(), background="all")


@query("tree_milestones")
def tree_milestones(t: Inputs):
    return sp.principal_tree(t.embeddings(), "vector")[0]


@query("pseudotime")
def pseudotime(t: Inputs):
    return sp.principal_tree(t.embeddings(), "vector")[1]


@query("pseudotime_range")
def pseudotime_range(t: Inputs):
    return sp.pseudotime_range(sp.principal_tree(t.embeddings(), "vector")[1])


@query("modularity_of_labels", """WITH m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM graph), e AS (SELECT a.cluster AS a, b.cluster AS b FROM graph g JOIN cells a ON g.src = a.cell_no JOIN cells b ON g.dst = b.cell_no),
    s AS (SELECT a, count(*) AS tot, count(*) FILTER (WHERE a = b) AS w FROM e GROUP BY 1) SELECT round(sum(w) / max(m) - sum(tot * tot) / (max(m) * max(m)), 9) AS q FROM s, m""")
def modularity_of_labels(t: Inputs):
    """Quality of the given cluster labels on the neighbour graph."""
    q = modularity(t.graph().withColumn("w", F.lit(1.0)), t.cells().select(F.col("cell_no").alias("id"), F.col("cluster").alias("label")))
    return t.spark.range(1).select(r6(F.lit(q), 9).alias("q"))


_PARTS = {
    "svg": ("morans_i", 'gene, NULL, NULL, "I"'),
    "neighbourhood": ("neighbourhood_enrichment", 'a, b, NULL, "count"'),
    "co_occurrence": ("co_occurrence", 'a, b, "interval", ratio'),
    "rna_localization": ("radial_distance", "cell_id, NULL, NULL, mean_rna_radial_distance"),
    "colocalisation": ("colocalisation_expected", "gene_a, gene_b, NULL, n"),
}


@query(
    "spatial_results_sink",
    " UNION ALL ".join(
        f"SELECT '{part}' AS part, CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, CAST(coalesce(i, -1) AS INTEGER) AS \"interval\", round(CAST(value AS DOUBLE), 4) AS value "
        f"FROM (SELECT {columns} FROM ({ORACLES[name]})) q(a, b, i, value)"
        for part, (name, columns) in _PARTS.items()
    ),
)
def spatial_results_sink(t: Inputs):
    """All parts of the spatial and subcellular results, each written as JSON and read back (interval -1: the part has none)."""
    folder = new_path(t.spark, "results")
    made = {part: QUERIES[name](t.spark, t.folder) for part, (name, _) in _PARTS.items()}
    paths = sinks.write_results(made, folder)
    whole = None
    for part, (_, columns) in _PARTS.items():
        own = t.spark.read.schema(made[part].schema).json(paths[part])
        a, b, i, value = (F.lit(None) if c.strip() == "NULL" else F.col(c.strip().strip('"')) for c in columns.split(","))
        rows = own.select(F.lit(part).alias("part"), a.cast("string").alias("a"), b.cast("string").alias("b"), F.coalesce(i.cast("int"), F.lit(-1)).alias("interval"), F.round(value.cast("double"), 4).alias("value"))
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


@query("community_properties", "SELECT (SELECT count(*) FROM cells) AS n_cells, (SELECT count(*) FROM cells) AS n_labelled, 0::BIGINT AS better_moves, 0::BIGINT AS parted")
def community_properties(t: Inputs):
    """Communities of the neighbour graph: each cell has one, none is in parts, and no move of a cell is better."""
    graph = t.graph().select("src", "dst", F.lit(1.0).alias("w"))
    cells = t.cells().select(F.col("cell_no").alias("id"))
    label = cut(communities(graph, cells))
    ends = graph.join(label.select(F.col("id").alias("src"), F.col("label").alias("a")), "src").join(
        label.select(F.col("id").alias("dst"), F.col("label").alias("b")), "dst"
    )
    degree = graph.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("k"))
    tot = ends.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("tot"))
    to = ends.groupBy(F.col("src").alias("id"), "a", "b").agg(F.count("*").alias("to")).join(degree, "id").join(tot, "b")
    edges = graph.agg(F.count("*").alias("m2"))
    rest = F.col("tot") - F.when(F.col("a") == F.col("b"), F.col("k")).otherwise(F.lit(0))
    worth = to.crossJoin(edges).withColumn("worth", F.col("to") - F.col("k") * rest / F.col("m2"))
    # A cell that has no neighbour in its own community is worth less there than nothing.
    own = label.join(degree, "id").join(tot.withColumnRenamed("b", "label"), "label").crossJoin(edges).select(
        "id", (-F.col("k") * (F.col("tot") - F.col("k")) / F.col("m2")).alias("alone")
    )
    best = worth.groupBy("id").agg(F.max("worth").alias("best"), F.max(F.when(F.col("a") == F.col("b"), F.col("worth"))).alias("here"))
    better = best.join(own, "id").filter(F.col("best") > F.coalesce("here", "alone") + 1e-9).agg(F.count("*").alias("better_moves"))
    parts = components(ends.filter("a = b").select("src", "dst"), label).select("component").distinct().agg(F.count("*").alias("parts"))
    counts = label.agg(F.countDistinct("id").alias("n_labelled"), F.countDistinct("label").alias("n"))
    total = cells.agg(F.count("*").alias("n_cells"))
    # Four tables of one row each.
    return total.crossJoin(counts).crossJoin(better).crossJoin(parts).select("n_cells", "n_labelled", "better_moves", (F.col("parts") - F.col("n")).alias("parted"))
