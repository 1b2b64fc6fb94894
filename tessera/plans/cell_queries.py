"""Queries over cells: counts, quality control, graphs, expression, annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.contracts import check_input, contract_violations as violations
from tessera.operators import cells as ce
from tessera.operators import evaluate as ev
from tessera.operators import expression as ex
from tessera.operators import graph as gr
from tessera.operators import neighbours as nb
from tessera.operators.transcripts import denoise, distribution
from tessera.plans.inputs import Inputs, query, r6
from tessera.runtime import cut, new_path
from tessera.sources import sinks


@query("cell_gene_counts", 'SELECT cell_id, gene, n AS "count" FROM counts')
def cell_gene_counts(t: Inputs):
    return t.counts()


@query(
    "cell_summary",
    """SELECT cell_id, count(*) AS n_transcripts, count(DISTINCT gene) AS n_genes, round(avg(x), 6) AS x, round(avg(y), 6) AS y,
    arg_min(fov, row_id) AS fov FROM seg GROUP BY cell_id""",
)
def cell_summary(t: Inputs):
    s = ce.cell_summary(t.numbered())
    return s.withColumns({"x": r6("x"), "y": r6("y")})


@query("cell_centroids", "SELECT round(x, 6) AS x, round(y, 6) AS y, cell_id FROM cells")
def cell_centroids(t: Inputs):
    return ce.centroid_points(t.cells()).select(r6("x").alias("x"), r6("y").alias("y"), "cell_id")


@query("qc_per_cell", "SELECT cell_id, CAST(sum(n) AS BIGINT) AS total_counts, count(*) AS n_genes_by_counts FROM counts GROUP BY 1")
def qc_per_cell(t: Inputs):
    return ce.qc_per_cell(t.counts())


@query(
    "qc_per_gene",
    """SELECT gene, count(*) AS n_cells_by_counts, round(sum(n) / CAST((SELECT count(DISTINCT cell_id) FROM counts) AS DOUBLE), 6) AS mean_counts,
    round((1 - count(*) / CAST((SELECT count(DISTINCT cell_id) FROM counts) AS DOUBLE)) * 100, 6) AS pct_dropout_by_counts,
    CAST(sum(n) AS BIGINT) AS total_counts FROM counts GROUP BY 1""",
)
def qc_per_gene(t: Inputs):
    return ce.qc_per_gene(t.counts()).withColumns({c: r6(c) for c in ("mean_counts", "pct_dropout_by_counts")})


@query("qc_filter", "SELECT cell_id, CAST(sum(n) AS BIGINT) AS total_counts, count(*) AS n_genes_by_counts FROM counts GROUP BY 1 HAVING sum(n) >= 510 AND count(*) >= 20")
def qc_filter(t: Inputs):
    return ce.qc_filter(ce.qc_per_cell(t.counts()), 510, 20, "total_counts", "n_genes_by_counts")


_RELAXED = """WITH q AS (SELECT cell_id, CAST(sum(n) AS BIGINT) AS total_counts, count(*) AS n_genes_by_counts FROM counts GROUP BY 1)"""


@query("qc_filter_relaxed", _RELAXED + " SELECT * FROM q WHERE total_counts >= 500 AND n_genes_by_counts >= 1")
def qc_filter_relaxed(t: Inputs):
    """No cell has 1000 genes, so the gene bound falls to 1."""
    return ce.qc_filter_relaxed(ce.qc_per_cell(t.counts()), 500, 1000, "total_counts", "n_genes_by_counts")[0]


@query(
    "qc_relaxation_record",
    _RELAXED
    + """ SELECT count(*) AS n_obs_before_qc, count(*) FILTER (WHERE total_counts >= 500) AS n_obs_after_qc,
    CAST(1000 AS INTEGER) AS min_genes_original, CAST(1 AS INTEGER) AS min_genes_applied, true AS auto_relax_applied,
    'min_genes=1000 filtered all cells' AS auto_relax_reason FROM q""",
)
def qc_relaxation_record(t: Inputs):
    return ce.qc_filter_relaxed(ce.qc_per_cell(t.counts()), 500, 1000, "total_counts", "n_genes_by_counts")[1].drop("min_transcripts")


@query(
    "matrix_sparsity",
    """SELECT count(DISTINCT cell_id) AS n_cells, count(DISTINCT gene) AS n_genes, count(*) AS n_positive,
    round(1 - count(*) / CAST(count(DISTINCT cell_id) * count(DISTINCT gene) AS DOUBLE), 9) AS sparsity FROM counts""",
)
def matrix_sparsity(t: Inputs):
    return ce.sparsity(t.counts()).withColumn("sparsity", r6("sparsity", 9))


@query("clustering_choice", """SELECT CASE WHEN count(DISTINCT cell_id) < 500 AND 1 - count(*) / CAST(count(DISTINCT cell_id) * count(DISTINCT fine) AS DOUBLE) > 0.99
    THEN 'kmeans' ELSE 'leiden' END AS method FROM (SELECT DISTINCT cell_id, gene || '/' || CAST(row_id AS VARCHAR) AS fine FROM seg)""")
def clustering_choice(t: Inputs):
    """Method for an almost empty matrix, made by counting every transcript as a gene of its own."""
    # Any number that no other transcript has will do.
    fine = t.segmented().withColumn("gene", F.concat_ws("/", "gene", F.monotonically_increasing_id()))
    method, _ = ce.choose_clustering(ce.cell_gene_counts(fine))
    return t.spark.range(1).select(F.lit(method).alias("method"))


@query(
    "stats_joined_to_cells",
    """SELECT c.cell_id, coalesce(s.k, 1) AS n_subcellular_domains, coalesce(s.d, '0:0') AS subcellular_domain_distribution
    FROM cells c LEFT JOIN (SELECT cell_id, count(*) AS k, 'n:' || CAST(count(*) AS VARCHAR) AS d FROM seg WHERE x % 100 > 48 AND fov = 1 GROUP BY 1) s ON c.cell_id = s.cell_id""",
)
def stats_joined_to_cells(t: Inputs):
    some = t.segmented().filter("x % 100 > 48 and fov = 1").groupBy("cell_id").agg(
        F.count("*").alias("n_subcellular_domains"), F.concat(F.lit("n:"), F.count("*").cast("string")).alias("subcellular_domain_distribution")
    )
    return ce.with_stats(t.cells().select("cell_id"), some, {"n_subcellular_domains": 1, "subcellular_domain_distribution": "0:0"})


@query("common_cells", "SELECT cell_id, n_transcripts FROM cells WHERE cell_no IN (SELECT vec_id FROM embeddings)")
def common_cells(t: Inputs):
    other = t.embeddings().select(F.col("cell_id").cast("string").alias("cell_id"))
    return ce.common_cells(t.cells(), other).select("cell_id", "n_transcripts")


@query("cell_id_intersection", "SELECT cell_id FROM cells INTERSECT SELECT CAST(vec_id AS VARCHAR) FROM embeddings")
def cell_id_intersection(t: Inputs):
    return ce.cell_id_intersection(t.cells(), t.embeddings().select(F.col("cell_id").cast("string").alias("cell_id")))


@query("cells_in_large_set", "SELECT cell_id, gene, fov FROM seg WHERE cell_id IN (SELECT cell_id FROM cells WHERE n_transcripts > 510)")
def cells_in_large_set(t: Inputs):
    many = t.cells().filter("n_transcripts > 510").select("cell_id")
    return t.segmented().join(many, "cell_id", "left_semi").select("cell_id", "gene", "fov")


@query("spatial_knn", "SELECT src, dst, CAST(rk AS INTEGER) AS rank, round(dist, 6) AS dist FROM knn")
def spatial_knn(t: Inputs):
    return nb.nearest(t.cells(), 6, id="cell_no").withColumn("dist", r6("dist"))


@query("spatial_graph", "SELECT src, dst FROM graph")
def spatial_graph(t: Inputs):
    return t.graph().select("src", "dst")


@query(
    "graph_metrics",
    """WITH RECURSIVE reach AS (SELECT cell_no AS id, cell_no AS root FROM cells UNION SELECT g.dst, r.root FROM reach r JOIN graph g ON r.id = g.src WHERE r.root < g.dst),
    d AS (SELECT c.cell_no, count(g.dst) AS deg FROM cells c LEFT JOIN graph g ON c.cell_no = g.src GROUP BY 1)
    SELECT count(*) AS n_nodes, CAST(sum(deg) // 2 AS BIGINT) AS n_edges, round(avg(deg), 6) AS avg_degree, CAST(median(deg) AS DOUBLE) AS median_degree,
    (SELECT count(DISTINCT root) FROM (SELECT id, min(root) AS root FROM reach GROUP BY id)) AS connected_components FROM d""",
)
def graph_metrics(t: Inputs):
    return gr.graph_metrics(t.graph(), t.cells().select(F.col("cell_no").alias("id"))).withColumn("avg_degree", r6("avg_degree"))


@query(
    "nearest_neighbour_components",
    """WITH RECURSIVE e AS (SELECT src, dst FROM knn WHERE rk <= 1 UNION SELECT dst, src FROM knn WHERE rk <= 1),
    reach AS (SELECT cell_no AS id, cell_no AS root FROM cells UNION SELECT e.dst, r.root FROM reach r JOIN e ON r.id = e.src WHERE r.root < e.dst)
    SELECT id, min(root) AS component FROM reach GROUP BY id""",
)
def nearest_neighbour_components(t: Inputs):
    edges = nb.symmetric(nb.nearest(t.cells(), 1, id="cell_no"))
    return gr.components(edges, t.cells().select(F.col("cell_no").alias("id")))


@query(
    "transcript_knn",
    """SELECT cell_id, src, dst, CAST(rk AS INTEGER) AS rank, round(sqrt(d2), 6) AS dist FROM
    (SELECT a.cell_id, a.row_id AS src, b.row_id AS dst, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2,
     row_number() OVER (PARTITION BY a.row_id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.row_id) AS rk
     FROM seg a JOIN seg b ON a.cell_id = b.cell_id AND a.row_id <> b.row_id) WHERE rk <= 25""",
)
def transcript_knn(t: Inputs):
    """Nearest transcripts inside each cell."""
    inside = t.numbered().filter("cell_id is not null")
    return nb.nearest(inside, 25, group="cell_id").withColumn("dist", r6("dist"))


@query(
    "embedding_knn",
    """SELECT src, dst, CAST(rk AS INTEGER) AS rank, round(dist, 6) AS dist FROM (SELECT a.cell_id AS src, b.cell_id AS dst, list_distance(a.vector, b.vector) AS dist,
    row_number() OVER (PARTITION BY a.cell_id ORDER BY list_distance(a.vector, b.vector), b.cell_id) AS rk
    FROM emb a JOIN emb b ON a.cell_id <> b.cell_id) WHERE rk <= 15""",
)
def embedding_knn(t: Inputs):
    return nb.vector_knn(t.embeddings(), 15, "cell_id").withColumn("dist", r6("dist"))


@query(
    "shared_neighbour_weights",
    """WITH s AS (SELECT a.src, a.dst, count(*) AS k FROM knn a JOIN knn b ON a.dst = b.src JOIN knn c ON c.src = a.src AND c.dst = b.dst GROUP BY 1, 2),
    w AS (SELECT src, dst, k / CAST(12 - k AS DOUBLE) AS w FROM s)
    SELECT src, dst, round(sum(w) / 2, 9) AS w FROM (SELECT src, dst, w FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY 1, 2""",
)
def shared_neighbour_weights(t: Inputs):
    return gr.jaccard_graph(nb.nearest(t.cells(), 6, id="cell_no"), 6).withColumn("w", r6("w", 9))


@query("lognorm", "SELECT cell_id, gene, round(v, 9) AS value FROM lognorm")
def lognorm(t: Inputs):
    return ex.lognorm(t.counts()).select("cell_id", "gene", r6("value", 9).alias("value"))


_MOMENTS = """WITH nc AS (SELECT count(DISTINCT cell_id) AS n FROM lognorm),
    m AS (SELECT gene, sum(v) / (SELECT n FROM nc) AS mean, (sum(v * v) - sum(v) * sum(v) / (SELECT n FROM nc)) / ((SELECT n FROM nc) - 1) AS variance FROM lognorm GROUP BY gene)"""


@query("gene_moments", _MOMENTS + " SELECT gene, round(mean, 8) AS mean, round(variance, 8) AS variance FROM m")
def gene_moments(t: Inputs):
    m = ex.gene_moments(ex.lognorm(t.counts()))
    return m.select("gene", r6("mean", 8).alias("mean"), r6("variance", 8).alias("variance"))


_FINE = """WITH f AS (SELECT cell_id, gene || '/' || CAST(fov AS VARCHAR) AS gene, count(*) AS n FROM seg GROUP BY 1, 2),
    l AS (SELECT f.cell_id, gene, ln(1 + n * 10000.0 / t.total) AS v FROM f JOIN (SELECT cell_id, sum(n) AS total FROM f GROUP BY 1) t ON f.cell_id = t.cell_id),
    nc AS (SELECT count(DISTINCT cell_id) AS n FROM l),
    m AS (SELECT gene, sum(v) / (SELECT n FROM nc) AS mean, (sum(v * v) - sum(v) * sum(v) / (SELECT n FROM nc)) / ((SELECT n FROM nc) - 1) / (sum(v) / (SELECT n FROM nc)) AS disp FROM l GROUP BY gene),
    q AS (SELECT quantile_cont(mean, [0.1,0.15,0.2,0.25,0.3,0.35,0.4,0.45,0.5,0.55,0.6,0.65,0.7,0.75,0.8,0.85,0.9,0.95,1.0]) AS e FROM m),
    b AS (SELECT gene, mean, disp, len(list_filter(list_distinct(e), lambda z: z < mean)) AS bin FROM m, q),
    c AS (SELECT b.*, med FROM b JOIN (SELECT bin, median(disp) AS med FROM b GROUP BY 1) s ON b.bin = s.bin),
    d AS (SELECT c.*, mad FROM c JOIN (SELECT bin, median(abs(disp - med)) / 0.6744897501960817 AS mad FROM c GROUP BY 1) s ON c.bin = s.bin),
    r AS (SELECT gene, mean, disp, CASE WHEN mad > 0 THEN (disp - med) / mad END AS score FROM d)"""


@query(
    "variable_genes",
    _FINE
    + """ SELECT gene, round(mean, 8) AS mean, round(disp, 8) AS dispersion, round(score, 5) AS score FROM r
    WHERE coalesce(score, 0) >= (SELECT min(score) FROM (SELECT score FROM r WHERE score IS NOT NULL ORDER BY score DESC LIMIT 40))""",
)
def variable_genes(t: Inputs):
    """Most variable genes, on a finer panel of gene and field of view."""
    fine = t.segmented().withColumn("gene", F.concat_ws("/", "gene", "fov"))
    v = ex.variable_genes(cut(ex.lognorm(ce.cell_gene_counts(fine))), 40)
    return v.select("gene", r6("mean", 8).alias("mean"), r6("dispersion", 8).alias("dispersion"), r6("score", 5).alias("score"))


@query("variable_genes_fitted")
def variable_genes_fitted(t: Inputs):
    return ex.variable_genes_fitted(t.counts(), 2000)


@query(
    "scaled_vectors",
    _MOMENTS
    + """ SELECT c.cell_id, round(sum(least(greatest((coalesce(l.v, 0) - m.mean) / sqrt(m.variance), -10), 10)), 6) AS total,
    round(max(least((coalesce(l.v, 0) - m.mean) / sqrt(m.variance), 10)), 6) AS largest
    FROM cells c CROSS JOIN m LEFT JOIN lognorm l ON l.cell_id = c.cell_id AND l.gene = m.gene GROUP BY 1""",
)
def scaled_vectors(t: Inputs):
    values = ex.lognorm(t.counts())
    v = ex.scaled_vectors(values, values.select("gene").distinct(), t.cells())
    return v.select("cell_id", r6(F.aggregate("vector", F.lit(0.0), lambda a, b: a + b)).alias("total"), r6(F.array_max("vector")).alias("largest"))


def _pcs(t: Inputs):
    def make():
        values = cut(ex.lognorm(t.counts()))
        return ex.principal_components(ex.scaled_vectors(values, values.select("gene").distinct(), t.cells()))

    return t.kept("pcs", make)


@query("principal_components")
def principal_components(t: Inputs):
    return _pcs(t).select("cell_id", F.size("pcs").alias("n_components"), r6(F.col("pcs")[0]).alias("pc1"), r6(F.col("pcs")[1]).alias("pc2"))


@query("display_coordinates")
def display_coordinates(t: Inputs):
    return ex.display_coordinates(_pcs(t))


@query("clusters_kmeans")
def clusters_kmeans(t: Inputs):
    return ex.cluster_kmeans(_pcs(t))


@query("clusters_graph")
def clusters_graph(t: Inputs):
    return ex.cluster_graph(_pcs(t))


@query("clusters_of_embedding")
def clusters_of_embedding(t: Inputs):
    """Communities of a supplied embedding."""
    return ex.cluster_graph(t.embeddings(), vector="vector", dims=None)


@query("annotation_cluster_label", "SELECT cell_id, cluster, 'Cluster_' || cluster AS cell_type FROM cells")
def annotation_cluster_label(t: Inputs):
    return ex.label_clusters(t.cells().select("cell_id", "cluster"))


_WELCH = """WITH g AS (SELECT cl.cluster, cl.n1, gene.gene FROM (SELECT cluster, CAST(count(*) AS DOUBLE) AS n1 FROM cells GROUP BY 1) cl CROSS JOIN (SELECT DISTINCT gene FROM lognorm) gene),
    h AS (SELECT c.cluster, l.gene, sum(v) AS s1, sum(v * v) AS q1 FROM lognorm l JOIN cells c ON l.cell_id = c.cell_id GROUP BY 1, 2),
    o AS (SELECT gene, sum(s1) AS s, sum(q1) AS q FROM h GROUP BY 1),
    f AS (SELECT g.cluster, g.gene, n1, (SELECT count(*) FROM cells) - n1 AS n2, coalesce(s1, 0) AS s1, coalesce(q1, 0) AS q1, s - coalesce(s1, 0) AS s2, q - coalesce(q1, 0) AS q2
      FROM g JOIN o ON g.gene = o.gene LEFT JOIN h ON g.cluster = h.cluster AND g.gene = h.gene),
    w AS (SELECT cluster, gene, (s1 / n1 - s2 / n2) / sqrt(greatest((q1 - s1 * s1 / n1) / greatest(n1 - 1, 1), 0) / n1 + greatest((q2 - s2 * s2 / n2) / greatest(n2 - 1, 1), 0) / n2) AS score FROM f)"""


@query("marker_scores", _WELCH + " SELECT cluster, gene, round(score, 5) AS score FROM w")
def marker_scores(t: Inputs):
    """Welch t score of every gene in every cluster."""
    return ex.rank_markers(ex.lognorm(t.counts()), t.cells()).withColumn("score", r6("score", 5))


@query("top_marker_per_cluster", _WELCH + " SELECT cluster, arg_max(gene, score) AS gene FROM w GROUP BY cluster")
def top_marker_per_cluster(t: Inputs):
    return ex.top_markers(ex.rank_markers(ex.lognorm(t.counts()), t.cells())).select("cluster", "gene")


@query(
    "annotation_rank_marker",
    _WELCH + " SELECT c.cell_id, c.cluster, CASE WHEN (SELECT min(n1) FROM f) < 2 THEN 'Cluster_' || c.cluster ELSE 'CT_' || b.gene END AS cell_type FROM cells c JOIN (SELECT cluster, arg_max(gene, score) AS gene FROM w GROUP BY cluster) b ON c.cluster = b.cluster",
)
def annotation_rank_marker(t: Inputs):
    return ex.annotate_markers(ex.lognorm(t.counts()), t.cells().select("cell_id", "cluster")).select("cell_id", "cluster", "cell_type")


@query(
    "label_map_with_default",
    "SELECT cell_id, cluster, CASE WHEN cluster = '0' THEN 'CT_zero' WHEN cluster = '1' THEN 'CT_one' ELSE 'CT_Unknown' END AS cell_type FROM cells",
)
def label_map_with_default(t: Inputs):
    labels = t.cells().filter("cluster in ('0', '1')").select(
        "cluster", F.when(F.col("cluster") == "0", "CT_zero").otherwise("CT_one").alias("cell_type")
    ).distinct()
    return ex.map_labels(t.cells().select("cell_id", "cluster"), labels).select("cell_id", "cluster", "cell_type")


@query("annotation_from_reference")
def annotation_from_reference(t: Inputs):
    """Labels of all vectors from a model trained on those with an even id."""
    e = t.embeddings()
    return ex.annotate_from_reference(e.filter("cell_id % 2 = 0"), e)


@query(
    "majority_vote",
    """WITH v AS (SELECT cell_id % 7 AS cluster, label, count(*) AS n FROM emb GROUP BY 1, 2),
    b AS (SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS rn FROM v)
    SELECT e.cell_id, e.cell_id % 7 AS cluster, e.label AS predicted, b.label AS cell_type FROM emb e JOIN b ON e.cell_id % 7 = b.cluster AND rn = 1""",
)
def majority_vote(t: Inputs):
    e = t.embeddings()
    found = ex.majority_vote(e.select("cell_id", F.col("label").alias("predicted")), e.select("cell_id", (F.col("cell_id") % 7).alias("cluster")))
    return found.select("cell_id", "cluster", "predicted", "cell_type")


@query(
    "diffusion_on_spatial_graph",
    """WITH e AS (SELECT src, dst FROM graph UNION SELECT cell_no, cell_no FROM cells),
    p AS (SELECT e.src, e.dst, 1.0 / d.k AS p FROM e JOIN (SELECT src, count(*) AS k FROM e GROUP BY 1) d ON e.src = d.src)
    SELECT CAST(p.src AS VARCHAR) AS cell_id, gene, round(sum(p.p * n), 6) AS denoised FROM p JOIN counts ON CAST(p.dst AS VARCHAR) = counts.cell_id GROUP BY 1, 2""",
)
def diffusion_on_spatial_graph(t: Inputs):
    g = t.graph().select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    return ex.diffuse(t.counts(), ex.transitions(g)).withColumn("denoised", r6("denoised"))


@query("denoise_by_diffusion")
def denoise_by_diffusion(t: Inputs):
    """Counts smoothed over 15 expression and 15 spatial neighbours of each cell."""
    number = t.cells().select("cell_id", "cell_no")
    pcs = _pcs(t).join(number, "cell_id")
    near = nb.symmetric(nb.vector_knn(pcs, 15, "cell_no", "pcs"))
    space = t.graph(15)
    step = ex.transitions(*[g.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst")) for g in (near, space)])
    return ex.diffuse(t.counts(), step)


@query("cluster_sizes", "SELECT cluster AS value, count(*) AS n FROM cells GROUP BY 1")
def cluster_sizes(t: Inputs):
    return distribution(t.cells(), "cluster")


@query("cell_table_sink", "SELECT cell_id, cluster, n_transcripts, round(x, 6) AS x, round(y, 6) AS y FROM cells")
def cell_table_sink(t: Inputs):
    path = new_path(t.spark, "cells.parquet")
    c = t.cells()
    sinks.cell_export(c.drop("x", "y"), c).write.parquet(path)
    return t.spark.read.parquet(path).select("cell_id", "cluster", "n_transcripts", r6("x").alias("x"), r6("y").alias("y"))


@query("embedding_sink", "SELECT cell_id, vector[1] AS dim0, vector[2] AS dim1, vector[3] AS dim2 FROM emb")
def embedding_sink(t: Inputs):
    path = new_path(t.spark, "embedding.parquet")
    sinks.embedding_export(t.embeddings(), "vector").write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "evaluate_ingestion",
    """SELECT count(*) AS n_transcripts, count(DISTINCT coalesce(cell_id, 'nan')) AS n_cells_raw, count(DISTINCT gene) AS n_genes_raw, count(DISTINCT fov) AS n_fovs,
    round(count(*) FILTER (WHERE cell_id IS NULL) / CAST(count(*) AS DOUBLE), 9) AS missing_cell_ratio FROM transcripts""",
)
def evaluate_ingestion(t: Inputs):
    return ev.evaluate_ingestion(t.transcripts()).withColumn("missing_cell_ratio", r6("missing_cell_ratio", 9))


@query(
    "evaluate_denoise",
    """SELECT count(*) AS n_transcripts_before, count(*) FILTER (WHERE CellComp IN ('Nuclear', 'Cytoplasm')) AS n_transcripts_after,
    round(count(*) FILTER (WHERE CellComp IN ('Nuclear', 'Cytoplasm')) / CAST(count(*) AS DOUBLE), 9) AS retained_ratio FROM transcripts""",
)
def evaluate_denoise(t: Inputs):
    raw = t.transcripts()
    return ev.evaluate_denoise(raw, denoise(raw)).withColumn("retained_ratio", r6("retained_ratio", 9))


@query(
    "evaluate_segmentation",
    """SELECT CAST(sum(n) AS BIGINT) AS n_transcripts_assigned, count(*) AS n_cells_assigned, round(avg(n), 6) AS mean_transcripts_per_cell,
    CAST(median(n) AS DOUBLE) AS median_transcripts_per_cell, round(sum(n) / CAST((SELECT count(*) FROM transcripts) AS DOUBLE), 9) AS assignment_ratio
    FROM (SELECT cell_id, count(*) AS n FROM seg GROUP BY 1)""",
)
def evaluate_segmentation(t: Inputs):
    e = ev.evaluate_segmentation(t.transcripts(), t.segmented())
    return e.withColumns({"mean_transcripts_per_cell": r6("mean_transcripts_per_cell"), "assignment_ratio": r6("assignment_ratio", 9)})


@query(
    "evaluate_expression",
    """SELECT count(*) AS n_cells_after_qc, CAST(25 AS BIGINT) AS n_genes_after_hvg, 1.0::DOUBLE AS qc_pass_ratio_vs_segmented,
    CAST(median(total) AS DOUBLE) AS median_total_counts, CAST(median(g) AS DOUBLE) AS median_n_genes_by_counts
    FROM (SELECT cell_id, sum(n) AS total, count(*) AS g FROM counts GROUP BY 1)""",
)
def evaluate_expression(t: Inputs):
    q = ce.qc_per_cell(t.counts())
    return ev.evaluate_expression(q, t.counts().select("gene").distinct().count(), q.count())


@query("evaluate_clustering", "SELECT count(*) AS n_clusters, round(max(n) / CAST(sum(n) AS DOUBLE), 9) AS largest_cluster_fraction FROM (SELECT cluster, count(*) AS n FROM cells GROUP BY 1)")
def evaluate_clustering(t: Inputs):
    return ev.evaluate_groups(t.cells(), "cluster", "cluster").withColumn("largest_cluster_fraction", r6("largest_cluster_fraction", 9))


_RAND = """WITH c AS (SELECT cluster AS a, spatial_domain AS b, count(*) AS n FROM cells GROUP BY 1, 2),
    s AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM c) AS ij, (SELECT sum(k * (k - 1) / 2.0) FROM (SELECT sum(n) AS k FROM c GROUP BY a)) AS pa,
      (SELECT sum(k * (k - 1) / 2.0) FROM (SELECT sum(n) AS k FROM c GROUP BY b)) AS pb, (SELECT sum(n) * (sum(n) - 1) / 2.0 FROM c) AS t)
    SELECT round((ij - pa * pb / t) / ((pa + pb) / 2 - pa * pb / t), 9) AS adjusted_rand_index FROM s"""


@query("adjusted_rand_index", _RAND)
def adjusted_rand_index(t: Inputs):
    return ev.adjusted_rand(t.cells(), "cluster", "spatial_domain").withColumn("adjusted_rand_index", r6("adjusted_rand_index", 9))


@query(
    "evaluate_annotation",
    """SELECT count(*) AS n_cell_types, round(max(n) / CAST(sum(n) AS DOUBLE), 9) AS largest_cell_type_fraction
    FROM (SELECT 'Cluster_' || cluster AS cell_type, count(*) AS n FROM cells GROUP BY 1)""",
)
def evaluate_annotation(t: Inputs):
    found = ev.evaluate_groups(ex.label_clusters(t.cells()), "cell_type", "cell_type")
    return found.withColumn("largest_cell_type_fraction", r6("largest_cell_type_fraction", 9))


@query(
    "evaluate_spatial_domain",
    f"""SELECT n_spatial_domains, largest_spatial_domain_fraction, adjusted_rand_index AS domain_cluster_ari FROM
    (SELECT count(*) AS n_spatial_domains, round(max(n) / CAST(sum(n) AS DOUBLE), 9) AS largest_spatial_domain_fraction
     FROM (SELECT spatial_domain, count(*) AS n FROM cells GROUP BY 1)), ({_RAND})""",
)
def evaluate_spatial_domain(t: Inputs):
    """Domains, the share of the largest, and their agreement with the clusters."""
    cells = t.cells()
    agreement = ev.adjusted_rand(cells, "cluster", "spatial_domain").select(r6("adjusted_rand_index", 9).alias("domain_cluster_ari"))
    # Two tables of one row.
    return ev.evaluate_groups(cells, "spatial_domain", "spatial_domain").withColumn(
        "largest_spatial_domain_fraction", r6("largest_spatial_domain_fraction", 9)
    ).crossJoin(agreement)


@query("minimum_cells", "SELECT n_obs_after_qc, n_obs_after_qc >= 2 AS enough FROM (SELECT count(*) AS n_obs_after_qc FROM (SELECT cell_id FROM counts GROUP BY 1 HAVING sum(n) >= 10 AND count(*) >= 5))")
def minimum_cells(t: Inputs):
    """Whether quality control leaves enough cells to analyse."""
    kept = ce.qc_filter(ce.qc_per_cell(t.counts()).select("cell_id", F.col("total_counts").alias("n_transcripts"), F.col("n_genes_by_counts").alias("n_genes")), 10, 5)
    return kept.agg(F.count("*").alias("n_obs_after_qc")).withColumn("enough", F.lit(ce.enough_cells(kept)))


@query(
    "silhouette",
    """WITH e AS (SELECT cell_id, vector[1:10] AS v, label AS l FROM emb), n AS (SELECT l, count(*) AS n FROM e GROUP BY 1),
    d AS (SELECT a.cell_id, a.l, b.l AS o, sum(list_distance(a.v, b.v)) AS s FROM e a CROSS JOIN e b GROUP BY 1, 2, 3),
    r AS (SELECT cell_id, max(CASE WHEN d.l = o AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN d.l <> o THEN s / n END) AS b FROM d JOIN n ON n.l = o GROUP BY 1)
    SELECT 'silhouette' AS metric, round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS value FROM r""",
)
def silhouette(t: Inputs):
    return ev.silhouette(t.embeddings(), "vector", "label").withColumn("value", r6("value", 9))


@query(
    "silhouette_squared",
    """WITH e AS (SELECT cell_id, vector[1:10] AS v, label AS l FROM emb), n AS (SELECT l, count(*) AS n FROM e GROUP BY 1),
    d AS (SELECT a.cell_id, a.l, b.l AS o, sum(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS s FROM e a CROSS JOIN e b GROUP BY 1, 2, 3),
    r AS (SELECT cell_id, max(CASE WHEN d.l = o AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN d.l <> o THEN s / n END) AS b FROM d JOIN n ON n.l = o GROUP BY 1)
    SELECT 'silhouette_squared_euclidean' AS metric, round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS value FROM r""",
)
def silhouette_squared(t: Inputs):
    return ev.silhouette_squared(t.embeddings(), "vector", "label").withColumn("value", r6("value"))


@query("contract_violations", """WITH k AS (SELECT count(*) AS n FROM cells), d AS (SELECT count(*) FILTER (WHERE cell_id IS NULL) AS n FROM transcripts),
    g AS (SELECT count(*) AS n, count(*) FILTER (WHERE CAST(cell_id AS BIGINT) % 3 = 0) AS lost FROM seg), c AS (SELECT count(*) AS n FROM cells WHERE cell_no % 3 <> 0),
    e AS (SELECT count(*) FILTER (WHERE fov = 6) AS n FROM seg)
    SELECT s AS source, g AS target, b AS "table", m AS "column", p AS problem, CAST(n AS BIGINT) AS n FROM (
    SELECT 'denoise' AS s, 'segmentation' AS g, 'denoised' AS b, 'cell_id' AS m, 'null' AS p, n FROM d
    UNION ALL SELECT 'segmentation', t, 'segmented', 'cell_id', 'unmatched', lost FROM g, (VALUES ('spatial_domain'), ('subcellular_spatial_domain')) v(t)
    UNION ALL SELECT 'segmentation', 'subcellular_spatial_domain', 'segmented', 'x', 'not finite', n FROM e
    UNION ALL SELECT 'subcellular_spatial_domain', 'analysis', 'segmented', 'subcellular_domain', 'missing', n FROM g
    UNION ALL SELECT 'spatial_domain', 'analysis', 'cells', m, 'missing', n FROM c, (VALUES ('x'), ('y')) v(m)
    UNION ALL SELECT 'analysis', 'annotation', 'cells', m, 'missing', n FROM c, (VALUES ('pcs'), ('x'), ('y')) v(m)
    UNION ALL SELECT 'annotation', 'end', 'cells', 'cell_type', 'missing', n FROM c) WHERE n > 0""")
def contract_violations(t: Inputs):
    """Rows of derived tables that the next steps cannot take: with a third of the cells gone and the x of one field unknown."""
    segmented = t.segmented().withColumn("x", F.when(F.col("fov") == 6, F.lit(float("nan"))).otherwise(F.col("x")))
    cells = t.cells().filter("cell_no % 3 <> 0").drop("x", "y")
    return violations(t.spark, {"denoised": t.transcripts(), "segmented": segmented, "cells": cells})


@query("step_inputs", """SELECT * FROM (VALUES ('denoise', 'denoise input: missing required columns: [''CellComp'']'), ('annotation', 'annotation input: is empty')) v(step, message)
    WHERE (SELECT count(*) FROM seg) > 0""")
def step_inputs(t: Inputs):
    """What the inputs of steps lack: transcripts without compartments, and no cells of a field that there is not."""
    given = {"denoise": t.transcripts().drop("CellComp"), "segmentation": t.segmented(), "annotation": t.cells().filter("n_transcripts < 0")}
    rows = [(step, message) for step, df in given.items() for message in check_input(df, step)]
    return t.spark.createDataFrame(rows, "step string, message string")
