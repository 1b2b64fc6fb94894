"""Normalisation, feature selection, reduction, clustering and annotation of cells."""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph import canonical_labels, communities, rank_in_group
from tessera.operators.neighbours import expression_k, symmetric, vector_knn
from tessera.runtime import cut

#: Rounds after which an iteration that has not met its tolerance is told of.
ROUNDS = 1000


def lognorm(counts: DataFrame, target: float = 1e4) -> DataFrame:
    """Counts scaled to ``target`` per cell, then ``log(1 + v)``; adds ``value``."""
    totals = counts.groupBy("cell_id").agg(F.sum("count").alias("__total"))
    scaled = F.when(F.col("__total") == 0, F.col("count").cast("double")).otherwise(
        F.col("count") * F.lit(target) / F.col("__total")
    )
    return counts.join(totals, "cell_id").withColumn("value", F.log1p(scaled)).drop("__total")


def gene_moments(values: DataFrame, n_cells: int | None = None, value: str = "value") -> DataFrame:
    """Mean and sample variance per gene over all cells, absent entries being 0."""
    n = n_cells if n_cells is not None else values.select("cell_id").distinct().count()
    sums = values.groupBy("gene").agg(F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    mean = F.col("s") / F.lit(float(n))
    variance = (F.col("q") - F.col("s") * F.col("s") / F.lit(float(n))) / F.lit(float(max(n - 1, 1)))
    return sums.select("gene", mean.alias("mean"), F.greatest(variance, F.lit(0.0)).alias("variance"))


def variable_genes(values: DataFrame, n_top: int = 2000) -> DataFrame:
    """Genes of highest dispersion relative to genes of similar mean.

    Dispersion (variance / mean) is centred by the median and scaled by the
    median absolute deviation of its bin; bins are the 5 % steps of the mean
    from 10 % on.  Genes tied with the last place are kept, and if no gene can
    be scored all are.  The gene table is as long as the panel.
    """
    m = gene_moments(values).withColumn("m", F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean")))
    m = cut(m.withColumn("dispersion", F.col("variance") / F.col("m")))
    steps = [round(0.10 + 0.05 * i, 2) for i in range(19)]
    edges = m.agg(F.percentile("m", F.array(*[F.lit(s) for s in steps])).alias("edges"))
    binned = m.join(F.broadcast(edges), F.lit(True)).withColumn(
        "bin", F.size(F.filter(F.array_distinct("edges"), lambda e: e < F.col("m")))
    )
    medians = binned.groupBy("bin").agg(F.median("dispersion").alias("med"))
    deviating = binned.join(medians, "bin")
    mads = deviating.groupBy("bin").agg((F.median(F.abs(F.col("dispersion") - F.col("med"))) / F.lit(0.6744897501960817)).alias("mad"))
    scored = deviating.join(mads, "bin").withColumn(
        "score", F.when(F.col("mad") > 0, (F.col("dispersion") - F.col("med")) / F.col("mad"))
    )
    ranked = cut(scored.select("gene", "mean", "dispersion", "score"))
    n_scored = ranked.agg(F.count("score")).first()[0]
    if n_scored == 0:
        return ranked
    last = ranked.filter("score is not null").orderBy(F.col("score").desc()).limit(min(n_top, n_scored)).agg(F.min("score"))
    return ranked.filter(F.coalesce("score", F.lit(0.0)) >= F.lit(last.first()[0]))


def variable_genes_fitted(counts: DataFrame, n_top: int = 2000) -> DataFrame:
    """Genes ranked by the variance of their clipped standardised counts.

    The expected variance is a quadratic fit of log variance on log mean over
    the gene table; values are clipped at the square root of the cell count.
    """
    n = counts.select("cell_id").distinct().count()
    m = gene_moments(counts, n, "count")
    logs = m.filter("variance > 0").withColumn("lm", F.log10("mean")).withColumn(
        "features", array_to_vector(F.array(F.col("lm"), F.col("lm") * F.col("lm")))
    ).withColumn("label", F.log10("variance"))
    if logs.limit(3).count() < 3:
        return m.select("gene", "mean", "variance", F.lit(None).cast("double").alias("score"))
    fit = LinearRegression(regParam=0.0, solver="normal").fit(logs)
    expected = fit.transform(logs).select("gene", "mean", F.sqrt(F.pow(F.lit(10.0), F.col("prediction"))).alias("sd"))
    high = F.lit(float(np.sqrt(n)))
    z = F.least((F.col("count") - F.col("mean")) / F.col("sd"), high)
    z0 = F.least(-F.col("mean") / F.col("sd"), high)
    seen = counts.join(expected, "gene").groupBy("gene").agg(
        F.first("mean").alias("mean"), F.first("sd").alias("sd"), F.count("*").alias("k"),
        F.sum(z).alias("s"), F.sum(z * z).alias("q"),
    )
    zeros = F.lit(float(n)) - F.col("k")
    s, q = F.col("s") + zeros * z0, F.col("q") + zeros * z0 * z0
    scored = seen.withColumn("score", (q - s * s / F.lit(float(n))) / F.lit(float(max(n - 1, 1))))
    joined = m.join(scored.select("gene", "score"), "gene", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return joined.orderBy(F.col("score").desc(), "gene").limit(n_top)


def scaled_vectors(values: DataFrame, genes: DataFrame, cells: DataFrame, clip: float = 10.0) -> DataFrame:
    """Dense standardised vector per cell over ``genes`` in name order, clipped.

    ``genes`` is a gene selection (some 2,000 variable genes): the statistics
    sent with the tasks are as long as one row of the result.
    """
    names = genes.select("gene")
    kept = values.join(names, "gene", "left_semi")
    n = cells.count()
    stats = gene_moments(kept, n).orderBy("gene").collect()
    position = {r["gene"]: i for i, r in enumerate(stats)}
    mean = np.array([r["mean"] for r in stats])
    sd = np.sqrt(np.array([r["variance"] for r in stats]))
    sd[sd == 0] = 1.0

    @F.pandas_udf("array<double>")
    def dense(gene: pd.Series, value: pd.Series) -> pd.Series:
        base = np.clip(-mean / sd, -clip, clip)
        rows = []
        for g, v in zip(gene, value):
            row = base.copy()
            if g is not None and len(g):
                at = np.array([position[name] for name in g])
                row[at] = np.clip((np.asarray(v) - mean[at]) / sd[at], -clip, clip)
            rows.append(row)
        return pd.Series(rows)

    # At most one entry per selected gene and cell, so the lists are bounded.
    sparse = kept.groupBy("cell_id").agg(F.collect_list(F.struct("gene", "value")).alias("e"))
    return cells.select("cell_id").join(sparse, "cell_id", "left").select(
        "cell_id", dense(F.col("e.gene"), F.col("e.value")).alias("vector")
    )


def principal_components(vectors: DataFrame, most: int = 50) -> DataFrame:
    """Scores ``cell_id, pcs``; the largest loading of each component is positive."""
    vectors = cut(vectors.select("cell_id", "vector"))
    row = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    k = min(max(2, min(most, row[0] - 1, row[1] - 1)), row[1])
    data = vectors.select("cell_id", array_to_vector("vector").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="scores").fit(data)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    sign = F.array(*[F.lit(s) for s in signs])
    return model.transform(data).select(
        "cell_id", F.zip_with(vector_to_array("scores"), sign, lambda a, b: a * b).alias("pcs")
    )


def display_coordinates(pcs: DataFrame) -> DataFrame:
    """Two-dimensional coordinates for a scatter plot: the first two components."""
    return pcs.select("cell_id", F.col("pcs")[0].alias("x"), F.col("pcs")[1].alias("y"))


def kmeans_labels(df: DataFrame, vector: str, k: int, id: str = "cell_id", seed: int = 0) -> DataFrame:
    """K-means labels ``id, label``, numbered by size."""
    data = df.select(F.col(id), array_to_vector(F.col(vector)).alias("features"))
    # Stops by the tolerance; the count only ends a run that circles.
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="label", maxIter=ROUNDS, tol=1e-6).fit(data)
    if model.summary.numIter >= ROUNDS:
        warnings.warn(f"k-means has not converged in {ROUNDS} rounds", stacklevel=2)
    return canonical_labels(model.transform(data).select(F.col(id).alias("id"), "label")).withColumnRenamed("id", id)


def cluster_kmeans(pcs: DataFrame, id: str = "cell_id", vector: str = "pcs") -> DataFrame:
    """K-means on components with min(8, max(2, n)) clusters."""
    return kmeans_labels(pcs, vector, min(8, max(2, pcs.count())), id).withColumnRenamed("label", "cluster")


def cluster_graph(vectors: DataFrame, resolution: float = 1.0, id: str = "cell_id", vector: str = "pcs",
                  dims: int | None = 30) -> DataFrame:
    """Communities of the nearest-neighbour graph of vectors: ``id, cluster``.

    Serves the first components as well as a supplied embedding (``dims=None``).
    """
    v = F.slice(F.col(vector), 1, dims) if dims else F.col(vector)
    named = cut(rank_in_group(df=vectors.select(F.col(id).alias("name"), v.alias("vector")), group=[], order=[F.col("name")], name="id"))
    near = vector_knn(named, expression_k(named.count()), "id", "vector")
    graph = symmetric(near).withColumn("w", F.lit(1.0))
    found = canonical_labels(communities(graph, named, resolution))
    return found.join(named.select("id", "name"), "id").select(F.col("name").alias(id), F.col("label").alias("cluster"))


def label_clusters(clusters: DataFrame) -> DataFrame:
    """Cell type named after the cluster."""
    return clusters.withColumn("cell_type", F.concat(F.lit("Cluster_"), F.col("cluster").cast("string")))


def rank_markers(values: DataFrame, clusters: DataFrame) -> DataFrame:
    """Welch t score of every gene in every cluster against all other cells.

    Entries that do not occur count as 0, so the result has a row for each
    cluster and gene.
    """
    sizes = clusters.groupBy("cluster").agg(F.count("*").cast("double").alias("n1"))
    total = float(clusters.count())
    v = F.col("value")
    here = values.join(clusters.select("cell_id", "cluster"), "cell_id").groupBy("cluster", "gene").agg(
        F.sum(v).alias("s1"), F.sum(v * v).alias("q1")
    )
    overall = here.groupBy("gene").agg(F.sum("s1").alias("s"), F.sum("q1").alias("q"))
    grid = overall.crossJoin(sizes).select("gene", "s", "q", "cluster", "n1")  # the rows of the result
    full = grid.join(here, ["cluster", "gene"], "left").fillna(0.0, ["s1", "q1"])
    n1, n2 = F.col("n1"), F.lit(total) - F.col("n1")
    s1, q1 = F.col("s1"), F.col("q1")
    s2, q2 = F.col("s") - s1, F.col("q") - q1
    one = F.lit(1.0)
    var1 = F.greatest((q1 - s1 * s1 / n1) / F.greatest(n1 - one, one), F.lit(0.0))
    var2 = F.greatest((q2 - s2 * s2 / n2) / F.greatest(n2 - one, one), F.lit(0.0))
    error = F.sqrt(var1 / n1 + var2 / n2)
    score = F.when(error > 0, (s1 / n1 - s2 / n2) / error).otherwise(F.lit(0.0))
    return full.select("cluster", "gene", score.alias("score"))


def top_markers(scores: DataFrame) -> DataFrame:
    """Best gene of each cluster; ties go to the smaller name."""
    best = scores.groupBy("cluster").agg(F.max("score").alias("score"))
    return scores.join(best, ["cluster", "score"]).groupBy("cluster", "score").agg(F.min("gene").alias("gene"))


def map_labels(clusters: DataFrame, labels: DataFrame, default: str = "CT_Unknown") -> DataFrame:
    """Cell type of each cell by its cluster; clusters without a label get ``default``."""
    return clusters.join(labels.select("cluster", "cell_type"), "cluster", "left").withColumn(
        "cell_type", F.coalesce("cell_type", F.lit(default))
    )


def annotate_markers(values: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cell types ``CT_<best marker>``; falls back to cluster names if a cluster has one cell."""
    smallest = clusters.groupBy("cluster").agg(F.count("*").alias("n")).agg(F.min("n")).first()[0]
    if smallest is None or smallest < 2:
        return label_clusters(clusters)
    best = top_markers(rank_markers(values, clusters))
    return map_labels(clusters, best.withColumn("cell_type", F.concat(F.lit("CT_"), F.col("gene"))))


def annotate_from_reference(reference: DataFrame, cells: DataFrame, id: str = "cell_id", vector: str = "vector",
                            label: str = "label") -> DataFrame:
    """Best matching label and its probability from a model trained on labelled rows."""
    train = reference.select(array_to_vector(F.col(vector)).alias("features"), F.col(label).cast("string").alias("name"))
    index = StringIndexer(inputCol="name", outputCol="target", stringOrderType="alphabetAsc").fit(train)
    model = LogisticRegression(labelCol="target", maxIter=ROUNDS, regParam=0.01).fit(index.transform(train))
    if model.summary.totalIterations >= ROUNDS:
        warnings.warn(f"the label model has not converged in {ROUNDS} rounds", stacklevel=2)
    scored = model.transform(cells.select(F.col(id), array_to_vector(F.col(vector)).alias("features")))
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=index.labels).transform(scored)
    return named.select(id, "predicted", F.array_max(vector_to_array("probability")).alias("confidence"))


def majority_vote(predicted: DataFrame, clusters: DataFrame, id: str = "cell_id") -> DataFrame:
    """Most frequent predicted label of each cluster, given to all its cells."""
    joined = predicted.join(clusters.select(id, "cluster"), id)
    votes = joined.groupBy("cluster", "predicted").agg(F.count("*").alias("n"))
    # Ties go to the smaller label.
    most = votes.groupBy("cluster").agg(F.max("n").alias("n"))
    winner = votes.join(most, ["cluster", "n"]).groupBy("cluster").agg(F.min("predicted").alias("cell_type"))
    return joined.join(winner, "cluster")


def transitions(*graphs: DataFrame) -> DataFrame:
    """Average of the row-normalised graphs ``src, dst`` (each with a self step)."""
    parts = []
    for g in graphs:
        loops = g.select("src").distinct().select("src", F.col("src").alias("dst"))
        edges = g.select("src", "dst").unionByName(loops).distinct()
        degree = edges.groupBy("src").agg(F.count("*").alias("d"))
        parts.append(edges.join(degree, "src").select("src", "dst", (F.lit(1.0 / len(graphs)) / F.col("d")).alias("p")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("src", "dst").agg(F.sum("p").alias("p"))


def diffuse(values: DataFrame, steps_of: DataFrame, steps: int = 1, value: str = "count") -> DataFrame:
    """Expression smoothed along the graph: ``cell_id, gene, denoised``.

    Each step replaces a cell's value by the average over where it can step to.
    """
    now = values.select("cell_id", "gene", F.col(value).cast("double").alias("denoised"))
    for _ in range(steps):
        now = (
            steps_of.join(now.withColumnRenamed("cell_id", "dst"), "dst")
            .groupBy(F.col("src").alias("cell_id"), "gene")
            .agg(F.sum(F.col("p") * F.col("denoised")).alias("denoised"))
        )
    return now
