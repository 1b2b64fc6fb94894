"""Quality measures of each processing layer."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.runtime import cut, number_rows


def evaluate_ingestion(raw: DataFrame) -> DataFrame:
    """Counts of the raw table and its share of transcripts without a cell."""
    return raw.agg(
        F.count("*").alias("n_transcripts"),
        F.countDistinct(F.coalesce(F.col("cell_id").cast("string"), F.lit("nan"))).alias("n_cells_raw"),
        F.countDistinct("gene").alias("n_genes_raw"),
        F.countDistinct("fov").alias("n_fovs"),
        safe_ratio(F.count_if(F.col("cell_id").isNull()), F.count("*")).alias("missing_cell_ratio"),
    )


def evaluate_denoise(raw: DataFrame, denoised: DataFrame) -> DataFrame:
    """Transcripts before and after denoising."""
    before = raw.agg(F.count("*").alias("n_transcripts_before"))
    after = denoised.agg(F.count("*").alias("n_transcripts_after"))
    return before.join(F.broadcast(after), F.lit(True)).withColumn(
        "retained_ratio", safe_ratio(F.col("n_transcripts_after"), F.col("n_transcripts_before"))
    )


def evaluate_segmentation(denoised: DataFrame, segmented: DataFrame) -> DataFrame:
    """Assigned transcripts and their number per cell."""
    per_cell = segmented.groupBy("cell_id").agg(F.count("*").alias("n"))
    totals = per_cell.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_transcripts_assigned"),
        F.count("cell_id").alias("n_cells_assigned"),
        F.coalesce(F.avg("n"), F.lit(0.0)).alias("mean_transcripts_per_cell"),
        F.coalesce(F.median("n"), F.lit(0.0)).alias("median_transcripts_per_cell"),
    )
    before = denoised.agg(F.count("*").alias("__before"))
    return totals.join(F.broadcast(before), F.lit(True)).withColumn(
        "assignment_ratio", safe_ratio(F.col("n_transcripts_assigned"), F.col("__before"))
    ).drop("__before")


def evaluate_expression(cells: DataFrame, n_genes: int, n_segmented: int) -> DataFrame:
    """Cells after quality control and their median totals."""
    return cells.agg(
        F.count("*").alias("n_cells_after_qc"),
        F.lit(n_genes).cast("bigint").alias("n_genes_after_hvg"),
        safe_ratio(F.count("*"), F.lit(n_segmented)).alias("qc_pass_ratio_vs_segmented"),
        F.coalesce(F.median("total_counts"), F.lit(0.0)).alias("median_total_counts"),
        F.coalesce(F.median("n_genes_by_counts"), F.lit(0.0)).alias("median_n_genes_by_counts"),
    )


def evaluate_groups(cells: DataFrame, column: str, name: str) -> DataFrame:
    """Number of groups of a label column and the share of the largest."""
    sizes = cells.groupBy(F.col(column).cast("string").alias("g")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.count("g").alias(f"n_{name}s"),
        safe_ratio(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).alias(f"largest_{name}_fraction"),
    )


def evaluate_subcellular(cells: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Cells with several domains and the transcripts in them."""
    many = cells.filter(F.col("n_subcellular_domains") > 1)
    inside = transcripts.join(many.select("cell_id"), "cell_id", "left_semi").agg(
        F.count("*").alias("n_transcripts_in_multi_domain_cells")
    )
    return cells.agg(
        F.count_if(F.col("n_subcellular_domains") > 1).alias("n_cells_with_multiple_domains"),
        safe_ratio(F.count_if(F.col("n_subcellular_domains") > 1), F.count("*")).alias("fraction_multi_domain"),
        F.coalesce(F.avg("n_subcellular_domains"), F.lit(1.0)).alias("mean_domains_per_cell"),
    ).join(F.broadcast(inside), F.lit(True))


def adjusted_rand(df: DataFrame, left: str, right: str) -> DataFrame:
    """Adjusted Rand index of two labellings of the same rows."""
    cells = df.groupBy(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b")).agg(
        F.count("*").cast("double").alias("n")
    )

    def pairs(by: list[str], name: str) -> DataFrame:
        sums = cells.groupBy(*by).agg(F.sum("n").alias("n")) if by else cells.agg(F.sum("n").alias("n"))
        return sums.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias(name))

    one = pairs(["a", "b"], "together")
    for by, name in ((["a"], "pa"), (["b"], "pb"), ([], "all")):
        one = one.join(F.broadcast(pairs(by, name)), F.lit(True))
    expected = F.col("pa") * F.col("pb") / F.col("all")
    highest = (F.col("pa") + F.col("pb")) / 2
    # Two labellings that are both one group, or both all singletons, agree fully.
    return one.select(
        F.when(F.coalesce(highest == expected, F.lit(True)), F.lit(1.0))
        .otherwise((F.col("together") - expected) / (highest - expected)).alias("adjusted_rand_index")
    )


def _labelled(df: DataFrame, vector: str, label: str, id: str, dims: int) -> tuple[DataFrame, int | None]:
    """Rows ``id, v, l`` and their number; None if a silhouette is not defined: fewer than 2 labels or dimensions."""
    data = cut(df.select(F.col(id).alias("id"), F.slice(F.col(vector), 1, dims).alias("v"), F.col(label).cast("string").alias("l")))
    one = data.agg(F.count("*"), F.countDistinct("l"), F.min(F.size("v"))).first()
    return data, None if one[1] < 2 or one[2] < 2 or one[1] >= one[0] else one[0]


def silhouette_squared(df: DataFrame, vector: str, label: str, id: str = "cell_id", dims: int = 10) -> DataFrame:
    """Mean silhouette with squared Euclidean distances: ``metric, value``.

    A row's mean squared distance to a label follows from the label's sums, so
    one pass over the rows is enough at any size.  Null as in ``silhouette``.
    """
    data, rows = _labelled(df, vector, label, id, dims)
    if rows is None:
        return df.sparkSession.createDataFrame([("silhouette_squared_euclidean", None)], "metric string, value double")
    # Labels get dense numbers: as many rows as there are labels.
    numbers = number_rows(data.select("l").distinct(), F.col("l"), name="prediction", start=0)
    ready = data.join(numbers, "l").select(array_to_vector("v").alias("features"), F.col("prediction").cast("double").alias("prediction"))
    value = ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(ready)
    return df.sparkSession.createDataFrame([("silhouette_squared_euclidean", value)], "metric string, value double")


def _distance_sums(a: np.ndarray, b: np.ndarray, starts: np.ndarray, weights: np.ndarray | None) -> np.ndarray:
    """Sums of the distances of each row of ``a`` to runs of rows of ``b`` that begin at ``starts``."""
    centre = b.mean(axis=0)
    near, far = a - centre, b - centre
    of_near, of_far = (near * near).sum(1), (far * far).sum(1)
    left = np.column_stack([near, of_near, np.ones(len(near))])
    right = np.ascontiguousarray(np.column_stack([-2 * far, np.ones(len(far)), of_far]).T)
    out = np.zeros((len(a), len(starts)))
    ends, most = np.r_[starts[1:], len(b)], of_far.max()
    # Squares of about a MB; runs may go on in the next one.
    for s in range(0, len(a), 128):
        rows = slice(s, s + 128)
        for c in range(0, len(b), 1024):
            z = min(c + 1024, len(b))
            d = left[rows] @ right[:, c:z]
            # A product leaves little of a small distance, which is measured.
            i, j = np.nonzero(d < 1e-4 * (of_near[rows].max() + most))
            if len(i):
                d[i, j] = ((a[i + s] - b[j + c]) ** 2).sum(1)
            np.sqrt(d, out=d)
            if weights is not None:
                d *= weights[c:z]
            first, last = np.searchsorted(ends, c, side="right"), np.searchsorted(starts, z)
            out[rows, first:last] += np.add.reduceat(d, np.maximum(starts[first:last] - c, 0), axis=1)
    return out


def silhouette(df: DataFrame, vector: str, label: str, id: str = "cell_id", dims: int = 10, block: int = 512) -> DataFrame:
    """Mean silhouette on the first ``dims`` dimensions: ``metric, value``.

    Euclidean distances; the work is that of all pairs of unlike rows, so
    ``silhouette_squared`` is the form for very many rows.  Equal vectors of a
    label are one row that counts often.  Rows are in blocks of up to ``block``,
    of 64 times that where there are many, and a task compares each two blocks
    once, for the rows of both; it returns one sum per row and label.  Fewer
    than 2 labels or dimensions give null, and rows without a label count as 0.
    """
    data, rows = _labelled(df, vector, label, id, dims)
    if rows is None:
        return df.sparkSession.createDataFrame([("silhouette", None)], "metric string, value double")
    # Labels get dense numbers: as many rows as there are labels.
    numbers = number_rows(data.filter("l is not null").select("l").distinct(), F.col("l"), name="code", start=0)
    merged = data.join(numbers, "l").groupBy("code", "v").agg(F.count("*").alias("w"))
    merged = cut(merged.select(F.monotonically_increasing_id().alias("n"), F.col("code").cast("int").alias("code"), "v", "w"))
    places = merged.count()
    n_blocks = max(-(-places // (64 * block)), min(16, -(-places // block)))
    b, o = F.pmod(F.xxhash64("n"), F.lit(n_blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    # A row of each block goes to the pairs of its block with every one.
    met = merged.select("*", b.alias("b")).select("*", o.alias("o")).select(F.least("b", "o").alias("low"), F.greatest("b", "o").alias("high"), "b", "n", "code", "v", "w")

    def sums(table: pa.Table) -> pa.Table:
        table = table.sort_by([("b", "ascending"), ("code", "ascending")])
        own, n, code, w = (table[c].to_numpy() for c in ("b", "n", "code", "w"))
        v = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(n), -1)
        half = int(np.searchsorted(own, table["low"][0].as_py(), side="right"))
        sides = [(slice(0, half), slice(half, None)), (slice(half, None), slice(0, half))] if table["low"][0] != table["high"][0] else [(slice(0, None),) * 2]
        made = []
        for left, right in sides:
            if not len(n[left]) or not len(n[right]):
                continue
            starts = np.flatnonzero(np.r_[True, np.diff(code[right]) > 0])
            total = _distance_sums(v[left], v[right], starts, w[right].astype(float) if (w[right] > 1).any() else None)
            made.append((np.repeat(n[left], len(starts)), np.tile(code[right][starts], len(total)), total.ravel()))
        columns = [np.concatenate(c) for c in zip(*made)] if made else [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)]
        return pa.table(dict(zip(("n", "other", "total"), columns)))

    # As many tasks as pairs of blocks, however few their bytes.
    tasks = min(n_blocks * (n_blocks + 1) // 2, 4096)
    far = met.repartition(tasks, "low", "high").groupBy("low", "high").applyInArrow(sums, "n bigint, other int, total double")
    # All that belongs to a row is dealt together once.
    far = far.repartition("n").groupBy("n", "other").agg(F.sum("total").alias("total"))
    sizes = merged.groupBy(F.col("code").alias("other")).agg(F.sum("w").alias("size"))
    own = F.col("code") == F.col("other")
    per_row = far.join(merged.select("n", "code", "w"), "n").join(F.broadcast(sizes), "other").groupBy("n").agg(
        F.max("w").alias("w"),
        F.max(F.when(own, F.when(F.col("size") > 1, F.col("total") / (F.col("size") - 1)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    s = F.when(F.col("a").isNull() | (F.greatest("a", "b") == 0), F.lit(0.0)).otherwise(
        (F.col("b") - F.col("a")) / F.greatest("a", "b")
    )
    return per_row.agg((F.sum(s * F.col("w")) / F.lit(float(rows))).alias("value")).select(F.lit("silhouette").alias("metric"), "value")
