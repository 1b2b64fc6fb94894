"""Spatial domains of cells and subcellular domains of transcripts."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.operators.expression import kmeans_labels
from tessera.operators.graph import canonical_labels, communities, components, jaccard_graph, rank_in_group
from tessera.operators.moves import Block, settle
from tessera.operators.neighbours import location_knn, nearest, nearest_in_task, symmetric
from tessera.operators.tiles import split_groups, whole_groups
from tessera.runtime import cut, number_rows

#: Transcripts of a cell whose graph one task holds; graphs of larger cells are tables.
WHOLE = 4096


def domain_count(n: int, most: int = 12) -> int:
    """Number of spatial domains for ``n`` cells."""
    return max(2, min(most, int(math.sqrt(max(n, 2)) // 2 + 2)))


def spatial_kmeans(cells: DataFrame, n_domains: int | None = None, id: str = "cell_id") -> DataFrame:
    """Spatial domains by k-means on the coordinates."""
    n = cells.count()
    k = max(2, min(n_domains or domain_count(n), n))
    placed = cells.select(id, F.array("x", "y").alias("v"))
    return kmeans_labels(placed, "v", k, id).withColumnRenamed("label", "spatial_domain")


def spatial_communities(graph: DataFrame, cells: DataFrame, resolution: float = 1.0, id: str = "cell_no") -> DataFrame:
    """Spatial domains as communities of the neighbour graph ``src, dst``."""
    found = communities(graph.withColumn("w", F.lit(1.0)), cells.select(F.col(id).alias("id")), resolution)
    return canonical_labels(found).select(F.col("id").alias(id), F.col("label").alias("spatial_domain"))


def communities_for_count(graph: DataFrame, cells: DataFrame, target: int, id: str = "id", lowest: float = 0.1, highest: float = 3.0,
                          step: float = 0.01, together: int = 100) -> tuple[DataFrame, float]:
    """Communities ``id, label`` at the first of the resolutions lowest, lowest + step, ... that gives ``target`` of them, and that resolution.

    If none does, the closest number is used (of equals the lowest
    resolution).  ``together`` resolutions are tried in one run, each on its
    own copy of the graph, so their rounds are shared; numbers of communities
    need not rise with the resolution, so none is passed over.
    """
    steps = round((highest - lowest) / step) + 1
    named = cut(number_rows(cells.select(F.col(id).alias("name")).distinct(), "name", name="v", start=0))
    of = named.select(F.col("name").alias("src"), F.col("v").alias("a"))
    ends = graph.select("src", "dst").join(of, "src").join(of.toDF("dst", "b"), "dst").select("a", "b")
    ends = cut(ends)
    best = None
    for first in range(0, steps, together):
        tries = F.explode(F.sequence(F.lit(first), F.lit(min(first + together, steps) - 1)))
        copies = named.select("name", "v", tries.alias("try")).withColumn("id", F.col("v") * steps + F.col("try"))
        copies = cut(copies.withColumn("resolution", F.round(F.lit(lowest) + F.col("try") * F.lit(step), 10)))
        edges = ends.withColumn("try", tries).select((F.col("a") * steps + F.col("try")).alias("src"), (F.col("b") * steps + F.col("try")).alias("dst"), F.lit(1.0).alias("w"))
        found = communities(edges, copies, "resolution", group="try")
        found = cut(found.join(copies, "id").select("try", F.col("name").alias("id"), "label"))
        # One row for each resolution of the run.
        counts = found.groupBy("try").agg(F.countDistinct("label").alias("n")).collect()
        away, at = min(((abs(r["n"] - target), r["try"]) for r in counts), default=(0, 0))
        if best is None or away < best[0]:
            best = (away, found.filter(F.col("try") == at).select("id", "label"), round(lowest + at * step, 10))
        if not away:
            break
    return best[1], best[2]


def no_domains(transcripts: DataFrame) -> DataFrame:
    """Every transcript in domain ``0``."""
    return transcripts.withColumn("subcellular_domain", F.lit("0"))


def _cell_sizes(t: DataFrame) -> DataFrame:
    return t.groupBy("cell_id").agg(F.count("*").alias("__size"))


def _with_small_cells(t: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """Attach labels; cells below ``least`` transcripts are one domain."""
    sizes = _cell_sizes(t)
    return (
        t.join(sizes, "cell_id")
        .join(labels.select("row_id", "subcellular_domain"), "row_id", "left")
        .withColumn("subcellular_domain", F.when(F.col("__size") < least, "0").otherwise(F.col("subcellular_domain")))
        .drop("__size")
    )


def _box_links(core: DataFrame, eps: float) -> DataFrame:
    """Links between squares of core locations that hold a pair within ``eps``.

    Squares are small enough that all their core locations are mutually within
    ``eps``.  Two squares are compared by the boxes of their content: boxes
    wholly within reach are linked, boxes out of reach are not, and the rest is
    compared again by boxes of quarter size.  A box of one location is always
    decided, so this ends, and never lists the pairs of two squares.
    """
    cell2 = F.lit(float(eps) * float(eps))
    side = float(eps) / 1.4143

    def boxes(fine: int) -> DataFrame:
        s = F.lit(side / 4.0**fine)
        return core.groupBy("group", "square", F.floor(F.col("x") / s).alias("sx"), F.floor(F.col("y") / s).alias("sy")).agg(
            F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2")
        )

    def compare(pairs: DataFrame) -> DataFrame:
        near_x = F.greatest(F.lit(0.0), F.col("x1_b") - F.col("x2_a"), F.col("x1_a") - F.col("x2_b"))
        near_y = F.greatest(F.lit(0.0), F.col("y1_b") - F.col("y2_a"), F.col("y1_a") - F.col("y2_b"))
        far_x = F.greatest(F.abs(F.col("x2_a") - F.col("x1_b")), F.abs(F.col("x2_b") - F.col("x1_a")))
        far_y = F.greatest(F.abs(F.col("y2_a") - F.col("y1_b")), F.abs(F.col("y2_b") - F.col("y1_a")))
        return pairs.filter(near_x * near_x + near_y * near_y <= cell2).withColumn(
            "sure", far_x * far_x + far_y * far_y <= cell2
        )

    def sided(df: DataFrame, mark: str) -> DataFrame:
        return df.select("group", *[F.col(c).alias(f"{c}_{mark}") for c in df.columns if c != "group"])

    top = boxes(0)
    around = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)]
    offsets = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j")) for i, j in around])
    reach = sided(top, "a").withColumn("o", F.explode(offsets)).withColumns(
        {"sx_b": F.col("sx_a") + F.col("o.i"), "sy_b": F.col("sy_a") + F.col("o.j")}
    ).drop("o")
    pairs = cut(compare(reach.join(sided(top, "b"), ["group", "sx_b", "sy_b"])))
    links = pairs.filter("sure").select(F.col("square_a").alias("src"), F.col("square_b").alias("dst"))
    fine = 0
    while True:
        decided = pairs.filter("sure").select("square_a", "square_b").distinct()
        doubt = pairs.filter("not sure").join(decided, ["square_a", "square_b"], "left_anti")
        if doubt.isEmpty():
            return links.distinct()
        fine += 1
        quarter = boxes(fine)
        parent = quarter.withColumns(
            {"px": F.floor(F.col("sx") / 4).cast("bigint"), "py": F.floor(F.col("sy") / 4).cast("bigint")}
        )
        keys = doubt.select("group", "square_a", "sx_a", "sy_a", "square_b", "sx_b", "sy_b").distinct()
        a = sided(parent, "a").withColumnsRenamed({"sx_a": "fx_a", "sy_a": "fy_a", "px_a": "sx_a", "py_a": "sy_a"})
        b = sided(parent, "b").withColumnsRenamed({"sx_b": "fx_b", "sy_b": "fy_b", "px_b": "sx_b", "py_b": "sy_b"})
        met = keys.join(a, ["group", "square_a", "sx_a", "sy_a"]).join(b, ["group", "square_b", "sx_b", "sy_b"])
        pairs = cut(
            compare(met).drop("sx_a", "sy_a", "sx_b", "sy_b").withColumnsRenamed(
                {"fx_a": "sx_a", "fy_a": "sy_a", "fx_b": "sx_b", "fy_b": "sy_b"}
            )
        )
        links = links.unionByName(pairs.filter("sure").select(F.col("square_a").alias("src"), F.col("square_b").alias("dst")))


def dbscan(t: DataFrame, eps: float = 20.0, min_samples: int = 10) -> DataFrame:
    """Density clusters of each cell's transcripts: adds ``subcellular_domain``.

    A location is core if its ``min_samples``-th nearest point, itself
    included, lies within ``eps``.  Core locations in one small square belong
    together; squares are linked by :func:`_box_links`.  Other points join the
    first cluster with a core point within ``eps`` or are ``noise``.  Clusters
    are numbered by their first row.
    """
    points = t.filter("cell_id is not null").select(F.col("cell_id").alias("group"), F.col("row_id").alias("id"), "x", "y")
    points = points.filter("x is not null and y is not null")
    limit2 = F.lit(float(eps) * float(eps))
    places = cut(location_knn(points, min_samples))
    kth = F.element_at("near", min_samples)["d2"]
    enough = (F.size("near") >= min_samples) & (F.when(F.size("near") >= min_samples, kth) <= limit2)
    places = places.withColumn("core", enough).withColumn("first", F.array_min(F.transform(F.filter("near", lambda p: p["d2"] == 0), lambda p: p["id"])))
    side = F.lit(float(eps) / 1.4143)
    spots = places.filter("core").withColumns({"bx": F.floor(F.col("x") / side), "by": F.floor(F.col("y") / side)})
    squares = spots.groupBy("group", "bx", "by").agg(F.min("first").alias("square"))
    core = cut(spots.join(squares, ["group", "bx", "by"]).select("group", "x", "y", "square", "first"))
    links = _box_links(core, eps)
    nodes = squares.select(F.col("square").alias("id"))
    parts = components(links, nodes).select(F.col("id").alias("square"), "component")
    named = core.join(parts, "square")
    order = named.groupBy("group", "component").agg(F.min("first").alias("start"))
    numbers = rank_in_group(order, ["group"], [F.col("start")], "number").select("group", "component", "number")
    core_label = cut(named.join(numbers, ["group", "component"]).select("group", "x", "y", "number"))
    core_points = points.join(core_label, ["group", "x", "y"]).select("id", "number")
    # Fewer than min_samples points are within eps of any other location, so they are all in its list.
    border = (
        places.filter("not core").select("group", "x", "y", F.explode(F.filter("near", lambda p: p["d2"] <= limit2)).alias("p"))
        .select("group", "x", "y", F.col("p.id").alias("id"))
        .join(core_points, "id")
        .groupBy("group", "x", "y")
        .agg(F.min("number").alias("number"))
    )
    labels = points.join(core_label.unionByName(border), ["group", "x", "y"], "left").select(
        F.col("id").alias("row_id"), F.coalesce(F.col("number").cast("string"), F.lit("noise")).alias("subcellular_domain")
    )
    return _with_small_cells(t.filter("cell_id is not null"), labels, min_samples)


def _hierarchy(x: np.ndarray, y: np.ndarray, core: np.ndarray, weight: np.ndarray, least: int) -> np.ndarray:
    """HDBSCAN labels of one cell's locations from their core distances and point counts (Campello et al., 2013)."""
    n = len(x)
    if n == 1:
        return np.full(1, -1)
    # Minimum spanning tree of the mutual reachability distance.
    best, link = np.full(n, np.inf), np.zeros(n, int)
    done = np.zeros(n, bool)
    at, tree = 0, []
    for _ in range(n - 1):
        done[at] = True
        reach = np.maximum(np.maximum(np.hypot(x - x[at], y - y[at]), core), core[at])
        closer = ~done & (reach < best)
        best[closer], link[closer] = reach[closer], at
        nxt = int(np.where(done, np.inf, best).argmin())
        tree.append((best[nxt], link[nxt], nxt))
        at = nxt
    tree.sort()
    # Single linkage: children and size of every merge.
    root = list(range(2 * n - 1))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    size = weight.tolist() + [0] * (n - 1)
    child, height = {}, {}
    for node, (d, a, b) in enumerate(tree, start=n):
        a, b = find(a), find(b)
        root[a] = root[b] = node
        child[node], height[node], size[node] = (a, b), d, size[a] + size[b]

    def leaves(node):
        stack, out = [node], []
        while stack:
            v = stack.pop()
            if v < n:
                out.append(v)
            else:
                stack.extend(child[v])
        return out

    # Condensed clusters: points fall out until both sides of a split are large enough.
    birth, parent, stability, fallen = {0: 0.0}, {0: -1}, {0: 0.0}, {0: []}
    stack, next_id = [(2 * n - 2, 0)], 1
    while stack:
        node, cluster = stack.pop()
        apart = core[node] if node < n else height[node]
        level = 1.0 / apart if apart > 0 else np.inf
        if node < n:
            # A location with enough points to be a cluster: they part where they stop being dense.
            fallen[cluster].append(node)
            stability[cluster] += (level - birth[cluster] if np.isfinite(level) else 1e300) * size[node]
            continue
        a, b = child[node]
        big = [c for c in (a, b) if size[c] >= least]
        gone = level - birth[cluster] if np.isfinite(level) else 1e300
        for c in (a, b):
            if len(big) == 2:
                birth[next_id], parent[next_id], stability[next_id], fallen[next_id] = level, cluster, 0.0, []
                stability[cluster] += gone * size[c]
                stack.append((c, next_id))
                next_id += 1
            elif c in big:
                stack.append((c, cluster))
            else:
                points = leaves(c)
                fallen[cluster].extend(points)
                stability[cluster] += gone * size[c]
    # Excess of mass: a cluster wins over its descendants if it is more stable; the root never does.
    children = {c: [d for d in parent if parent[d] == c] for c in birth}
    chosen = {}
    for c in sorted(birth, reverse=True):
        below = sum(stability[d] for d in children[c])
        if c == 0 or (children[c] and below > stability[c]):
            chosen[c] = False
            stability[c] = below
        else:
            chosen[c] = True
    labels = np.full(n, -1)
    number = 0
    stack = [0]
    while stack:
        c = stack.pop()
        if chosen[c]:
            inside = [c]
            while inside:
                d = inside.pop()
                labels[fallen[d]] = number
                inside.extend(children[d])
            number += 1
        else:
            stack.extend(sorted(children[c], reverse=True))
    return labels


def hdbscan(t: DataFrame, min_cluster_size: int = 30, min_samples: int = 5, largest: int = 50000) -> DataFrame:
    """Hierarchical density clusters of each cell's transcripts.

    Core distances come from the distributed neighbour search.  Points at one
    place are one weighted location, and the hierarchy of a cell's locations is
    built in one task, so cells of more than ``largest`` distinct locations are
    refused rather than cut short.
    """
    inside = t.filter("cell_id is not null and x is not null and y is not null")
    points = inside.select(F.col("cell_id").alias("group"), F.col("row_id").alias("id"), "x", "y")
    at = ["group", "x", "y"]
    sizes = points.groupBy(*at).agg(F.count("*").alias("weight"), F.min("id").alias("first"))
    core = F.sqrt(F.element_at("near", F.size("near"))["d2"])
    data = cut(location_knn(points, min_samples + 1).select(*at, core.alias("core")).join(sizes, at))
    biggest = data.groupBy("group").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    if biggest > largest:
        raise ValueError(f"a cell has {biggest} distinct locations; hdbscan takes up to {largest} per cell, dbscan any number")

    def per_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first")
        if pdf["weight"].sum() < max(min_cluster_size, 2):
            labels = np.zeros(len(pdf), int)
        else:
            labels = _hierarchy(*[pdf[c].to_numpy() for c in ("x", "y", "core", "weight")], min_cluster_size)
        # Number clusters by their first row.
        order = {c: i for i, c in enumerate(dict.fromkeys(c for c in labels.tolist() if c >= 0))}
        return pdf[at].assign(subcellular_domain=[str(order[c]) if c >= 0 else "noise" for c in labels.tolist()])

    kind = dict(data.dtypes)["group"]
    labels = data.groupBy("group").applyInPandas(per_cell, f"`group` {kind}, x double, y double, subcellular_domain string")
    named = points.join(labels, at).select(F.col("id").alias("row_id"), "subcellular_domain")
    return inside.join(named, "row_id")


def graph_domains(t: DataFrame, n_neighbors: int = 25, resolution: float = 0.5) -> DataFrame:
    """Communities of each cell's transcript neighbour graph; all cells in one run."""

    def table(large: DataFrame) -> DataFrame:
        edges = symmetric(nearest(large, n_neighbors, group="cell_id")).withColumn("w", F.lit(1.0))
        return _communities_per_cell(large, edges, resolution, n_neighbors + 1)

    return _per_cell(t, n_neighbors, False, resolution, n_neighbors + 1, 0, table)


def phenograph_domains(t: DataFrame, k: int = 30, min_cluster_size: int = 10) -> DataFrame:
    """Communities of the shared-neighbour graph; small ones become ``-1``."""
    least = max(k + 1, min_cluster_size)

    def table(large: DataFrame) -> DataFrame:
        edges = jaccard_graph(nearest(large, k, group="cell_id"), k)
        return _communities_per_cell(large, edges, 1.0, least, min_cluster_size)

    return _per_cell(t, k, True, 1.0, least, min_cluster_size, table)


def _neighbour_graph(x: np.ndarray, y: np.ndarray, k: int, shared: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``src, dst, w`` of one cell's neighbour graph, both directions; with ``shared`` weighted by the overlap of neighbour sets."""
    n = len(x)
    rows, cols = nearest_in_task(x, y, k)
    if not shared:
        pair = np.unique(np.concatenate([rows * n + cols, cols * n + rows]))
        return pair // n, pair % n, np.ones(len(pair))
    near = np.zeros((n, n + 1), bool)
    near[rows, cols] = True
    sizes = np.bincount(rows, minlength=n)
    lists = np.full((n, k), n)
    lists[rows, np.arange(len(rows)) - np.searchsorted(rows, rows)] = cols
    common = np.zeros(len(rows), np.int64)
    for s in range(0, len(rows), 1 << 15):
        common[s : s + (1 << 15)] = near[cols[s : s + (1 << 15), None], lists[rows[s : s + (1 << 15)]]].sum(1)
    some = common > 0
    rows, cols, common = rows[some], cols[some], common[some]
    w = common / (sizes[rows] + sizes[cols] - common)
    pair, at = np.unique(np.concatenate([rows * n + cols, cols * n + rows]), return_inverse=True)
    return pair // n, pair % n, np.bincount(at, np.concatenate([w, w])) / 2


def _per_cell(t: DataFrame, k: int, shared: bool, resolution: float, least: int, smallest: int, table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``t`` with communities of each cell's graph as ``subcellular_domain``: in a task for cells of up to ``WHOLE`` rows, by ``table`` for others."""
    inside = cut(t.filter("cell_id is not null"))
    small, large = split_groups(inside, "cell_id", WHOLE)

    def cell(x: np.ndarray, y: np.ndarray) -> list[str]:
        n = len(x)
        if n < least:
            return ["0"] * n
        label = np.arange(n)
        # Rows without a place are communities of their own.
        placed = np.flatnonzero(~(np.isnan(x) | np.isnan(y)))
        if len(placed):
            src, dst, w = _neighbour_graph(x[placed], y[placed], k, shared)
            strength = np.bincount(src, w, len(placed))
            mass = strength.sum()
            two_m = mass / resolution if mass > 0 and resolution > 0 else 1.0
            block = Block(len(placed), src, dst, w, strength if resolution > 0 else np.zeros(len(placed)), np.full(len(placed), two_m))
            label[placed] = placed[settle(block, np.arange(len(placed)))]
        names, own, sizes = np.unique(label, return_inverse=True, return_counts=True)
        # By size, then by smallest member, which is the name.
        number = np.empty(len(names), int)
        number[np.lexsort((names, -sizes))] = np.arange(len(names))
        number[sizes < smallest] = -1
        return [str(v) for v in number[own].tolist()]

    def run(rows: pa.Table, bounds: np.ndarray) -> pa.Table:
        x, y = (rows[c].cast(pa.float64()).to_numpy() for c in ("x", "y"))
        made = [d for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist()) for d in cell(x[i:j], y[i:j])]
        return rows.append_column("subcellular_domain", pa.array(made, pa.string()))

    shape = ", ".join(f"`{c}` {kind}" for c, kind in inside.dtypes) + ", subcellular_domain string"
    found = whole_groups(small, "cell_id", ["row_id"], run, shape)
    return found if large is None else found.unionByName(table(cut(large)))


def _communities_per_cell(inside: DataFrame, edges: DataFrame, resolution: float, least: int, smallest: int = 0) -> DataFrame:
    vertices = inside.select(F.col("row_id").alias("id"), "cell_id")
    found = communities(edges, vertices, resolution, group="cell_id").join(vertices, "id")
    if smallest:
        sizes = found.groupBy("cell_id", "label").agg(F.count("*").alias("__m"))
        found = found.join(sizes, ["cell_id", "label"])
        large = canonical_labels(found.filter(F.col("__m") >= smallest).drop("__m"), ["cell_id"])
        small = found.filter(F.col("__m") < smallest).select("cell_id", "label", "id").withColumn("label", F.lit("-1"))
        found = large.unionByName(small)
    else:
        found = canonical_labels(found, ["cell_id"])
    return _with_small_cells(inside, found.select(F.col("id").alias("row_id"), F.col("label").alias("subcellular_domain")), least)


def subcellular_stats(t: DataFrame) -> DataFrame:
    """Per cell: domains other than noise, noise transcripts and ``label:count`` text."""
    counts = t.groupBy("cell_id", "subcellular_domain").agg(F.count("*").alias("n"))
    noise = F.col("subcellular_domain") == "noise"
    text = F.concat_ws(":", F.col("subcellular_domain"), F.col("n").cast("string"))
    return counts.groupBy("cell_id").agg(
        F.count_if(~noise).alias("n_subcellular_domains"),
        F.coalesce(F.sum(F.when(noise, F.col("n"))), F.lit(0)).cast("bigint").alias("n_noise"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("subcellular_domain", text.alias("t")))), lambda s: s["t"]), ","
        ).alias("subcellular_domain_distribution"),
    )


def subcellular_summary(stats: DataFrame, method: str) -> DataFrame:
    """Run totals over the cells of :func:`subcellular_stats`."""
    many = F.count_if(F.col("n_subcellular_domains") >= 2)
    return stats.agg(
        F.lit(method).alias("subcellular_spatial_domain_backend"),
        F.count("*").alias("n_cells_processed"),
        many.alias("n_cells_with_multiple_domains"),
        F.round(many / F.greatest(F.count("*"), F.lit(1)), 4).alias("fraction_multi_domain"),
        F.round(F.coalesce(F.avg("n_subcellular_domains"), F.lit(1.0)), 3).alias("mean_domains_per_cell"),
        F.coalesce(F.sum("n_noise"), F.lit(0)).cast("bigint").alias("total_noise_transcripts"),
    )
