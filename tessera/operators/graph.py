"""Connected components, graph metrics and modularity communities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import safe_ratio
from tessera.operators.moves import TOLERANCE, Block, settle
from tessera.runtime import cut, number_rows

#: Links that one task puts together.
PIECE = 1 << 20
#: Edges of a block in which communities settle, and vertices of a block that move in a later round.
BLOCK_EDGES, BLOCK_MOVERS = 1 << 22, 1 << 16
#: Edges up to which graphs of fewer share a block.
SHARED_EDGES = 1 << 18
#: Steps over which blocks spread, and doublings of the pointers between communities.
SPREAD, JUMPS = 8, 3


def _stars(links: DataFrame, pieces: int) -> DataFrame:
    """The links ``v, u`` as stars: in each of ``pieces`` tasks every vertex is linked to the smallest one that its links reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[batch.column(c).to_numpy(zero_copy_only=False) for c in ("v", "u")] for batch in batches]
        if not held:
            return
        ids, at = np.unique(np.concatenate([x for pair in zip(*held) for x in pair]), return_inverse=True)
        v, u = at[: len(at) // 2], at[len(at) // 2 :]
        least = np.arange(len(ids))
        while True:
            low = least.copy()
            np.minimum.at(low, v, least[u])
            np.minimum.at(low, u, least[v])
            low = low[low]
            if np.array_equal(low, least):
                break
            least = low
        inner = np.flatnonzero(least != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[inner]), pa.array(ids[least[inner]])], ["v", "u"])

    kind = links.schema["v"].dataType.simpleString()
    return links.coalesce(pieces).mapInArrow(run, f"v {kind}, u {kind}")


def components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Component of each vertex: ``id, component`` (its smallest id).

    Tasks of at most about ``PIECE`` links first make stars of what they
    hold; if one task is enough, those are the components.  Else the two star
    steps of Kiveris et al. (2014) alternate: link larger neighbours, then
    smaller ones, to the smallest id around.  Only minima are aggregated, so a
    vertex with very many edges is no group to collect.
    """
    links = edges.select(F.greatest("src", "dst").alias("v"), F.least("src", "dst").alias("u"))
    links = cut(links.filter("v > u"))
    pieces = links.count() // PIECE + 1
    links = cut(_stars(links, pieces))
    if pieces > 1:
        links = _star_rounds(links)
    found = links.select(F.col("v").alias("id"), F.col("u").alias("component"))
    return vertices.select("id").join(found, "id", "left").select(
        "id", F.coalesce("component", "id").alias("component")
    )


def _star_rounds(links: DataFrame) -> DataFrame:
    """Links of every vertex but the smallest of its component to that one."""
    before = None
    while True:
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.join(least, "v").filter("u > v and u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.distinct()
        down = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(down, "v").filter("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        links = cut(small.unionByName(down.select("v", F.col("m").alias("u"))).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return links
        before = now


def graph_metrics(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Nodes, undirected edges, mean and median degree and components."""
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))
    all_degrees = vertices.select("id").join(degree, "id", "left").select(F.coalesce("degree", F.lit(0)).alias("degree"))
    totals = all_degrees.agg(
        F.count("*").alias("n_nodes"),
        F.floor(F.sum("degree") / 2).cast("bigint").alias("n_edges"),
        F.avg("degree").alias("avg_degree"),
        F.median("degree").alias("median_degree"),
    )
    parts = components(edges, vertices).agg(F.countDistinct("component").alias("connected_components"))
    return totals.join(F.broadcast(parts), F.lit(True))


def rank_in_group(df: DataFrame, group: list[str], order: list, name: str) -> DataFrame:
    """Zero-based position inside a group, without putting a group in one task."""
    keys = [F.col(g) for g in group]
    numbered = number_rows(df, *keys, *order, name="__at")
    if not group:
        return numbered.withColumn(name, F.col("__at") - 1).drop("__at")
    starts = numbered.groupBy(*group).agg(F.min("__at").alias("__start"))
    return numbered.join(starts, group).withColumn(name, F.col("__at") - F.col("__start")).drop("__at", "__start")


def canonical_labels(labels: DataFrame, group: list[str] | None = None, id: str = "id", label: str = "label") -> DataFrame:
    """Renumber labels from 0 by size, then by smallest member."""
    group = group or []
    sizes = labels.groupBy(*group, label).agg(F.count("*").alias("__n"), F.min(id).alias("__least"))
    ranked = rank_in_group(sizes, group, [F.col("__n").desc(), F.col("__least")], "__label")
    return labels.join(ranked.select(*group, label, "__label"), [*group, label]).withColumn(
        label, F.col("__label").cast("string")
    ).drop("__label")


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Weighted modularity of ``labels (id, label)`` on symmetric ``edges``."""
    lab = labels.select("id", "label")
    tagged = edges.join(lab.select(F.col("id").alias("src"), F.col("label").alias("a")), "src").join(
        lab.select(F.col("id").alias("dst"), F.col("label").alias("b")), "dst"
    )
    by = tagged.groupBy("a").agg(F.sum("w").alias("tot"), F.sum(F.when(F.col("a") == F.col("b"), F.col("w"))).alias("within"))
    row = by.agg(F.sum("tot"), F.sum("within"), F.sum(F.col("tot") * F.col("tot"))).first()
    if not row[0]:
        return 0.0
    return float((row[1] or 0.0) / row[0] - resolution * row[2] / (row[0] * row[0]))


def _wishes(links: DataFrame, state: DataFrame) -> DataFrame:
    """``id, now, best, k, two_m, gain``: vertices that gain by a move, the best one (ties: smallest label) and its gain in quality."""
    tot = state.groupBy("label").agg(F.sum("k").alias("tot"))
    placed = state.select("id", "label", "k", "two_m").join(tot, "label")
    near = links.join(placed.select(F.col("id").alias("dst"), "label", "tot"), "dst").groupBy(F.col("src").alias("id"), "label").agg(
        F.sum("w").alias("to"), F.max("tot").alias("tot"), F.lit(False).alias("own")
    )
    own = placed.select("id", "label", F.lit(0.0).alias("to"), "tot", F.lit(True).alias("own"))
    options = near.unionByName(own).groupBy("id", "label").agg(F.sum("to").alias("to"), F.max("tot").alias("tot"), F.max("own").alias("own"))
    options = options.join(state.select("id", "k", "two_m"), "id")
    rest = F.col("tot") - F.when(F.col("own"), F.col("k")).otherwise(F.lit(0.0))
    gain = 2 * (F.col("to") - F.col("k") * rest / F.col("two_m")) / F.col("two_m")
    chosen = options.withColumn("gain", gain).groupBy("id").agg(
        F.max_by("label", F.struct("gain", -F.col("label"))).alias("best"),
        F.max("gain").alias("most"),
        F.max(F.when(F.col("own"), F.col("gain"))).alias("stay"),
        F.max(F.when(F.col("own"), F.col("label"))).alias("now"),
        F.max("k").alias("k"),
        F.max("two_m").alias("two_m"),
    )
    # Sums in another order may differ in their last bits; the tasks that move vertices refuse such gains.
    better = F.col("most") > F.col("stay") + 2 * TOLERANCE
    return chosen.filter(better & (F.col("best") != F.col("now"))).select("id", "now", "best", "k", "two_m", (F.col("most") - F.col("stay")).alias("gain"))


def _first_blocks(links: DataFrame, nodes: DataFrame) -> tuple[DataFrame, bool]:
    """``id, block``: vertices in blocks of about ``BLOCK_EDGES`` edges, neighbours mostly together; and whether all graphs stay whole.

    Graphs that fit a block stay whole.  In others, vertices chosen by their
    hash spread over their neighbours for some steps, and each vertex goes to
    the one that most of its neighbours belong to.
    """
    degree = links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("deg"))
    held = cut(nodes.select("id", "g").join(degree, "id", "left").withColumn("deg", F.coalesce("deg", F.lit(0)) + 1))
    sizes = cut(held.groupBy("g").agg(F.sum("deg").alias("edges"), F.count("*").alias("n")))
    total = sizes.agg(F.sum("edges"), F.max("edges")).first()
    whole = F.pmod(F.xxhash64("g"), F.lit((total[0] or 0) // min(BLOCK_EDGES, SHARED_EDGES) + 1))
    if (total[1] or 0) <= BLOCK_EDGES:
        return held.select("id", whole.alias("block")), True
    small = held.join(sizes.filter(F.col("edges") <= BLOCK_EDGES).select("g"), "g").select("id", whole.alias("block"))
    large = held.join(sizes.filter(F.col("edges") > BLOCK_EDGES), "g")
    each = F.greatest(F.lit(1), F.floor(F.col("n") * BLOCK_EDGES / (2 * F.col("edges"))).cast("long"))
    spread = cut(large.select("id", each.alias("each"), F.when(F.pmod(F.xxhash64("id"), each) == 0, F.xxhash64("id", F.lit(1))).alias("block")))
    for _ in range(SPREAD):
        near = links.join(spread.filter("block is not null").select(F.col("id").alias("dst"), "block"), "dst")
        most = near.groupBy("src", "block").agg(F.sum("w").alias("w")).groupBy(F.col("src").alias("id")).agg(F.max_by("block", F.struct("w", "block")).alias("next"))
        spread = cut(spread.join(most, "id", "left").select("id", "each", F.coalesce("block", "next").alias("block")))
        if spread.filter("block is null").isEmpty():
            break
    rest = F.coalesce("block", F.floor(F.xxhash64("id") / F.col("each")))
    spread = spread.select("id", rest.alias("block")).join(degree, "id", "left")
    # A block that has grown too large is divided; any division is right, as blocks only say which moves are tried together.
    heavy = spread.groupBy("block").agg(F.ceil(F.sum(F.coalesce("deg", F.lit(0)) + 1) / (4 * BLOCK_EDGES)).alias("of"))
    divided = spread.join(heavy, "block").select("id", F.xxhash64("block", F.pmod(F.xxhash64("id", F.lit(2)), F.col("of"))).alias("block"))
    return small.unionByName(divided), False


def _settled_blocks(links: DataFrame, nodes: DataFrame) -> tuple[DataFrame, bool]:
    """Nodes with a ``label``: communities of each block by itself, connected, named by their smallest vertex; and whether all graphs stayed whole.

    Vertices begin alone, so a block's moves touch no community of another
    block, and what blocks gain in quality adds up.
    """
    blocks, whole = _first_blocks(links, nodes)
    blocks = cut(blocks)
    side = lambda name: blocks.select(F.col("id").alias(name), F.col("block").alias("b" + name))
    inside = links.join(side("src"), "src").join(side("dst"), "dst").filter("bsrc = bdst").select(F.col("bsrc").alias("block"), "src", "dst", "w")
    vertices = nodes.join(blocks, "id").select("block", "id", "k", "two_m")

    def run(vertices: pa.Table, edges: pa.Table) -> pa.Table:
        ids = np.sort(vertices["id"].to_numpy())
        at = np.searchsorted(ids, vertices["id"].to_numpy())
        k, two_m = np.zeros(len(ids)), np.ones(len(ids))
        k[at], two_m[at] = vertices["k"].to_numpy(), vertices["two_m"].to_numpy()
        ends = [np.searchsorted(ids, edges[c].to_numpy()) if edges.num_rows else np.zeros(0, np.int64) for c in ("src", "dst")]
        block = Block(len(ids), *ends, edges["w"].to_numpy() if edges.num_rows else np.zeros(0), k, two_m)
        found = settle(block, np.arange(len(ids))) if len(ids) else np.zeros(0, np.int64)
        return pa.table({"id": ids, "label": ids[found]})

    labels = vertices.groupBy("block").cogroup(inside.groupBy("block")).applyInArrow(run, "id long, label long")
    return cut(nodes.drop("label").join(labels, "id")), whole


def _label_blocks(wishes: DataFrame) -> DataFrame:
    """``label, block``: communities between which vertices wish to move, in blocks.

    Each points to the one with which most is to be gained; where two point
    to each other a block begins, and others follow their pointers to one.
    The pair with the most to gain is always in one block.
    """
    pair = [F.least("now", "best").alias("a"), F.greatest("now", "best").alias("b")]
    pairs = wishes.groupBy(*pair).agg(F.sum("gain").alias("gain")).withColumn("rank", F.struct("gain", F.xxhash64("a", "b"), "a", "b"))
    both = pairs.select(F.col("a").alias("label"), F.col("b").alias("to"), "rank").unionByName(pairs.select(F.col("b").alias("label"), F.col("a").alias("to"), "rank"))
    best = cut(both.groupBy("label").agg(F.max_by("to", "rank").alias("to")))
    back = best.select(F.col("label").alias("to"), F.col("to").alias("back"))
    rooted = best.join(back, "to", "left")
    pointer = cut(rooted.select("label", F.when(F.col("back") == F.col("label"), F.least("label", "to")).otherwise(F.col("to")).alias("block")))
    for _ in range(JUMPS):
        onward = pointer.select(F.col("label").alias("block"), F.col("block").alias("next"))
        pointer = cut(pointer.join(onward, "block").select("label", F.col("next").alias("block")))
    sizes = wishes.groupBy(F.col("now").alias("label")).agg(F.count("*").alias("movers"))
    weighed = pointer.join(sizes, "label", "left").join(best, "label")
    heavy = weighed.groupBy("block").agg(F.ceil(F.sum(F.coalesce("movers", F.lit(0))) / BLOCK_MOVERS).alias("of"))
    # The pair at the root of a block stays together, whatever the block's size.
    root = (F.col("block") == F.col("label")) | ((F.col("block") == F.col("to")) & (F.col("label") > F.col("to")))
    part = F.when(root | (F.col("of") <= 1), 0).otherwise(F.pmod(F.xxhash64("label", F.lit(3)), F.col("of")))
    return weighed.join(heavy, "block").select("label", F.xxhash64("block", part).alias("block"))


def _frontier_moves(links: DataFrame, state: DataFrame, wishes: DataFrame) -> DataFrame:
    """``id, best``: moves of the vertices that wish to, each block of communities by itself.

    A block's vertices move among its own communities only, so no other
    block changes what a move gains, and gains add up.
    """
    blocks = cut(_label_blocks(wishes))
    own = lambda c, b: blocks.select(F.col("label").alias(c), F.col("block").alias(b))
    movers = cut(wishes.join(own("now", "block"), "now").join(own("best", "other"), "best").filter("block = other").select("block", "id", "now", "k", "two_m"))
    tot = state.groupBy("label").agg(F.sum("k").alias("tot")).join(blocks, "label").select("block", F.lit(1).alias("kind"), F.col("label").alias("a"), F.col("tot").alias("x"))
    near = links.join(movers.select(F.col("id").alias("src"), "block"), "src")
    near = near.join(movers.select(F.col("id").alias("dst"), F.col("block").alias("other")), "dst", "left")
    among = near.filter("block = other").select("block", F.lit(2).alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("x"))
    still = near.filter("other is null or block <> other").join(state.select(F.col("id").alias("dst"), "label"), "dst").join(own("label", "at"), "label").filter("at = block")
    still = still.groupBy("block", F.col("src").alias("a"), F.col("label").alias("b")).agg(F.sum("w").alias("x")).withColumn("kind", F.lit(3))
    first = movers.select("block", F.lit(0).alias("kind"), F.col("id").alias("a"), F.col("now").alias("b"), F.col("k").alias("x"), F.col("two_m").alias("y"))
    rows = first.unionByName(tot, True).unionByName(among, True).unionByName(still, True)

    def run(table: pa.Table) -> pa.Table:
        kind, a, b, x, y = (table[c].fill_null(0).to_numpy() for c in ("kind", "a", "b", "x", "y"))
        v = np.flatnonzero(kind == 0)
        v = v[np.argsort(a[v], kind="stable")]
        ids, label = a[v], b[v].tolist()
        e = kind == 2
        block = Block(len(ids), np.searchsorted(ids, a[e]), np.searchsorted(ids, b[e]), x[e], x[v], y[v])
        fixed: list[dict[int, float]] = [{} for _ in ids]
        s = kind == 3
        for i, c, weight in zip(np.searchsorted(ids, a[s]).tolist(), b[s].tolist(), x[s].tolist()):
            fixed[i][c] = weight
        totals = dict(zip(a[kind == 1].tolist(), x[kind == 1].tolist()))
        block.move(label, totals, fixed)
        return pa.table({"id": ids, "best": np.array(label, np.int64)})

    return rows.groupBy("block").applyInArrow(run, "id long, best long")


def _move(links: DataFrame, state: DataFrame) -> tuple[DataFrame, int]:
    """Move nodes (with a ``label``) until none gains by a move alone; their state and the number of rounds.

    Only nodes that gain are looked at in a round.  Each round raises the
    quality, as its blocks' gains add up, so rounds end.
    """
    rounds = 0
    while True:
        wishes = cut(_wishes(links, state))
        if wishes.isEmpty():
            return state, rounds
        rounds += 1
        made = _frontier_moves(links, state, wishes)
        moved = state.join(made, "id", "left")
        state = cut(moved.select("id", "g", "k", "two_m", F.coalesce("best", "label").alias("label")))


def _merge(edges: DataFrame, moved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph of the communities of ``moved``: its edges without loops, and its nodes."""
    ends = moved.select(F.col("id").alias("src"), F.col("label").alias("a"))
    above = edges.join(ends, "src").join(ends.toDF("dst", "b"), "dst").filter("a <> b")
    above = above.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("w").alias("w"))
    nodes = moved.groupBy(F.col("label").alias("id")).agg(F.first("g").alias("g"), F.sum("k").alias("k"), F.max("two_m").alias("two_m"))
    return cut(above), cut(nodes)


def communities(edges: DataFrame, vertices: DataFrame, resolution: float | str = 1.0, group: str | None = None) -> DataFrame:
    """Modularity communities ``id, label``; every community is connected, and no single move raises the quality.

    ``edges`` holds both directions of each undirected edge as ``src, dst, w``.
    With ``group``, a column of ``vertices``, each group is a graph of its own
    and no edge may leave it; ``resolution`` may then name a column of
    ``vertices`` that is the same in a group.

    Blocks of bounded size settle first, each in a task: vertices, then whole
    communities move, at all levels.  Then vertices anywhere move that still
    gain (the frontier), then whole communities of the graph between blocks,
    in the same way, until nothing changes.  Communities that moves across
    blocks have left in parts are split, which raises the quality too.
    """
    edges = cut(edges.select("src", "dst", F.col("w").cast("double").alias("w")))
    weight = F.col(resolution).cast("double") if isinstance(resolution, str) else F.lit(float(resolution))
    groups = vertices.select("id", (F.col(group) if group else F.lit(0)).alias("g"), weight.alias("r"))
    strength = edges.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
    nodes = groups.join(strength, "id", "left").withColumn("k", F.coalesce("k", F.lit(0.0)))
    mass = nodes.groupBy("g").agg(F.sum("k").alias("two_m"))
    # A resolution scales what strengths count for, so it goes into the total once.
    two_m = F.when((F.col("two_m") > 0) & (F.col("r") > 0), F.col("two_m") / F.col("r")).otherwise(F.lit(1.0)).alias("two_m")
    nodes = cut(nodes.join(mass, "g").select("id", "g", F.when(F.col("r") > 0, F.col("k")).otherwise(F.lit(0.0)).alias("k"), two_m))
    links = cut(edges.filter("src <> dst"))
    state, whole = _settled_blocks(links, nodes)
    if whole:
        # Blocks end where no vertex and no community gains, and no edge leaves a graph.
        return state.select("id", "label")
    crossed, settled = False, False
    while True:
        state, low = _move(links, state)
        crossed, settled = crossed or low > 0, settled and not low
        if not settled:
            settled, above, moved = True, links, state
            members = state.select("id", "label")
            while True:
                above, parts = _merge(above, moved)
                alone = parts.withColumn("label", F.col("id"))
                if above.isEmpty() or _wishes(above, alone).isEmpty():
                    break
                settled = False
                moved, rounds = _move(above, _settled_blocks(above, parts)[0])
                crossed = crossed or rounds > 0
                up = moved.select(F.col("id").alias("label"), F.col("label").alias("up"))
                members = cut(members.join(up, "label").select("id", F.col("up").alias("label")))
            if not settled:
                state = cut(state.drop("label").join(members, "id"))
                continue
        labels = state.select("id", "label")
        if not crossed:
            return labels
        ends = labels.select(F.col("id").alias("src"), F.col("label").alias("a"))
        inside = links.join(ends, "src").join(ends.toDF("dst", "b"), "dst").filter("a = b")
        split = cut(components(inside, labels).select("id", F.col("component").alias("label")))
        if split.select("label").distinct().count() == labels.select("label").distinct().count():
            return split
        state, crossed, settled = cut(state.drop("label").join(split, "id")), False, False


def jaccard_graph(edges: DataFrame, k: int) -> DataFrame:
    """Directed k-neighbour edges reweighted by the overlap of neighbour sets.

    The weight is the number of shared neighbours over the size of the union
    (at most 2k); pairs without a shared neighbour are dropped.
    """
    # At most k neighbours each.
    lists = cut(edges.groupBy("src").agg(F.collect_set("dst").alias("near")))
    asked = lists.select("src", "near", F.explode("near").alias("dst"))
    met = asked.join(lists.toDF("dst", "other"), "dst").select(
        "src", "dst", F.size(F.array_intersect("near", "other")).alias("common"), (F.size("near") + F.size("other")).alias("both")
    )
    weighted = met.filter("common > 0").select("src", "dst", (F.col("common") / (F.col("both") - F.col("common"))).alias("w"))
    back = weighted.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    return weighted.unionByName(back).groupBy("src", "dst").agg((F.sum("w") / 2).alias("w"))
