"""Queries over transcripts: ingestion, denoising, cell assignment, patches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import patches, transcripts as tr
from tessera.operators.cells import cell_summary, qc_filter
from tessera.plans.inputs import Inputs, query, r6
from tessera.runtime import new_path
from tessera.sources import sinks, transcripts as src

POINTS = "SELECT x, y, gene, cell_id, CAST(fov AS VARCHAR) AS fov, CellComp FROM transcripts"


@query(
    "cells_after_denoise_and_qc",
    """SELECT cell_id, count(*) AS n_transcripts, count(DISTINCT gene) AS n_genes, round(avg(x), 6) AS x, round(avg(y), 6) AS y
    FROM inside WHERE cell_id IS NOT NULL AND cell_id <> '' GROUP BY cell_id HAVING count(*) >= 10 AND count(DISTINCT gene) >= 10""",
)
def cells_after_denoise_and_qc(t: Inputs):
    """Transcripts, genes and centroid per cell after intracellular denoising and quality control."""
    cells = qc_filter(cell_summary(tr.provided_cells(tr.denoise(t.transcripts(), "intracellular"))), 10, 10)
    return cells.select("cell_id", "n_transcripts", "n_genes", r6("x").alias("x"), r6("y").alias("y"))


def _written(t: Inputs, name: str, df, kind: str = "csv", **options) -> str:
    path = new_path(t.spark, name)
    df.write.format(kind).options(**options).save(path)
    return path


def _as_cosmx(t: Inputs) -> str:
    out = t.transcripts().select(
        "fov", F.col("x").alias("x_global_px"), F.col("y").alias("y_global_px"), F.col("gene").alias("target"), "CellComp", F.col("cell_id").alias("cell")
    )
    return _written(t, "cosmx.csv", out, header=True)


def _as_xenium(t: Inputs) -> str:
    out = t.transcripts().select(
        F.col("x").alias("x_location"), F.col("y").alias("y_location"), F.col("gene").alias("feature_name"), "cell_id",
        F.col("fov").cast("string").alias("fov_name"), (F.col("x") / 10).alias("qv"),
    )
    return _written(t, "xenium.parquet", out, "parquet")


def _as_merfish(t: Inputs) -> str:
    out = t.transcripts().select(
        F.col("cell_id").alias("barcode_id"), F.col("x").alias("global_x"), F.col("y").alias("global_y"),
        F.lit(-1).alias("x"), F.lit(-1).alias("y"), "fov", "gene",
    )
    return _written(t, "merfish.csv.gz", out, header=True, compression="gzip")


def _as_stereoseq(t: Inputs) -> str:
    out = t.transcripts().select(F.col("gene").alias("geneID"), "x", "y", F.col("fov").alias("count"))
    return _written(t, "stereo.gem", out, header=True, sep="\t")


@query("scan_cosmx", POINTS)
def scan_cosmx(t: Inputs):
    return src.ingest(t.spark, _as_cosmx(t)).select("x", "y", "gene", "cell_id", "fov", "CellComp")


@query("scan_xenium", "SELECT x, y, gene, cell_id, CAST(fov AS VARCHAR) AS fov, 'Unknown' AS CellComp, x / 10 AS qv FROM transcripts")
def scan_xenium(t: Inputs):
    return src.ingest(t.spark, _as_xenium(t)).select("x", "y", "gene", "cell_id", "fov", "CellComp", "qv")


@query("scan_merfish", "SELECT x, y, gene, cell_id, CAST(fov AS VARCHAR) AS fov FROM transcripts")
def scan_merfish(t: Inputs):
    return src.ingest(t.spark, _as_merfish(t)).select("x", "y", "gene", "cell_id", "fov")


@query("scan_stereoseq", "SELECT x, y, gene, CAST(NULL AS VARCHAR) AS cell_id, '0' AS fov FROM transcripts")
def scan_stereoseq(t: Inputs):
    return src.ingest(t.spark, _as_stereoseq(t)).select("x", "y", "gene", "cell_id", "fov")


@query(
    "platform_detection",
    """SELECT p AS platform, (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey) AS n_rows
    FROM (VALUES ('cosmx'), ('xenium'), ('merfish'), ('stereoseq')) v(p)""",
)
def platform_detection(t: Inputs):
    """Platform told from the file, and the rows its reader then finds."""
    whole = None
    for path in (_as_cosmx(t), _as_xenium(t), _as_merfish(t), _as_stereoseq(t)):
        name = src.detect_platform(t.spark, path)
        one = src.ingest(t.spark, path, name).agg(F.lit(name).alias("platform"), F.count("*").alias("n_rows"))
        whole = one if whole is None else whole.unionByName(one)
    return whole


@query("cell_id_override", "SELECT x, y, gene, CAST(fov AS VARCHAR) AS cell_id, CAST(fov AS VARCHAR) AS fov FROM transcripts")
def cell_id_override(t: Inputs):
    return src.ingest(t.spark, _as_merfish(t), "merfish", cell_id_column="fov").select(
        "x", "y", "gene", "cell_id", F.col("cell_id").alias("fov")
    )


@query(
    "type_coercion",
    """SELECT try_cast(xt AS DOUBLE) AS x, try_cast(yt AS DOUBLE) AS y, gene FROM
    (SELECT CASE WHEN fov = 3 THEN 'bad' ELSE CAST(x AS VARCHAR) END AS xt, CASE WHEN fov = 4 THEN '' ELSE CAST(y AS VARCHAR) END AS yt, gene FROM transcripts)""",
)
def type_coercion(t: Inputs):
    text = t.transcripts().select(
        F.when(F.col("fov") == 3, "bad").otherwise(F.col("x").cast("string")).alias("X"),
        F.when(F.col("fov") == 4, "").otherwise(F.col("y").cast("string")).alias("Y"),
        "gene",
    )
    return src.to_points(text.select(F.col("X").alias("x"), F.col("Y").alias("y"), "gene"))


@query(
    "count_expansion",
    "SELECT gene, CAST(sum(c) AS BIGINT) AS n FROM (SELECT gene, CAST(fov * 20 - 30 AS BIGINT) AS c FROM transcripts) WHERE c > 0 GROUP BY gene",
)
def count_expansion(t: Inputs):
    counted = t.transcripts().withColumn("count", F.col("fov") * 20 - 30)
    return src.expand_counts(counted).groupBy("gene").agg(F.sum("count").alias("n"))


@query(
    "first_cells",
    """SELECT row_id, cell_id, gene FROM transcripts WHERE cell_id IN
    (SELECT cell_id FROM transcripts WHERE cell_id IS NOT NULL GROUP BY cell_id ORDER BY min(row_id) LIMIT 1000)""",
)
def first_cells(t: Inputs):
    return src.first_cells(t.numbered()).select("row_id", "cell_id", "gene")


@query(
    "ingestion_summary",
    """SELECT 'cosmx' AS platform, count(*) AS n_transcripts, count(DISTINCT cell_id) AS n_cells, count(DISTINCT gene) AS n_genes,
    count(DISTINCT fov) AS n_fovs, round(avg(CASE WHEN CellComp = 'Nuclear' THEN 1.0 ELSE 0.0 END), 6) AS nuclear_fraction,
    round(avg(CASE WHEN CellComp = 'Cytoplasm' THEN 1.0 ELSE 0.0 END), 6) AS cytoplasm_fraction FROM transcripts""",
)
def ingestion_summary(t: Inputs):
    s = tr.ingestion_summary(t.transcripts(), "cosmx")
    return s.withColumns({c: r6(c) for c in ("nuclear_fraction", "cytoplasm_fraction")})


@query(
    "cell_id_validity",
    "SELECT bool_or(coalesce(trim(cell_id) NOT IN ('', 'nan', 'None', '0'), false)) AS has_cell_id FROM transcripts",
)
def cell_id_validity(t: Inputs):
    return tr.has_valid_cell_id(t.transcripts())


@query("compartment_validity", "SELECT bool_or(CellComp IN ('Nuclear', 'Cytoplasm')) AS has_compartment FROM transcripts")
def compartment_validity(t: Inputs):
    return tr.has_valid_compartment(t.transcripts())


@query("denoise_none", "SELECT x, y, gene, cell_id, fov, CellComp FROM transcripts")
def denoise_none(t: Inputs):
    return tr.denoise(t.transcripts(), "none")


@query("denoise_intracellular", "SELECT x, y, gene, cell_id, fov, CellComp FROM inside")
def denoise_intracellular(t: Inputs):
    return tr.denoise(t.transcripts(), "intracellular")


@query("denoise_nuclear_only", "SELECT x, y, gene, cell_id, fov, CellComp FROM transcripts WHERE CellComp = 'Nuclear'")
def denoise_nuclear_only(t: Inputs):
    return tr.denoise(t.transcripts(), "nuclear_only")


@query(
    "denoise_summary",
    """SELECT 'intracellular' AS denoise_backend, b AS before_transcripts, a AS after_transcripts, b - a AS dropped_transcripts,
    round((b - a) / CAST(b AS DOUBLE), 6) AS drop_ratio
    FROM (SELECT count(*) AS b, count(*) FILTER (WHERE CellComp IN ('Nuclear', 'Cytoplasm')) AS a FROM transcripts)""",
)
def denoise_summary(t: Inputs):
    raw = t.transcripts()
    return tr.denoise_summary(raw, tr.denoise(raw), "intracellular").withColumn("drop_ratio", r6("drop_ratio"))


@query("segmentation_provided_cells", "SELECT x, y, gene, cell_id, fov FROM seg")
def segmentation_provided_cells(t: Inputs):
    return t.segmented().select("x", "y", "gene", "cell_id", "fov")


@query(
    "segmentation_fov_cells",
    "SELECT x, y, gene, CAST(fov AS VARCHAR) || '_' || cell_id AS cell_id, fov FROM transcripts",
)
def segmentation_fov_cells(t: Inputs):
    return tr.fov_cells(t.transcripts()).select("x", "y", "gene", "cell_id", "fov")


@query(
    "segmentation_mask_lookup",
    """SELECT t.x + 0.5 AS x, t.y + 0.5 AS y, t.gene, 'cellpose_' || CAST(m.mask_id AS VARCHAR) AS cell_id
    FROM transcripts t JOIN (SELECT DISTINCT CAST(x AS BIGINT) AS px, CAST(y AS BIGINT) AS py, CAST(x + 3 * y AS BIGINT) % 5 AS mask_id FROM transcripts) m
    ON CAST(round_even(t.x + 0.5, 0) AS BIGINT) = m.px AND CAST(round_even(t.y + 0.5, 0) AS BIGINT) = m.py WHERE m.mask_id > 0""",
)
def segmentation_mask_lookup(t: Inputs):
    """Labels of a raster that is painted from the transcripts; half pixels round to even."""
    raw = t.transcripts()
    mask = raw.select(F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y")).distinct().withColumn(
        "mask_id", (F.col("x") + 3 * F.col("y")) % 5
    )
    moved = raw.withColumns({"x": F.col("x") + 0.5, "y": F.col("y") + 0.5})
    return tr.mask_cells(moved, mask).select("x", "y", "gene", "cell_id")


@query(
    "segmentation_external",
    "SELECT row_id, gene, 'baysor_' || CAST(CAST(x AS BIGINT) % 7 AS VARCHAR) AS cell_id FROM transcripts WHERE CAST(x AS BIGINT) % 7 <> 0",
)
def segmentation_external(t: Inputs):
    rows = t.numbered()
    assigned = rows.select("row_id", (F.col("x").cast("bigint") % 7).alias("segmentation"))
    return tr.external_cells(rows, assigned).select("row_id", "gene", "cell_id")


@query(
    "segmentation_summary",
    "SELECT 'provided_cells' AS segmentation_backend, count(*) AS n_transcripts_assigned, count(DISTINCT cell_id) AS n_cells_assigned FROM seg",
)
def segmentation_summary(t: Inputs):
    return tr.segmentation_summary(t.segmented(), "provided_cells")


@query("compartment_counts", "SELECT CellComp AS value, count(*) AS n FROM transcripts GROUP BY 1")
def compartment_counts(t: Inputs):
    return tr.distribution(t.transcripts(), "CellComp")


@query(
    "cell_id_fractions",
    "SELECT coalesce(cell_id, 'nan') AS value, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 9) AS fraction FROM transcripts GROUP BY 1",
)
def cell_id_fractions(t: Inputs):
    return tr.fractions(t.transcripts(), "cell_id").withColumn("fraction", r6("fraction", 9))


@query(
    "top_slices",
    """WITH g AS (SELECT gene AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, gene) AS rn FROM transcripts GROUP BY gene)
    SELECT CASE WHEN rn <= 6 THEN value ELSE 'Other' END AS value, CAST(sum(n) AS BIGINT) AS n,
    round(sum(n) / CAST((SELECT sum(n) FROM g) AS DOUBLE), 9) AS fraction FROM g GROUP BY 1""",
)
def top_slices(t: Inputs):
    return tr.top_slices(tr.distribution(t.transcripts(), "gene")).withColumn("fraction", r6("fraction", 9))


_GRID = """WITH b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM transcripts),
    n AS (SELECT x0, y0, greatest(CAST(ceil((x1 - x0) / 450.0) AS BIGINT), 1) AS nc, greatest(CAST(ceil((y1 - y0) / 450.0) AS BIGINT), 1) AS nr FROM b),
    c AS (SELECT i AS patch_col, x0 + i * 450 AS lo, i = nc - 1 AS last FROM (SELECT x0, nc, unnest(range(nc)) AS i FROM n)),
    r AS (SELECT i AS patch_row, y0 + i * 450 AS lo, i = nr - 1 AS last FROM (SELECT y0, nr, unnest(range(nr)) AS i FROM n)),
    p AS (SELECT t.*, patch_col, patch_row FROM transcripts t
      JOIN c ON t.x >= c.lo AND (t.x < c.lo + 500 OR c.last) JOIN r ON t.y >= r.lo AND (t.y < r.lo + 500 OR r.last))
"""


@query("patch_assignment", _GRID + "SELECT x, y, gene, cell_id, patch_col, patch_row FROM p")
def patch_assignment(t: Inputs):
    return patches.assign_patches(t.transcripts()).select("x", "y", "gene", "cell_id", "patch_col", "patch_row")


@query(
    "patched_segmentation",
    _GRID
    + """, k AS (SELECT count(DISTINCT (patch_col, patch_row)) AS n FROM p)
    SELECT x, y, gene, 'P' || CAST(patch_col AS VARCHAR) || 'x' || CAST(patch_row AS VARCHAR) || '_' || cell_id AS cell_id
    FROM p, k WHERE cell_id IS NOT NULL AND cell_id <> '' AND k.n > 1""",
)
def patched_segmentation(t: Inputs):
    return patches.patched_segmentation(t.transcripts()).select("x", "y", "gene", "cell_id")


@query("overlap_copies_dropped", "SELECT row_id, cell_id, gene FROM seg")
def overlap_copies_dropped(t: Inputs):
    """Patched transcripts kept once each, back under their plain cell id."""
    named = patches.patched_segmentation(t.numbered(), keep_patch=True)
    once = patches.drop_overlap_copies(named)
    return once.select("row_id", F.regexp_replace("cell_id", "^P[0-9]+x[0-9]+_", "").alias("cell_id"), "gene")


_HULL = """WITH red AS (SELECT DISTINCT cell_id, x, y FROM (SELECT cell_id, x, min(y) AS lo, max(y) AS hi FROM seg GROUP BY 1, 2)
      CROSS JOIN (VALUES (0), (1)) v(k), LATERAL (SELECT CASE WHEN k = 0 THEN lo ELSE hi END AS y)),
    e AS (SELECT p.cell_id, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM red p JOIN red q ON p.cell_id = q.cell_id AND (p.x <> q.x OR p.y <> q.y)),
    bad AS (SELECT DISTINCT e.cell_id, px, py, qx, qy FROM e JOIN red r ON e.cell_id = r.cell_id
      WHERE (qx - px) * (r.y - py) - (qy - py) * (r.x - px) < 0
         OR ((qx - px) * (r.y - py) - (qy - py) * (r.x - px) = 0
             AND ((r.x - px) * (qx - px) + (r.y - py) * (qy - py) < 0
               OR (r.x - qx) * (px - qx) + (r.y - qy) * (py - qy) < 0))),
    ring AS (SELECT e.* FROM e LEFT JOIN bad b ON e.cell_id = b.cell_id AND e.px = b.px AND e.py = b.py AND e.qx = b.qx AND e.qy = b.qy WHERE b.cell_id IS NULL)
"""


@query(
    "cell_boundaries",
    _HULL
    + """SELECT cell_id, count(*) AS n_vertices, round(sum(px * qy - qx * py) / 2, 6) AS area,
    round(sum((px + qx) * (px * qy - qx * py)) / (3 * sum(px * qy - qx * py)), 6) AS centroid_x,
    round(sum((py + qy) * (px * qy - qx * py)) / (3 * sum(px * qy - qx * py)), 6) AS centroid_y,
    (SELECT count(*) FROM seg s WHERE s.cell_id = ring.cell_id) AS n_transcripts FROM ring GROUP BY cell_id""",
)
def cell_boundaries(t: Inputs):
    """Convex outline of each cell, its area and its centroid."""
    b = patches.cell_boundaries(t.transcripts())
    return b.select(
        "cell_id", F.size("geometry").cast("bigint").alias("n_vertices"), r6("area").alias("area"),
        r6("centroid_x").alias("centroid_x"), r6("centroid_y").alias("centroid_y"), "n_transcripts",
    )


@query(
    "boundary_export",
    _HULL
    + """SELECT cell_id, round(sum(px * qy - qx * py) / 2, 6) AS area, (SELECT count(*) FROM seg s WHERE s.cell_id = ring.cell_id) AS n_transcripts,
    count(*) + 1 AS n_ring_points, true AS closed FROM ring GROUP BY cell_id""",
)
def boundary_export(t: Inputs):
    """Outlines written with their polygon text and read back; the text must be a closed ring."""
    path = new_path(t.spark, "boundaries.parquet")
    sinks.boundary_export(patches.cell_boundaries(t.transcripts())).write.parquet(path)
    ring = F.split(F.regexp_extract("geometry_wkt", r"^POLYGON \(\((.*)\)\)$", 1), ", ")
    return t.spark.read.parquet(path).select(
        "cell_id", r6("area").alias("area"), "n_transcripts", F.size(ring).cast("bigint").alias("n_ring_points"),
        (ring[0] == F.element_at(ring, -1)).alias("closed"),
    )


@query("overlapping_cells_resolved")
def overlapping_cells_resolved(t: Inputs):
    """Cells split by patches and merged where their outlines cover each other."""
    mapping, merged = patches.resolve_outlines(patches.patch_outlines(t.transcripts(), width=500.0, overlap=150.0))
    return mapping.join(merged.select("resolved_id", "n_points"), "resolved_id")


@query(
    "overlapping_boxes",
    _GRID
    + """, o AS (SELECT 'P' || patch_col || 'x' || patch_row || '_' || cell_id AS id, patch_col, patch_row, min(x) AS x1, max(x) AS x2, min(y) AS y1, max(y) AS y2
      FROM p WHERE cell_id IS NOT NULL GROUP BY patch_col, patch_row, cell_id HAVING min(x) < max(x) AND min(y) < max(y)),
    m AS (SELECT a.id AS src, b.id AS dst, (least(a.x2, b.x2) - greatest(a.x1, b.x1)) * (least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS shared,
      least((a.x2 - a.x1) * (a.y2 - a.y1), (b.x2 - b.x1) * (b.y2 - b.y1)) AS smaller
      FROM o a JOIN o b ON a.id < b.id AND (a.patch_col <> b.patch_col OR a.patch_row <> b.patch_row) AND a.x1 < b.x2 AND b.x1 < a.x2 AND a.y1 < b.y2 AND b.y1 < a.y2)
    SELECT src, dst, round(shared, 6) AS shared, round(smaller, 6) AS smaller FROM m WHERE shared > 0.5 * smaller""",
)
def overlapping_boxes(t: Inputs):
    """Boxes around the cells of each patch that cover each other by more than half of the smaller one."""
    named = patches.patched_segmentation(t.transcripts(), keep_patch=True).filter("cell_id is not null")
    boxes = named.groupBy(F.col("cell_id").alias("id"), "patch_col", "patch_row").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("x", "y") for n, f in (("low", F.min), ("high", F.max))]
    ).filter("low_x < high_x and low_y < high_y")
    corners = boxes.select(
        "id", "patch_col", "patch_row", F.array("low_x", "high_x", "high_x", "low_x").alias("hull_x"),
        F.array("low_y", "low_y", "high_y", "high_y").alias("hull_y"),
    )
    return patches.overlapping_cells(corners).select("src", "dst", r6("shared").alias("shared"), r6("smaller").alias("smaller"))


@query("union_of_patches", _GRID + "SELECT patch_col, count(*) AS n FROM p GROUP BY 1")
def union_of_patches(t: Inputs):
    patched = patches.assign_patches(t.transcripts())
    even, odd = patched.filter("patch_col % 2 = 0"), patched.filter("patch_col % 2 = 1")
    return patches.union_patches(even, odd).groupBy("patch_col").agg(F.count("*").alias("n"))


@query("transcript_sink", "SELECT fov, cell_id, count(*) AS n, sum(x) AS sx FROM seg GROUP BY 1, 2")
def transcript_sink(t: Inputs):
    """Segmented transcripts written by field of view and read back."""
    path = new_path(t.spark, "segmented.parquet")
    sinks.write_transcripts(t.segmented(), path, partition_by="fov")
    back = t.spark.read.parquet(path)
    return back.groupBy(F.col("fov").cast("bigint").alias("fov"), "cell_id").agg(F.count("*").alias("n"), F.sum("x").alias("sx"))


@query(
    "transcript_sample",
    """SELECT x, y, gene, cell_id, CellComp FROM transcripts ORDER BY md5(CAST(row_id AS VARCHAR) || ':7'), row_id
    LIMIT (SELECT least(count(*), greatest(1000, CAST(floor(count(*) * 0.01) AS BIGINT))) FROM transcripts)""",
)
def transcript_sample(t: Inputs):
    return sinks.transcript_sample(t.numbered(), 0.01, seed=7)


@query(
    "cell_detail",
    "SELECT x, y, '0' AS subcellular_domain, gene, CellComp AS cellcomp, CAST(fov AS INTEGER) AS fov FROM transcripts WHERE cell_id = '7'",
)
def cell_detail(t: Inputs):
    from tessera.sources.reports import cell_detail as detail

    return detail(t.transcripts(), "7")


@query(
    "cell_overview",
    """SELECT count(*) AS n_transcripts, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y
    FROM transcripts WHERE cell_id = '7'""",
)
def cell_overview(t: Inputs):
    from tessera.sources.reports import cell_detail as detail, cell_overview as overview

    return overview(detail(t.transcripts(), "7"))


@query(
    "cell_overview_of_gene",
    """WITH d AS (SELECT * FROM transcripts WHERE cell_id = '7' AND gene = (SELECT min(gene) FROM transcripts WHERE cell_id = '7'))
    SELECT count(*) AS n_transcripts, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM d""",
)
def cell_overview_of_gene(t: Inputs):
    """One cell's first gene alone."""
    from tessera.sources.reports import cell_detail as detail, cell_overview as overview

    gene = t.transcripts().filter("cell_id = '7'").agg(F.min("gene")).first()[0]
    return overview(detail(t.transcripts(), "7", gene))


@query("cell_gene_ranking", "SELECT gene AS value, count(*) AS n FROM transcripts WHERE cell_id = '7' GROUP BY 1")
def cell_gene_ranking(t: Inputs):
    from tessera.sources.reports import cell_detail as detail, counts_of

    return counts_of(detail(t.transcripts(), "7"), "gene")


@query("alias_resolution", "SELECT gene, cell_id, count(*) AS n, sum(x) AS x, sum(y) AS y FROM seg GROUP BY 1, 2")
def alias_resolution(t: Inputs):
    """Counts over columns that have an instrument's names."""
    from tessera.schema import need_column

    named = t.segmented().withColumnsRenamed({"x": "x_global_px", "y": "global_y", "gene": "feature_name", "cell_id": "cell_ID"})
    found = named.select(*[F.col(need_column(named, c)).alias(c) for c in ("gene", "cell_id", "x", "y")])
    return found.groupBy("gene", "cell_id").agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"))
