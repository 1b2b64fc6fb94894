"""Column names, aliases, defaults and catalogue layout."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Canonical transcript columns.
REQUIRED = ("x", "y", "gene")
OPTIONAL = ("cell_id", "fov", "CellComp", "qv", "z")

# Accepted column names per canonical column, in order of preference.
ALIASES = {
    "x": ("x_global_px", "x_location", "global_x", "X"),
    "y": ("y_global_px", "y_location", "global_y", "Y"),
    "gene": ("target", "feature_name", "geneID", "Gene", "gene_name"),
    "cell_id": ("cell", "cell_id", "cell_ID", "barcode_id", "CellID", "cell_label"),
    "fov": ("fov", "fov_name", "FOV"),
    "CellComp": ("CellComp", "cell_comp", "compartment"),
    "qv": ("qv", "QV", "quality_value"),
}

# Compartments that count as inside the cell.
INTRACELLULAR = ("Nuclear", "Cytoplasm")

# The processing steps in their order.
STEPS = (
    "denoise",
    "patchify",
    "segmentation",
    "spatial_domain",
    "subcellular_spatial_domain",
    "analysis",
    "annotation",
    "spatial_analysis",
    "subcellular_analysis",
)

# Catalogue columns as (name, Spark type, required, category).
CATALOGUE = (
    ("id", "string", True, "identity"),
    ("project_id", "string", True, "identity"),
    ("platform", "string", True, "identity"),
    ("name", "string", True, "identity"),
    ("project_url", "string", False, "provenance"),
    ("download_url", "string", False, "provenance"),
    ("publication_doi", "string", False, "provenance"),
    ("data_source", "string", True, "provenance"),
    ("species", "string", True, "biological"),
    ("tissue", "string", True, "biological"),
    ("disease_state", "string", False, "biological"),
    ("spatial_resolution_um", "double", False, "technical"),
    ("gene_panel_size", "bigint", False, "technical"),
    ("estimated_cell_count", "bigint", False, "technical"),
    ("data_size_bytes", "bigint", False, "technical"),
    ("data_size_display", "string", False, "technical"),
    ("status", "string", True, "technical"),
    ("local_path", "string", False, "storage"),
    ("file_name", "string", False, "storage"),
)
CATALOGUE_COLUMNS = tuple(c[0] for c in CATALOGUE)
CATALOGUE_REQUIRED = tuple(c[0] for c in CATALOGUE if c[2])

# Catalogue columns shown first.
CATALOGUE_PRIORITY = (
    "id",
    "platform",
    "name",
    "species",
    "tissue",
    "disease_state",
    "estimated_cell_count",
    "data_size_display",
    "status",
    "project_url",
    "download_url",
)


class InputError(ValueError):
    """The input data does not have what an operator needs."""


def find_column(df: DataFrame, canonical: str) -> str | None:
    """Name of the column of ``df`` that stands for ``canonical``, or None."""
    names = (canonical, *ALIASES.get(canonical, ()))
    return next((n for n in names if n in df.columns), None)


def need_column(df: DataFrame, canonical: str) -> str:
    """Like :func:`find_column`, but a missing column is an error."""
    found = find_column(df, canonical)
    if found is None:
        raise InputError(f"no column for '{canonical}' among {sorted(df.columns)}")
    return found
