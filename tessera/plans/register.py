"""All registered queries."""

from tessera.plans import catalogue_queries, cell_queries, spatial_queries, transcript_queries  # noqa: F401
from tessera.plans.inputs import ORACLES, QUERIES  # noqa: F401
