"""Registered queries. Importing this package fills the registry."""

from tallyvein.plans import clusters, graph_queries, rating_queries, relational, results, scans, sketches  # noqa: F401
from tallyvein.plans.registry import QUERIES  # noqa: F401
