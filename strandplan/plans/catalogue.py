"""The query catalogue of the planning operators, and the oracle's SQL by query."""

from . import attribute_queries, delivery_queries, finalise_queries, graph_queries, spatial_queries, terminal_queries

_MODULES = (attribute_queries, spatial_queries, graph_queries, terminal_queries, delivery_queries, finalise_queries)
QUERIES: dict = {k: f for m in _MODULES for k, f in m.Q.items()}
SQL: dict = {k: s for m in _MODULES for k, s in m.S.items()}
FLAGSHIP = "a3_d3_summary"
