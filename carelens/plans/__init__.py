"""Plan-level helpers (bounded broadcast, distributed ordering) and the query registry."""
