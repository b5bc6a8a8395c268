"""Registered queries; importing this package registers all of them."""

from cellspark.plans import registry

from cellspark.plans import (  # noqa: F401
    select_queries,
    predicate_queries,
    aggregate_queries,
    function_queries,
    cast_queries,
    mutation_queries,
    reconcile_queries,
    view_queries,
    text_queries,
    replica_queries,
    stats_queries,
    source_queries,
    udf_queries,
    stream_queries,
)

QUERIES = registry.QUERIES
ORACLE = registry.ORACLE
