"""All registered queries, in the order of the operator inventory."""

from . import (  # noqa: F401  (importing registers the queries)
    queries_tables,
    queries_expressions,
    queries_aggregates,
    queries_joins,
    queries_monitoring,
    queries_learning,
    queries_streaming,
)
from .registry import CATALOG, Query  # noqa: F401
