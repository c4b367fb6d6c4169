"""All registered queries with their SQL twins."""

from tidemark.queries import (  # noqa: F401  (importing registers)
    aggregates,
    joins,
    jobs,
    projection,
    scalars,
    skew,
    sets,
    sources,
    streams,
    tables,
    udfs,
    windows,
)
from tidemark.queries._registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
