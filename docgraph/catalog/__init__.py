"""The operators applied to the given tables, each next to its SQL counterpart."""

from docgraph.catalog.base import ORACLES, QUERIES  # noqa: F401
from docgraph.catalog import (  # noqa: F401
    aggregates,
    graphs,
    identity,
    links,
    quality,
    ranking,
    scoring,
    sourcing,
    streams,
    texts,
)
