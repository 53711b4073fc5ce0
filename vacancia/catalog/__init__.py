"""Queries over the given tables, each next to the SQL that gives the same rows."""

from vacancia.catalog.registry import oracles, queries  # noqa: F401
from vacancia.catalog import (  # noqa: F401  (each module registers its queries)
    changes, feeds, matching, normalise, pages, places, serving, streams,
)
