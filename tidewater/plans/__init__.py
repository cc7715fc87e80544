"""Importing this package registers every named query."""

from tidewater.plans import (  # noqa: F401
    basics,
    changes,
    files,
    joins,
    quality,
    scalars,
    streams,
    texts,
    windows,
)
from tidewater.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
