"""Registered queries over the star-schema tables, each with its SQL counterpart."""

from stayline.queries import cleaning, exploring, learning, models, scoring, sources  # noqa: F401
from stayline.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
