"""Training-data operators, their queries and their SQL counterparts."""

from stayline.llm import queries_scoring, queries_text, queries_vectors  # noqa: F401
from stayline.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
