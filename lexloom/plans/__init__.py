"""Queries over the harness tables; importing this package registers them."""

from . import corpus_queries, publish_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
