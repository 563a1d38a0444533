"""Registered queries.  Importing this package registers every plan module."""

from sylvan.plans import doc_queries, html_queries, ingest_queries, learn_queries, player_queries, prep_queries, trees  # noqa: F401
from sylvan.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
