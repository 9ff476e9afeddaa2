"""One query per operator, over the given tables, each with its SQL twin."""

from . import from_dims, from_documents, from_events, from_lines, from_orders, from_pages, from_study  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
