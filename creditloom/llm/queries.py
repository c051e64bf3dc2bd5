"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from creditloom.llm import queries_text, queries_tokens
from creditloom.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "queries_text", "queries_tokens"]
