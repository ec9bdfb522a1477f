"""Operators for preparing training text; nothing else in the library imports them."""

from musterroll.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
