"""Operators for training-data pipelines; nothing else in the library imports them."""

from __future__ import annotations

from lakeloom.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
