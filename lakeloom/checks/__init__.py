"""Registered queries over the test tables, each with its independent SQL."""

from __future__ import annotations

from lakeloom.checks.registry import REGISTRY, Check, check
from lakeloom.checks import (  # noqa: F401  (each module registers its queries)
    exploring,
    marts,
    reports,
    ranks,
    relations,
    scalars,
    quality,
    imports,
    lakes,
    increments,
    upkeep,
    streams,
)

__all__ = ["REGISTRY", "Check", "check"]
