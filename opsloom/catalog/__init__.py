"""Registered queries over the driver tables, each with its SQL counterpart."""

from opsloom.catalog import (
    baselines,
    decisions,
    evaluation,
    features,
    learned,
    monitoring,
    quality,
    sources,
    targets,
)
from opsloom.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "baselines",
    "decisions",
    "evaluation",
    "features",
    "learned",
    "monitoring",
    "quality",
    "sources",
    "targets",
]
