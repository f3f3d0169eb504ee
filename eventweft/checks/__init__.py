"""Queries over the star tables that exercise each operator, with SQL for the same answer."""

from __future__ import annotations

from eventweft.checks import extracting, families, identity, landing, modelling, quality, relating, scalars, stays
from eventweft.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "extracting", "families", "identity", "landing", "modelling", "quality", "relating", "scalars", "stays"]
