"""Registered queries; importing this package fills the registry."""

from . import figures, grids, groups, joins, learn, procedures, rows, sources, streams, text
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES", "figures", "grids", "groups", "joins", "learn", "procedures", "rows", "sources", "streams", "text"]
