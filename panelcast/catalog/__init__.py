"""Registered queries, each beside the SQL that says the same."""

from . import aggregates, joins, models, panels, rows, scans, selection, windows  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
