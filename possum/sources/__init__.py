"""Scans over the daily-snapshot tables, the test-table adapters, and the sink."""

from .scans import extract, scan_since, scan_snapshot, scan_upto  # noqa: F401
from .sinks import load  # noqa: F401
