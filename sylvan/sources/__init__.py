"""Sources and sinks: table scans, in-memory fixtures, persistence, model I/O."""

from sylvan.sources.tables import TABLES, read_csv, read_table, spread, write_csv
from sylvan.sources.persist import load_model, materialized, save_model

__all__ = [
    "TABLES",
    "load_model",
    "materialized",
    "read_csv",
    "read_table",
    "save_model",
    "spread",
    "write_csv",
]
