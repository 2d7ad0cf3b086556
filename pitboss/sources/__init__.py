"""Sources and sinks: raw scans, bronze schemas and fixture adapters, incremental extract, table maintenance."""

from .adapters import Bronze, bronze_for, reset_accessors
from .schemas import BRONZE, schema
from .tables import forget_scans, read_table

__all__ = ["Bronze", "bronze_for", "reset_accessors", "BRONZE", "schema", "forget_scans", "read_table"]
