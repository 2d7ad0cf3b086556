"""Structured Streaming form of the incremental ingest."""

from .incremental import incremental_upsert

__all__ = ["incremental_upsert"]
