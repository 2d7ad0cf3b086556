"""pitboss: a Spark-native medallion warehouse for gaming-floor data.

Layers: ``sources`` (bronze inputs, incremental extract, sinks), ``functions``
(column expressions), ``operators`` (reusable DataFrame operators: as-of,
running pool, overlap join, SCD top-1, islands, dedupe, reconcile),
``plans`` (silver and gold facts), ``streaming`` (incremental ingest as a
Structured Streaming job) and ``catalog`` (named queries and their SQL checks).
"""

__version__ = "0.1.0"
