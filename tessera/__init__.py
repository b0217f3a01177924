"""tessera: event-outcome analytics on Spark.

Generic, column-parameterised DataFrame operators (``tessera.operators``),
Column-level helpers (``tessera.functions``), readers and writers
(``tessera.sources``), domain jobs that compose them (``tessera.plans``) and
Structured Streaming jobs (``tessera.streaming``).
"""

__all__ = ["session"]
