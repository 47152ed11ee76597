"""trendstream: a PySpark engine for post streams.

Posts are read from files, tables or topics, searched and paged, enriched
with their language and the entities they mention, kept as a history table,
and counted per topic over sliding event-time windows to raise threshold
alerts.  Every operator is a DataFrame-in / DataFrame-out function that runs
the same in batch and, where Spark allows, in Structured Streaming.
"""

__version__ = "0.1.0"
