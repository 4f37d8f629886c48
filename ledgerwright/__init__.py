"""ledgerwright: a layered delivery-settlement warehouse built on Spark DataFrames.

Layers: ``sources`` (driver tables, fixture documents, incremental extraction),
``functions`` (column expressions), ``operators`` (dedup, conflict policies,
watermarks, table contracts), ``plans`` (dimensions, facts, marts and the query
registry) and ``streaming`` (incremental loads as Structured Streaming).
"""

__all__ = ["session", "params"]
