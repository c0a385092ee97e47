"""tidemark: a Spark-native market-data lakehouse.

Batch and streaming table operators for landed market, fundamentals, FX and
macro payloads: Bronze append with provenance, keep-latest deduplication,
typing, keyed upsert, unpivot to long metric rows, a star schema with a
calendar, cross-layer reconciliation and data-quality checks, as-of currency
conversion, and a Structured Streaming path for daily bars, latest quotes
and price-drop alerts. Everything is public DataFrame / SQL / Structured
Streaming API.
"""

__version__ = "0.1.0"
