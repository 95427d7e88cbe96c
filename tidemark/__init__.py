"""Tidemark: versioned-record ingestion on PySpark.

Records are keyed by ``trade_id`` and carry an integer ``version``.  Every rule
is expressed against the *tide mark* of a key -- the highest version seen so far
-- which Spark computes as a running maximum, so the same plan serves batch and
Structured Streaming.
"""

__version__ = "0.1.0"
