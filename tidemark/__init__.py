"""tidemark: a retail event warehouse built on Spark DataFrames and
Structured Streaming (app-log detail layer, visitor metrics, change-record
routing, dimension upsert, order wide table)."""

__version__ = "0.1.0"
