"""Operators of a training-data pipeline (quality, dedup, tokens, archives,
search).  Nothing else in the package imports this subpackage."""
