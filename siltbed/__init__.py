"""Layered data refinement (raw, staging, curated, trusted) as Spark DataFrame operators."""
