"""Structured Streaming helpers: foreachBatch runner, dimension refresh,
schema sampling, streaming enrichment."""
