"""Sinks: catalog tables, text, keyed upsert, stream outputs."""
