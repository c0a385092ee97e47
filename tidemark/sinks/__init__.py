"""Sinks: Bronze append, schema-evolving append, keyed upsert."""
