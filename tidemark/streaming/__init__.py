"""Structured Streaming path: raw price events to Bronze, daily bars, latest
quotes and price-drop alerts, each merged into a table by keyed upsert."""
