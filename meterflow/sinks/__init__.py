"""Sinks: topics, raw tables, keyed upserts and the serving table."""
