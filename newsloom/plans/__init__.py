"""Composed pipelines: collect, enrich, search, source maintenance."""
