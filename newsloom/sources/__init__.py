"""Scans and sinks: test tables, the article adapter, feeds, pages, the store."""
