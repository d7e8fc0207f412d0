"""Scans: search-API payloads, feeds, queue messages, catalogues, tables."""
