"""Registered queries: bindings of the given tables to news entities, jobs, and check SQL."""
