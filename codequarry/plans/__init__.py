"""Whole jobs, and the catalogue of queries with their SQL counterparts."""
