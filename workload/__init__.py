"""Validation workload over the test tables: derived layers, queries and their SQL."""
