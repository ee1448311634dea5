"""Compositions of operators: pipelines and the catalogue of queries."""
