"""Relational, text, vector, graph and rule operators."""
