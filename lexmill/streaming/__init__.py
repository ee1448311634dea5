"""Structured Streaming over folders that documents arrive in."""
