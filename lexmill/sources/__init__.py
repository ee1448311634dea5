"""Readers, listings, download interfaces and sinks."""
