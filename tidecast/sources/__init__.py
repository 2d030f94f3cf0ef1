"""Scans and sinks: the testdata adapter (panel), file sources and sinks."""
