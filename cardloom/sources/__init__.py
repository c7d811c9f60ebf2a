"""Readers, stage files and sinks."""
