"""Readers, sinks and loads."""
