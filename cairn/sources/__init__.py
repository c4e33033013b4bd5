"""Readers, sinks and the fixture tables."""
