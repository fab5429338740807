"""Readers and writers, plus the mapping from star-schema tables to observations."""
