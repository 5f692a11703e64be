"""Readers and writers: till logs, store registry, landing tables, canonical tables."""
