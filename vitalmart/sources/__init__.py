"""Readers, writers, schemas, lineage and storage layout."""
