"""Readers, writers, schemas, the test-table adapter and model artifacts."""
