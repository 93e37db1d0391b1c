"""Readers, writers, table contracts and the retail tables derived from the test data."""
