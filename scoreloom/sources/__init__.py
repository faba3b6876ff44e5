"""Readers, writers, schemas and the mapping of test tables to credit roles."""
