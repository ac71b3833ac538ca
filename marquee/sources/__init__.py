"""Readers, writers and fixed reference data."""
