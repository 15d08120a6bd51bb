"""Readers, writers and the input contract."""
