"""Incremental forms of the panel operators."""
