"""Incremental counterparts of batch operators."""
