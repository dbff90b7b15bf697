"""Incremental intake."""
