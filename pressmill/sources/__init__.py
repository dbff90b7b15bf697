"""Readers for articles, splits and statements."""
