"""Catalogue and query entry points."""
