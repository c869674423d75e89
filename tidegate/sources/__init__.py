"""Readers for tables, files, manifests, definitions and requests."""
