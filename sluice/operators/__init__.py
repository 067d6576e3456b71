"""Relational and file operators."""
