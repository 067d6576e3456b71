"""Composite jobs and the registry of named jobs."""
