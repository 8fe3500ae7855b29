"""Readers, writers and dataset reports."""
