"""Readers, writers and dataset fingerprints."""
