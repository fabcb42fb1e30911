"""Readers and writers for corpora and vocabulary artifacts."""
