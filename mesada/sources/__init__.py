"""Readers and writers, and the schemas of the input relations."""
