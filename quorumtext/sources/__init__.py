"""Readers and writers of layered transcript files, indexes and reports."""
