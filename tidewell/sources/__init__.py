"""Readers and writers: files, message log, keyed tables, previews."""
