"""Readers and writers of records, registries, id lists and logs."""
