"""Readers and writers: shards, JSON lines, whole text files, the progress ledger."""
