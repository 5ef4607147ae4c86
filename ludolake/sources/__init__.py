"""Readers: files, micro-batches, event topics."""
