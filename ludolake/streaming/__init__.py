"""Structured Streaming forms of the enrichment and metrics functions."""
