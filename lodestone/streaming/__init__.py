"""Structured Streaming forms of the operators: incremental selection
against a log with idempotent micro-batches (incremental)."""
