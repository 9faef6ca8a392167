"""Structured Streaming jobs over a log: one query and one checkpoint per group."""
