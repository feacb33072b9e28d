"""Structured Streaming jobs: change feeds, message streams, stateful de-dup."""
