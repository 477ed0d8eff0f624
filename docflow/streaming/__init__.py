"""Structured Streaming shell: micro-batch runner and idempotent batch functions."""
