"""Structured Streaming extensions (X-1 ... X-3)."""
