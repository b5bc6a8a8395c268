"""Mutation streams on Structured Streaming."""
