"""Streaming: applying fitted stages to Structured Streaming sources."""
