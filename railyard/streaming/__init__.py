"""Structured Streaming over vehicle positions."""
