"""Structured Streaming side of the lake."""
