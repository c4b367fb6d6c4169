"""Structured Streaming helpers."""
