"""Structured Streaming operators with batch twins."""
