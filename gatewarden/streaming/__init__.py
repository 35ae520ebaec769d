"""Structured Streaming: continuous loading and windowed alerts."""
