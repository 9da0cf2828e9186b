"""Structured Streaming queries over event and change streams."""
