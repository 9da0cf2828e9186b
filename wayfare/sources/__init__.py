"""Declared tables, landing files, change envelopes and stream sources."""
