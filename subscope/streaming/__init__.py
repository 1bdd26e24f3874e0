"""Structured Streaming versions of the activity counts and risk alerts."""
