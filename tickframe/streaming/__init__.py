"""Structured Streaming jobs over metric samples (the events table), with batch twins."""
