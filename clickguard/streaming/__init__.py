"""Structured Streaming: sinks, the jobs, and stream replays of the tables."""
