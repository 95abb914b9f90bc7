"""Structured Streaming sources, jobs and sinks."""
