"""Structured Streaming: versioned tables, sinks and the jobs that run the flows."""
