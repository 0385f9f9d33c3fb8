"""Incremental (Structured Streaming) forms of the append/resume jobs."""
