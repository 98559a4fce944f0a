"""Structured Streaming operators: scored completions, running preference
pairs, event-time latency windows."""
