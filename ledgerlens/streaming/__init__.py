"""Incremental runs: cursors, bounded catch-up and Structured Streaming jobs."""
