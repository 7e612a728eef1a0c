"""Structured Streaming: incremental landing of raw reports and per-batch recompute."""
