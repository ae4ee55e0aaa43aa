"""Structured Streaming: apply a fitted experiment to flow streams (no stream-only operators)."""
