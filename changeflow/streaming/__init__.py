"""Structured Streaming runs: sinks, grouped runs, progress, the layer
chain, commit history and keyed publish."""
