"""Streaming sinks and the stateful forms of the weather join."""
