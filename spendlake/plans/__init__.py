"""Whole jobs: a source, operators and a sink put together."""
