"""Streaming of weftgraph."""
