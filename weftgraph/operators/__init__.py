"""Operators of weftgraph."""
