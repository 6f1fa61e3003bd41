"""Sources of weftgraph."""
