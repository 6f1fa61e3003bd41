"""Plans of weftgraph."""
