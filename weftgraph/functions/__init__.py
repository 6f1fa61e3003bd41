"""Functions of weftgraph."""
