"""weftgraph: property graphs, tuples and text corpora as plain Spark DataFrame jobs."""
