"""Part of wardgraph; see README.md."""
