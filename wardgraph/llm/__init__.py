"""Training-data operators; nothing else in wardgraph imports this subpackage."""
