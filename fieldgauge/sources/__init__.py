"""Table layouts, scans and sinks."""
