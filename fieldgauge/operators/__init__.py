"""DataFrame -> DataFrame operators over configurable keys, metrics and limits."""
