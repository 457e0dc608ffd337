"""Package sources of the river-network engine."""
