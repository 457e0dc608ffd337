"""Package operators of the river-network engine."""
