"""Package functions of the river-network engine."""
