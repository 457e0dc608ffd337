"""Package plans of the river-network engine."""
