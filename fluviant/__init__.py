"""River-network preparation as Spark DataFrame programs."""
