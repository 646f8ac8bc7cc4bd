"""Entity-level risk features and scores as Spark DataFrame operators."""
