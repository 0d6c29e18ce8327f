"""Personal-data detection, evaluation and corpus building on Spark."""
