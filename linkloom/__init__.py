"""Record linkage and corpus processing on Spark."""
