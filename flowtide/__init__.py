"""Network-flow anomaly analytics written as Spark DataFrame jobs."""
