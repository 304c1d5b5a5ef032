"""Contract-price auditing on Spark."""
