"""Order analytics and change-data jobs written for Spark."""
