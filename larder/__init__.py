"""Procurement analytics on Spark: change logs in, daily churn scores out."""
