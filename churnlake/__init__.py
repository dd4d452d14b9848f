"""Subscription and churn analytics written as Spark DataFrame operators."""
