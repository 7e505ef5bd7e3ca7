"""Retention features and churn models as Spark DataFrame transformations."""
