"""Medallion sales analytics on Spark: staging, quality, marts, customer features, PII, churn."""

__version__ = "0.1.0"
