"""Lakehouse operators written with the Spark DataFrame, SQL and streaming APIs."""

__version__ = "0.1.0"
