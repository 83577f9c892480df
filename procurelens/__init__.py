"""Supplier and brand analytics on procurement data, as lazy Spark DataFrame plans."""

__version__ = "0.1.0"
