"""Layered (bronze -> silver -> gold) data pipelines as ordinary Spark DataFrame jobs."""

__version__ = "0.1.0"
