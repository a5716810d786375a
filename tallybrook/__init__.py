"""Tallybrook: e-commerce warehouse operators as Spark DataFrame transforms."""

__version__ = "0.1.0"
