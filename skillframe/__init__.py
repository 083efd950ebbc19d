"""Spark toolkit that turns match logs into player and lineup ratings."""

__version__ = "0.1.0"
