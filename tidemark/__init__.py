"""Probabilistic time-series forecasting analytics as Spark DataFrame operators."""
