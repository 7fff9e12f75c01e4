"""Volatility, news-text, vote and monitoring analytics as lazy Spark DataFrame functions."""
