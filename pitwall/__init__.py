"""Motorsport timing analytics as plain Spark DataFrame functions."""
