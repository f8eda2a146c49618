"""Spark jobs that validate credit-default models on large application tables."""
