"""Operators of a training-data pipeline: texts and vectors at corpus scale."""
