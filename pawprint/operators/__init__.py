"""Operators: ``pyspark.ml`` stages and DataFrame-level operators."""
