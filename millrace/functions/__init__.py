"""Scalar column helpers built from pyspark.sql.functions."""
