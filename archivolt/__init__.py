"""Spark-first analytics over the state of a web archive."""
