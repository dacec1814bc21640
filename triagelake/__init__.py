"""Spark-native analytics over issue-tracker data: typed staging, features,
marts, exact nearest-neighbour triage, evaluation and data-quality checks."""
