"""Whole jobs: a dataset and a binding compiled to one Spark plan."""
