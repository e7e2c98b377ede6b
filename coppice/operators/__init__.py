"""Operators on DataFrames: splits, features, learners, metrics."""
