"""Tabular classification as Spark jobs: split, prepare, fit, version, score, evaluate."""
