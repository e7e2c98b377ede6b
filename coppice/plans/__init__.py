"""Jobs made of operators: train, score, evaluate, and the fit-and-test harness."""

from coppice.plans.jobs import evaluate, fit_and_test, score, train

__all__ = ["evaluate", "fit_and_test", "score", "train"]
