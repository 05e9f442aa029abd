"""Spark jobs that prepare tabular observations, then train, score and
evaluate classifiers on them."""
