"""Reusable DataFrame operators: skew handling, top-n, radius join, sentiment, model scoring."""
