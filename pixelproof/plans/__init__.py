"""Whole jobs: extract, train, score, report."""
