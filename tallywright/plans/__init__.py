"""Whole models assembled from the operators."""
