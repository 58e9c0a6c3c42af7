"""Whole plans built from the operators: registered queries, join strategy, output form."""
