"""Operators: statistics, splitting, transformers, metrics, checks, plot data."""
