"""Fitted feature chains, models, search and experiment runs."""
