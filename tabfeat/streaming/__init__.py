"""Applying fitted chains to streams."""
