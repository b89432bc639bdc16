"""Reading and writing feature tables and results."""
