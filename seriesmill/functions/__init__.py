"""Column and aggregate expressions that operators share."""
