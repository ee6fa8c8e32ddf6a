"""The same tables from unbounded input."""
