"""Column functions, message parsing and the data-quality rule pass."""
