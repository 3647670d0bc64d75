"""Column functions: dates, text, nested values."""
