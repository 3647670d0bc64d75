"""Jobs: compositions of operators. Each takes frames and returns frames."""
