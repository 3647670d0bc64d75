"""Table and stream operators for synchronizing study-participant records, on Spark."""
