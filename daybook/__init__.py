"""Order analytics on Spark: landing, history, order facts, quality checks and daily totals."""
