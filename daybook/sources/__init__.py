"""Reading and writing landed CSV and bronze tables."""
