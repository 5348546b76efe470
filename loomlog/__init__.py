"""Session-log and corpus analytics on PySpark DataFrames."""
