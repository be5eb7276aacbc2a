"""Table, stream and model operators for plain PySpark and Parquet."""
