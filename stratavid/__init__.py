"""Analytics warehouse operators for media-platform metadata, on PySpark DataFrames."""
