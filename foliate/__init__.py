"""foliate: document analytics on Spark, DataFrames in and DataFrames out."""
