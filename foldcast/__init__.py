"""Event-sequence features and class-probability forecasts on Spark DataFrames."""
