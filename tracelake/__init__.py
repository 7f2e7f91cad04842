"""Multi-channel time series and training data as Spark DataFrames."""
