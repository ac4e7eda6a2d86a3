"""Activity analytics over public source-repository event logs, on Spark DataFrames."""
