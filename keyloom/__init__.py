"""keyloom: keyed event signals on Spark DataFrames and Structured Streaming."""
