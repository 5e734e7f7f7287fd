"""Trip analytics as Spark DataFrames: conform, validate, summarise, compare."""
