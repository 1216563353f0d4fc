"""shelfmark: a file catalog for very large storage trees, built on Spark DataFrames."""
