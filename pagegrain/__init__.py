"""Document structure and provenance analytics on Spark DataFrames."""
