"""Record linkage over several sources of organisation records, on Spark DataFrames."""
