"""Insurance data mart operators on Spark DataFrames."""
