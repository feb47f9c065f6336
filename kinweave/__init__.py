"""kinweave: entity resolution and corpus operators expressed on Spark DataFrames."""
