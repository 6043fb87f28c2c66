"""skytables: sky catalogue and light-curve analytics on Spark DataFrames."""
