"""Weather-radar mosaics and scan-availability analytics on Spark DataFrames."""
