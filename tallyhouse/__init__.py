"""Commerce analytics on Spark: batch marts, serving queries, checks and a speed layer."""
