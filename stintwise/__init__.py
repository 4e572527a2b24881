"""Batch analytics for lap-shaped event tables on Spark DataFrames."""
