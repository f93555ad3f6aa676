"""numerant: tabular regression on Spark, from raw table to scored stream."""
