"""Ratings analytics on Spark: star schema, business queries, profiling and feature pipelines."""
