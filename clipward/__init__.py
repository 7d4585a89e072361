"""Labelled-clip and feature-table analytics with drift monitoring, on Spark DataFrames."""
