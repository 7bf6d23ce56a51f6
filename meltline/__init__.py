"""Gridded radar time series, station series and tile catalogues on Spark DataFrames."""
