"""Layered (bronze / silver / gold) risk analytics on Spark DataFrames."""
