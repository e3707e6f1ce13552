"""Batch and streaming analytics over bank transactions, built on Spark DataFrames."""
