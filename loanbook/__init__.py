"""Loan-book analytics on Spark DataFrames."""
