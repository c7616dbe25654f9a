"""Batch lakehouse pipeline for transaction data, built on PySpark DataFrames."""
