"""Batch analytics over card and bank transactions, on Spark DataFrames.

Raw JSON lines -> flat records -> deduplicated star schema -> business-rule
models -> one wide analytics view, with data tests before anything is published.
"""
