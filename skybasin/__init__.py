"""Environmental risk analytics on Spark: ingest, clean, join, score, query.

Every operator takes DataFrames and returns a DataFrame.  No function reads a
clock: run stamps and "today" are arguments.
"""
