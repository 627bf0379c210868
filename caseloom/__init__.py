"""Event tables in, one clean feature row per entity out, on Spark.

Every operator is a function over DataFrames whose entity, code, day and value
columns are parameters, so any keyed event log can be fed through it.
"""
