"""Multi-source posting analytics on Spark.

Every operator takes and returns DataFrames (or builds a Column); nothing is
collected to the driver except values whose size is bounded by a limit.
"""
