"""Behaviour-log analytics on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame. Raw records have the
columns ``key string, value string, timestamp timestamp`` (one JSON event per
``value``, arrival time in ``timestamp``), in batch and on a stream alike.
"""
