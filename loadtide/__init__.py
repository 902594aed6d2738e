"""Spark-native analytics for sampled time series.

Everything is a function from DataFrame(s) to a lazy DataFrame, parameterised by
column names. Only sinks, model fits and gate verdicts run actions.
"""
