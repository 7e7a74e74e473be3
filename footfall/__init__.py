"""Footfall: DataFrame operators for sensors that report cumulative in/out counters.

Every operator takes DataFrames and an explicit point in time and returns a
DataFrame, so a result depends on its arguments only.
"""
