"""chronoloom: time-series analytics as plain Spark DataFrame jobs.

A series is a set of rows with declared key columns and a time index.  Every
operator takes DataFrames and returns DataFrames.
"""

from chronoloom.series import SeriesSpec, to_series

__all__ = ["SeriesSpec", "to_series"]
