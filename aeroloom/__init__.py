"""Spark-first analytics for environmental sensor networks.

Weather stations (``WU``) and air-quality devices (``TSI``) land as wide rows; the
library normalises them, unpivots them to one long fact, keeps hourly and daily
rollups, resolves identity and location, and serves reports, quality checks,
alerts, seasonal analysis and PM2.5 forecasts.  Every operator takes and returns
DataFrames and never reads the wall clock.
"""
