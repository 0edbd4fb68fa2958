"""The jobs: functions from DataFrames to a DataFrame."""
