"""Sensor-quality analytics on Spark DataFrames."""
