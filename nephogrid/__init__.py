"""Gridded Earth-observation analytics as Spark DataFrame transformations."""
