"""Assembled pipelines: the warehouse, the daily run, the query catalogue and its SQL oracle."""
