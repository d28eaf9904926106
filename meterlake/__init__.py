"""Batch analytics for interval meter readings, written against the Spark DataFrame API.

``functions``  column expressions (no DataFrame involved)
``operators``  DataFrame -> DataFrame building blocks (dedup, joins, pivot, split)
``sources``    CSV scans, the layered table store and scratch tables
``plans``      the bronze/silver/gold plans, dashboard queries, contracts and models
``harness``    the registered queries and their SQL twins over the test tables
"""

__version__ = "0.1.0"
