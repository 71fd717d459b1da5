"""Spark-native keeping of a marketing-performance data lake.

Landed JSON pages become typed daily fact tables and current-state dimension
tables; every step is a DataFrame transformation, so Spark partitions, shuffles
and prunes the work.
"""
