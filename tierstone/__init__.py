"""Tiered trade analytics on PySpark.

A trade history kept in three age tiers of partitioned Parquet, with the jobs
that move, migrate, validate, compact, snapshot and report on it.
"""
