"""PASS / FAIL expressions that never come out NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def verdict(condition: Column, passed: str = "PASS", failed: str | Column = "FAIL") -> Column:
    """A NULL condition is a FAIL."""
    failed = failed if isinstance(failed, Column) else F.lit(failed)
    return F.when(condition, F.lit(passed)).otherwise(failed)


def same_within(left: Column, right: Column, tolerance: str) -> Column:
    """Equal up to ``tolerance``; two empty sides agree, one empty side does not."""
    close = F.abs(left - right) < F.lit(tolerance).cast("decimal(10,4)")
    return F.coalesce(close, left.isNull() & right.isNull())
