"""Row hashing and reproducible sampling order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.schema import HASH_COLUMNS


def row_hash(columns: Sequence[str] = HASH_COLUMNS) -> Column:
    """MD5 over the text of ``columns``; NULL hashes like the empty string."""
    fields = ", ".join(f"coalesce(cast({c} AS string), '')" for c in columns)
    return F.expr(f"md5(concat_ws('|', {fields}))")


def sample_order(key: str = "trade_id", seed: int = 42) -> Column:
    """A random-looking order that any engine reproduces from the key alone."""
    return F.md5(F.concat(F.col(key), F.lit(str(seed))))
