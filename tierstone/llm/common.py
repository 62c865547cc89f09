"""What the operators share: names, ASCII case, tables in the shared folder."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.sources.storage import delete, fresh_path

#: The white space `[\x20\x09-\x0D]`.
ASCII_SPACE = " \t\n\x0b\f\r"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def row_key(docs: DataFrame) -> Column:
    """A join key of a document's row, also for rows without an id: equal only for rows with
    the same id and text, but for rare hash clashes."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


class Stored:
    """A DataFrame written once to the shared folder, which cuts its lineage."""

    def __init__(self, df: DataFrame, label: str):
        self._spark, self._schema = df.sparkSession, df.schema
        self.path = fresh_path(self._spark, label)
        df.write.parquet(self.path)

    @property
    def df(self) -> DataFrame:
        return self._spark.read.schema(self._schema).parquet(self.path)

    def drop(self) -> None:
        delete(self._spark, self.path)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def group_count(df: DataFrame, rows: int, per_group: int) -> int:
    """Groups for ``rows`` rows, so that none holds much more than ``per_group``."""
    return max(shuffle_partitions(df), -(-rows // per_group))


def hash_sample(df: DataFrame, keys: list[str], rows: int, total: int) -> DataFrame:
    """At most ``rows`` of the ``total`` rows: those whose keys hash lowest.

    Only a share of a little over ``rows`` is sorted, so what the tasks send does not grow
    with their number.
    """
    own = F.xxhash64(*keys)
    share = min(1.0, 1.5 * rows / max(total, 1))
    low = F.pmod(own, F.lit(1 << 30)) <= int(share * (1 << 30))
    return df.where(low).orderBy(F.pmod(own, F.lit(1 << 30)), own).limit(rows)
