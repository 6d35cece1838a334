"""Joins whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a table is broadcast, and rows of one key from which it is spread over several tasks.
BROADCAST_ROWS, HOT_ROWS = 200_000, 5_000


def small(df: DataFrame) -> DataFrame:
    """The table, marked for a broadcast if it was counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def salted_join(asked: DataFrame, held: DataFrame, on: list[str], by: str, hot: int | None = None) -> DataFrame:
    """The inner join of two tables, each read twice, where the rows of ``held`` of a key with more than ``hot`` of them are spread by the hash of ``by``."""
    lists = held.groupBy(*on).agg(F.ceil(F.count("*") / (hot or HOT_ROWS)).cast("int").alias("parts")).where("parts > 1")
    lists = small(lists)
    parts = F.coalesce("parts", F.lit(1))
    mine = asked.join(lists, on, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    theirs = held.join(lists, on, "left").withColumn("part", F.pmod(F.hash(by), parts)).drop("parts")
    return mine.join(theirs, [*on, "part"]).drop("part")
