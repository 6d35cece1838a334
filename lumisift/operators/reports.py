"""Table-level quality reports: each a small aggregate of one or a few passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.operators.numbering import running_sum


def profile(df: DataFrame, value: str) -> DataFrame:
    """One row: n, mean, population deviation, least, greatest and the quartiles at the places n // 4, n // 2 and 3n // 4 of the sorted values.

    The quartiles come from the counts of distinct values, summed up in value order.
    """
    held = df.select(F.col(value).alias("v")).where("v is not null")
    shape = held.agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    n = F.lit(held.count())
    upto = running_sum(held.groupBy("v").agg(F.count("*").alias("k")), ["v"], F.col("k"), "upto")
    quartiles = upto.agg(*(F.min(F.when(F.col("upto") > F.floor(n * k / 4), F.col("v"))).alias(f"q{k}") for k in (1, 2, 3)))
    return shape.withColumn("one", F.lit(1)).join(F.broadcast(quartiles.withColumn("one", F.lit(1))), "one").drop("one")  # one row each


def calibration(df: DataFrame, confidence: Column, correct: Column, half_open: bool = False) -> DataFrame:
    """One row (n, ece): expected calibration error over ten bins; with ``half_open`` a confidence of exactly 1 is in no bin but counts in n."""
    rows = df.select(confidence.alias("c"), correct.cast("double").alias("ok")).where("c is not null and ok is not null")
    binned = rows.withColumn("bin", F.floor(F.col("c") * 10) if half_open else F.least(F.floor(F.col("c") * 10), F.lit(9)))
    bins = binned.groupBy("bin").agg(F.count("*").alias("k"), F.avg("c").alias("conf"), F.avg("ok").alias("acc"))
    gap = F.sum(F.when(F.col("bin") < 10, F.col("k") * F.abs(F.col("acc") - F.col("conf"))).otherwise(0.0))
    return bins.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), (gap / F.sum("k")).alias("ece"))


def frequencies(df: DataFrame, value: Column) -> DataFrame:
    """(value, n) of every distinct value."""
    return df.select(value.alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))


def concentration(df: DataFrame, value: Column) -> DataFrame:
    """One row (n, distinct_values, entropy in bits, top_share, repetition) of a column's values."""
    counts = frequencies(df, value)
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("distinct_values"), F.sum(F.col("n") * F.log2("n")).alias("s"), F.max("n").alias("top"))
    return sums.select("n", "distinct_values", (F.log2("n") - F.col("s") / F.col("n")).alias("entropy"), (F.col("top") / F.col("n")).alias("top_share"), (1 - F.col("distinct_values") / F.col("n")).alias("repetition"))


def top(df: DataFrame, value: Column, k: int) -> DataFrame:
    """(value, n) of the k most frequent values, ties by value."""
    return frequencies(df, value).orderBy(F.desc("n"), "value").limit(k)


def completeness(df: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, rows, held, share): how many rows have a value in each field, in one pass."""
    counted = df.agg(F.count("*").alias("rows"), *(F.count(F.when(c.isNotNull(), 1)).alias(f"f{i}") for i, c in enumerate(fields.values())))
    lines = F.array(*(F.struct(F.lit(name).alias("field"), F.col(f"f{i}").alias("held")) for i, name in enumerate(fields)))
    return counted.select("rows", F.explode(lines).alias("x")).select("x.field", "rows", "x.held", (F.col("x.held") / F.col("rows")).alias("share"))
