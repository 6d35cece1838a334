"""Numbers over a whole table without gathering it in one task, and seeded sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.runtime import cut_lineage


def running_sum(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows up to each one in the order of ``order`` (a total order): ranges are summed apart and shifted by the sums of those before them, one small row a range."""
    ranges = cut_lineage(df.withColumn("__v", value).repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sums = ranges.groupBy("__range").agg(F.sum("__v").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = sums.select("__range", before.alias("__before"))  # one row a partition
    within = F.sum("__v").over(Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    shifted = ranges.withColumn("__within", within).join(F.broadcast(shifts), "__range")
    return shifted.withColumn(name, F.col("__before") + F.col("__within")).drop("__range", "__within", "__before", "__v")


def numbered(df: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """Adds 1..N in the order of ``order`` (a total order)."""
    return running_sum(df, order, F.lit(1).cast("long"), name)


def seeded(column: str, seed: int) -> Column:
    """A hash that orders rows at random, the same way in every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")).cast("binary"))


def sample(df: DataFrame, id_col: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows chosen by the seeded hash: a distributed top-k."""
    return df.orderBy(seeded(id_col, seed), id_col).limit(size)


def sample_per_group(df: DataFrame, id_col: str, group: str, size: int, seed: int = 42) -> DataFrame:
    """Up to ``size`` rows of each group, chosen by the seeded hash; Spark keeps only the first ranks of each group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(seeded(id_col, seed), id_col))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= size).drop("__rank")


def sample_in_proportion(df: DataFrame, id_col: str, group: str, size: int, seed: int = 42) -> DataFrame:
    """About ``size`` rows, each group in proportion: the k first of its n rows by the seeded hash, k = floor(size * n / N)."""
    sizes = df.groupBy(group).agg(F.count("*").alias("__n"))
    whole = sizes.agg(F.sum("__n")).first()[0] or 1
    rank = F.row_number().over(Window.partitionBy(group).orderBy(seeded(id_col, seed), id_col))
    ranked = df.withColumn("__rank", rank).where(F.col("__rank") <= size)
    return ranked.join(sizes, group).where(F.col("__rank") <= F.floor(F.lit(size) * F.col("__n") / F.lit(whole))).drop("__rank", "__n")


def capped(df: DataFrame, id_col: str, tier: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """Rows of the tiers named in ``shares`` thinned to that share of all rows, chosen by the seeded hash; other tiers stay whole."""
    counts = {r[tier]: r["count"] for r in df.groupBy(tier).count().collect()}  # one row a tier
    whole = sum(counts.values())
    limits = {t: int(whole * s) for t, s in shares.items() if counts.get(t, 0) > whole * s}
    if not limits:
        return df
    thinned = first_by_hash(df.where(F.col(tier).isin(list(limits))), id_col, tier, limits, seed)
    return df.where(~F.coalesce(F.col(tier).isin(list(limits)), F.lit(False))).unionByName(thinned)


def first_by_hash(df: DataFrame, id_col: str, group: str, take: dict[str, int], seed: int = 42) -> DataFrame:
    """Of each group the ``take`` first rows by the seeded hash.

    Groups may hold most of the table, so they aren't sorted: rows are counted in 4096
    hash buckets a group, whole buckets are taken up to the border, and only the border's
    bucket is ranked.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(str(g), int(n)) for g, n in take.items()], "__g string, __take long")
    hashed = df.withColumn("__h", seeded(id_col, seed)).withColumn("__b", F.substring("__h", 1, 3))
    counts = hashed.groupBy(F.col(group).cast("string").alias("__g"), "__b").agg(F.count("*").alias("__n")).join(F.broadcast(wanted), "__g")
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = counts.withColumn("__room", F.col("__take") - before).where("__room > 0").select("__g", "__b", "__n", "__room")  # at most 4096 a group
    placed = hashed.join(F.broadcast(room), (hashed[group].cast("string") == room["__g"]) & (hashed["__b"] == room["__b"])).drop(room["__b"])
    border = F.col("__room") < F.col("__n")
    rank = F.row_number().over(Window.partitionBy("__g", "__b").orderBy("__h", id_col))
    kept = placed.where(~border).unionByName(placed.where(border).withColumn("__rank", rank).where(F.col("__rank") <= F.col("__room")).drop("__rank"))
    return kept.select(*df.columns)
