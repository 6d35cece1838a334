"""Types of answers and how severe it is to mistake one for another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.functions.answers import literal_map

#: The weight of a divergence whose worst mistaken type has this level; 1 without a mistake.
WEIGHTS = {1: 0.0, 2: 0.1, 3: 0.3, 4: 0.0}
#: Levels of the types of the answer vocabulary; a type that isn't listed has level 4. A caller with other types gives their own.
LEVELS = {"animal": 1, "vehicle": 1, "person": 1, "yesno": 2, "number": 2, "count": 2, "place": 3, "location": 3}
#: Types that a label without a type doesn't go with.
FORBIDDEN = ("number", "count", "color", "place", "location", "yesno")


def outcome(mine: Column, theirs: Column, levels: dict[str, int] = LEVELS, forbidden: tuple[str, ...] = FORBIDDEN) -> list[Column]:
    """(ok, typed, level): whether a token's types go with the label's, whether the label has types, and the lowest level of the types they don't share."""
    known = literal_map({t: str(n) for t, n in levels.items()})
    other = F.transform(F.array_except(mine, theirs), lambda t: F.coalesce(F.element_at(known, t).cast("int"), F.lit(4)))
    ok = F.when(F.size(theirs) == 0, ~F.exists(mine, lambda t: t.isin(*forbidden))).otherwise(F.arrays_overlap(mine, theirs))
    return [ok.alias("ok"), (F.size(theirs) > 0).alias("typed"), F.least(F.lit(4), F.coalesce(F.array_min(other), F.lit(4))).alias("level")]


def level_of(judged: DataFrame) -> DataFrame:
    """(record_id, tokens, kept, level_1..4, fallback, kl_weight) of rows (record_id, label, ok, typed, level)."""
    wrong = ~F.col("ok") & F.col("typed")
    counts = judged.groupBy("record_id").agg(
        F.count("*").alias("tokens"), F.count_if("ok").alias("kept"), *(F.count_if(wrong & (F.col("level") == n)).alias(f"level_{n}") for n in WEIGHTS), (F.count_if(F.col("ok") & F.col("label")) == 0).alias("fallback")
    )
    weight = F.lit(1.0)
    for n in reversed(WEIGHTS):
        weight = F.when(F.col(f"level_{n}") > 0, WEIGHTS[n]).otherwise(weight)
    return counts.withColumn("kl_weight", weight)
