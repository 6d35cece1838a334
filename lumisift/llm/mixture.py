"""Problem 9: one corpus from several sources in target shares of tokens.

Texts are counted in tokens of a public tokenizer. The size of the corpus is the largest
at which no source with documents has to be used more than ``max_repeats`` times; targets
of sources without documents are spread over the others in proportion. Each source's
budget of tokens is whole rounds of all its documents plus a rest. The rest is fitted on
the source's counts of documents by exact length: most of it in proportion to the
counts, what then remains by bounded-knapsack dynamic programming over the documents
left, in units of the lengths' common divisor. The part left to the programme is at least
four times the longest document and grows until the budget is met, or is the whole budget,
which is exact as well; past ``UNITS_MOST`` units the shortfall is less than the shortest
document left. Of each length the seeded hash decides which documents are taken; a length that
many documents share is split by hash buckets, and only the bucket at the border is
ranked, so no group is sorted in one task.

Defined results: documents without tokens (null and blank texts) and of sources without a
target aren't used; a repeated doc_id is used as often as it occurs; an empty table, or
targets whose sources have no documents, give an empty corpus; targets with null or
non-positive share or repeats below one count as no target; targets of one source are
summed, its largest cap holds.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.runtime import cut_lineage, spread

TOKENIZER_DIR = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which this tokenizer splits texts into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEED = 42
BUCKETS = 1024
#: Units the dynamic programme runs over at first, and those past which it isn't repeated over more.
UNITS, UNITS_MOST = 20_000, 4_000_000
_COUNTED = "doc_id long, source string, n_tokens int"


def _tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("mixture", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(t)) if t and not t.isspace() else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int32())], names=["doc_id", "source", "n_tokens"])

    return run


def token_lengths(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, source, n_tokens) of every document, counted over its whole text."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return spread(rows).mapInArrow(_tokens(os.path.join(tokenizer_dir, RANKS)), _COUNTED)


@dataclass
class Plan:
    """What is taken of one source: ``rounds`` times everything and once more ``chosen`` documents of each length."""

    source: str
    target: float
    available: int
    budget: int
    rounds: int = 0
    chosen: dict[int, int] = field(default_factory=dict)

    @property
    def tokens(self) -> int:
        return self.rounds * self.available + sum(n * k for n, k in self.chosen.items())


def knapsack(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length sum up to the most tokens within the budget: bounded subset sum, remembering by which part each sum was first reached."""
    parts = []
    for length, count in sorted(counts.items(), reverse=True):
        count, power = min(count, budget // length), 1
        while count > 0:
            take = min(power, count)
            parts.append((length, take))
            count -= take
            power *= 2
    by = np.full(budget + 1, -1, np.int32)
    by[0] = len(parts)
    for i, (length, take) in enumerate(parts):
        step = length * take
        new = np.flatnonzero((by[:-step] >= 0) & (by[step:] < 0)) + step
        by[new] = i
        if by[budget] >= 0:
            break
    total = int(np.flatnonzero(by >= 0)[-1])
    chosen: dict[int, int] = {}
    while total:
        length, take = parts[by[total]]
        chosen[length] = chosen.get(length, 0) + take
        total -= length * take
    return chosen


def fit(counts: dict[int, int], budget: int, units: int = UNITS, most: int = UNITS_MOST) -> dict[int, int]:
    """The documents to take of each length for a budget below the sum of all."""
    total = sum(n * k for n, k in counts.items())
    if budget >= total:
        return dict(counts)
    unit = math.gcd(*counts)
    counts, budget, total = {n // unit: k for n, k in counts.items()}, budget // unit, total // unit
    left = max(units, 4 * max(counts))
    while True:
        whole = left >= budget
        chosen = {n: 0 if whole else k * (budget - left) // total for n, k in counts.items()}
        rest = budget - sum(n * k for n, k in chosen.items())
        for n in sorted(counts, reverse=True):
            more = 0 if whole else min(counts[n] - chosen[n], max(0, rest - left) // n)
            chosen[n] += more
            rest -= more * n
        for n, k in knapsack({n: counts[n] - k for n, k in chosen.items()}, rest).items():
            chosen[n] += k
        if whole or left >= most or sum(n * k for n, k in chosen.items()) == budget:
            return {n * unit: k for n, k in chosen.items() if k}
        left *= 4


def plan(histogram: dict[str, dict[int, int]], targets: dict[str, tuple[float, int]]) -> list[Plan]:
    """The plan of each source that has both a target and documents."""
    held = {s: (sum(n * k for n, k in histogram[s].items()), *targets[s]) for s in sorted(targets) if histogram.get(s)}
    whole = sum(share for _, share, _ in held.values())
    if not held:
        return []
    size = min(available * repeats / (share / whole) for available, share, repeats in held.values())
    plans = []
    for source, (available, share, repeats) in held.items():
        budget = min(int(share / whole * size + 1e-6), available * repeats)
        p = Plan(source, share, available, budget, budget // available)
        if p.rounds < repeats and budget % available:
            p.chosen = fit(histogram[source], budget % available)
        plans.append(p)
    return plans


def mixture(df: DataFrame, targets: DataFrame, seed: int = SEED, tokenizer_dir: str = TOKENIZER_DIR) -> tuple[DataFrame, DataFrame]:
    """The corpus (doc_id, source, n_tokens, copies), ``copies`` being how often a document is used, and the report.

    The report has for each target and each source (source, target_share, max_repeats,
    available_tokens, budget_tokens, used_tokens, used_share, most_copies).
    """
    spark = df.sparkSession
    wanted = targets.groupBy("source").agg(F.sum(F.when(F.col("target_share") > 0, F.col("target_share"))).alias("share"), F.max("max_repeats").alias("repeats")).where("share > 0 and repeats >= 1 and source is not null")
    goals = {r["source"]: (r["share"], r["repeats"]) for r in wanted.collect()}
    counted = cut_lineage(token_lengths(df, tokenizer_dir=tokenizer_dir))
    usable = counted.where((F.col("n_tokens") > 0) & F.col("source").isin(list(goals)))
    histogram: dict[str, dict[int, int]] = {}
    for r in usable.groupBy("source", "n_tokens").count().collect():  # distinct lengths of the sources with a target
        histogram.setdefault(r["source"], {})[r["n_tokens"]] = r["count"]
    plans = plan(histogram, goals)
    rounds = spark.createDataFrame([(p.source, p.rounds) for p in plans], "source string, rounds int")
    chosen = spark.createDataFrame([(p.source, n, k) for p in plans for n, k in p.chosen.items()], "source string, n_tokens int, take long")
    hashed = usable.withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)))
    per_bucket = hashed.join(F.broadcast(chosen), ["source", "n_tokens"]).groupBy("source", "n_tokens", "take", "bucket").agg(F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.partitionBy("source", "n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    border = per_bucket.withColumn("room", F.col("take") - before).select("source", "n_tokens", "bucket", "k", "room")
    placed = hashed.join(border, ["source", "n_tokens", "bucket"], "left").withColumn("room", F.coalesce("room", F.lit(0)))
    at_border = (F.col("room") > 0) & (F.col("room") < F.col("k"))
    rank = F.row_number().over(Window.partitionBy("source", "n_tokens", "bucket").orderBy("h", "doc_id"))
    ranked = placed.where(at_border).withColumn("taken", (rank <= F.col("room")).cast("int"))  # one bucket of each length
    settled = placed.where(~F.coalesce(at_border, F.lit(False))).withColumn("taken", (F.col("room") > 0).cast("int"))
    corpus = settled.unionByName(ranked).join(F.broadcast(rounds), "source").select("doc_id", "source", "n_tokens", (F.col("rounds") + F.col("taken")).alias("copies")).where("copies > 0")
    used = corpus.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("used_tokens"), F.max("copies").alias("most_copies"))
    available = counted.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    budgets = spark.createDataFrame([(p.source, p.budget) for p in plans], "source string, budget_tokens long")
    goal = spark.createDataFrame([(s, share, repeats) for s, (share, repeats) in goals.items()], "source string, target_share double, max_repeats int")
    report = available.join(goal, "source", "full").join(budgets, "source", "left").join(used, "source", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    report = report.select(
        "source", "target_share", "max_repeats", zero("available_tokens"), zero("budget_tokens"), zero("used_tokens"),
        F.coalesce(F.col("used_tokens") / F.lit(max(1, sum(p.tokens for p in plans))), F.lit(0.0)).alias("used_share"), zero("most_copies"),
    )
    return corpus, report
