"""Algebra of probability maps (token to probability), without exploding them where keys don't merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def entries(dist: Column) -> Column:
    """The entries with a positive probability, in their order; an empty array for null."""
    return F.filter(F.coalesce(F.map_entries(dist), F.array().cast("array<struct<key:string,value:double>>")), lambda e: e["value"] > 0)


def total(held: Column) -> Column:
    return F.aggregate(held, F.lit(0.0), lambda acc, e: acc + e["value"])


def renormalised(held: Column) -> Column:
    """Entries divided by their sum."""

    def of(h: Column) -> Column:
        return let(total(h), lambda s: F.transform(h, lambda e: F.struct(e["key"].alias("key"), (e["value"] / s).alias("value"))))

    return let(held, of)


def ranked(held: Column) -> Column:
    """Entries by falling probability; ties keep their order."""
    numbered = F.transform(held, lambda e, i: F.struct((-e["value"]).alias("d"), i.alias("i"), e["key"].alias("key"), e["value"].alias("value")))
    return F.transform(F.array_sort(numbered), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def softened(held: Column, temperature: float) -> Column:
    """Softmax of the entries' log-probabilities over a temperature."""
    top = F.aggregate(held, F.lit(float("-inf")), lambda acc, e: F.greatest(acc, F.ln(e["value"]) / temperature))
    return renormalised(let(top, lambda t: F.transform(held, lambda e: F.struct(e["key"].alias("key"), F.exp(F.ln(e["value"]) / temperature - t).alias("value")))))


def nucleus(held: Column, share: float, most: int) -> Column:
    """The fewest ranked entries whose sum exceeds ``share``, at most ``most``, renormalised."""

    def cut(order: Column) -> Column:
        within = F.aggregate(
            order,
            F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
            lambda acc, e: F.struct((acc["sum"] + e["value"]).alias("sum"), (acc["n"] + F.when(acc["sum"] + e["value"] <= share, 1).otherwise(0)).alias("n")),
        )["n"]
        return F.when(F.size(order) > 0, renormalised(F.slice(order, F.lit(1), F.least(within + 1, F.lit(most), F.size(order))))).otherwise(order)

    return let(ranked(renormalised(held)), cut)


def entropy(held: Column) -> Column:
    """Entropy in bits of normalised entries."""
    return F.aggregate(held, F.lit(0.0), lambda acc, e: acc - e["value"] * F.log2(e["value"]))


def probability(held: Column, key: Column) -> Column:
    """The probability of a key; 0 if it has none."""
    return F.aggregate(held, F.lit(0.0), lambda acc, e: F.when(e["key"] == key, e["value"]).otherwise(acc))


def divergence(p: Column, q: Column, floor: float = 1e-10) -> Column:
    """Kullback-Leibler divergence of p from q in nats; keys that q lacks count with ``floor``."""
    return F.aggregate(p, F.lit(0.0), lambda acc, e: acc + e["value"] * (F.ln(e["value"]) - F.ln(F.greatest(probability(q, e["key"]), F.lit(floor)))))


def cosine(p: Column, q: Column) -> Column:
    """Cosine of two distributions; null if either is empty."""
    dot = F.aggregate(p, F.lit(0.0), lambda acc, e: acc + e["value"] * probability(q, e["key"]))

    def norm(d: Column) -> Column:
        return F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, e: acc + e["value"] * e["value"]))

    return F.when((F.size(p) > 0) & (F.size(q) > 0), dot / (norm(p) * norm(q)))


def to_map(held: Column) -> Column:
    """The map of entries; of equal keys the last one stays."""
    last = F.aggregate(held, F.create_map().cast("map<string,double>"), lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))
    return last
