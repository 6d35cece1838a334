"""Column functions that build and reshape sample records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reasoning_text(cot: Column) -> Column:
    """The paragraph of a reasoning, else its non-blank structured steps on lines of their own; null without either."""
    steps = [F.when(F.coalesce(cot["structured_reasoning"][s], F.lit("")).rlike(r"\S"), cot["structured_reasoning"][s]) for s in ("observation", "analysis", "conclusion")]
    joined = F.concat_ws("\n", *steps)
    return F.coalesce(F.when(cot["reasoning_paragraph"].rlike(r"\S"), cot["reasoning_paragraph"]), F.when(joined != "", joined))


def target_text(reasoning: Column, answer: Column) -> Column:
    """'[Reasoning] r\\n[Answer] a', the parts there are; null without an answer."""
    return F.when(answer.isNotNull(), F.concat_ws("\n", F.concat(F.lit("[Reasoning] "), reasoning), F.concat(F.lit("[Answer] "), answer)))


def singular(word: Column) -> Column:
    """A word without its plural ending: ies to y; es after s, x, z, ch and sh; else s, but not ss."""
    return (
        F.when(word.rlike(r"[^aeiou]ies$") & (F.length(word) > 4), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike(r"(s|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike(r"[^s]s$") & (F.length(word) > 3), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def last_score(text: Column) -> Column:
    """The last number of one to three digits up to 100 in a text; null without one."""
    found = F.filter(F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d{1,3})\b"), F.lit(1)), lambda x: x.cast("int")), lambda x: x <= 100)
    return F.try_element_at(found, F.lit(-1))


def resized(width: Column, height: Column, most: int) -> tuple[Column, Column]:
    """Width and height scaled down, each floored, so that their product is at most ``most``; smaller images stay."""
    ratio = F.sqrt(F.lit(float(most)) / (width.cast("double") * height))
    fits = width.cast("long") * height <= most
    return tuple(F.when(fits, x.cast("long")).otherwise(F.floor(x * ratio)) for x in (width, height))


def neighbours(number: Column, deltas: tuple[int, ...] = (-100, -10, -2, -1, 0, 1, 2, 10, 100)) -> Column:
    """The non-negative numbers around one as text, shortest first, then by text."""
    near = F.filter(F.transform(F.array(*map(F.lit, deltas)), lambda d: number + d), lambda n: n >= 0)
    keyed = F.array_sort(F.transform(near, lambda n: F.struct(F.length(n.cast("string")).alias("l"), n.cast("string").alias("s"))))
    return F.array_distinct(F.transform(keyed, lambda k: k["s"]))
