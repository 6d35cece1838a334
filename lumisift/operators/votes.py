"""Ground truth from several annotators' answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vote(annotations: DataFrame, key: str = "question_id", answers: str = "answers", fallback: str = "multiple_choice_answer") -> DataFrame:
    """(key, answer, consistency, distinct_answers, votes, dist) of each question; ``dist`` maps each valid answer to its share of the votes, rounded to four places.

    Valid answers are lower case, trimmed, not empty and not given with confidence 'no'
    (null counts as 'yes'). The most frequent wins, of equally frequent ones the first
    given. Without valid answers the fallback is the answer with consistency 1. Repeated
    rows of a question count once: one of them is taken. Answer lists are short, so the
    vote is counted within the row, without a shuffle of single answers.
    """
    one = annotations.select(key, answers, fallback).dropDuplicates([key])
    cleaned = F.transform(F.coalesce(answers, F.array().cast(annotations.schema[answers].dataType)), lambda a: F.struct(F.lower(F.trim(a["answer"])).alias("a"), F.coalesce(a["answer_confidence"], F.lit("yes")).alias("c")))
    valid = F.transform(F.filter(cleaned, lambda x: (x["c"] != "no") & (F.coalesce(x["a"], F.lit("")) != "")), lambda x: x["a"])
    held = one.select(key, F.lower(F.trim(F.coalesce(fallback, F.lit("")))).alias("fallback"), valid.alias("valid"))
    counted = F.transform(F.array_distinct("valid"), lambda a, i: F.struct((-F.size(F.filter("valid", lambda x: x == a))).alias("n"), i.alias("i"), a.alias("a")))
    best = F.array_min(counted)
    votes = F.size("valid")
    return held.select(
        key,
        F.when(votes > 0, best["a"]).otherwise(F.col("fallback")).alias("answer"),
        F.when(votes > 0, -best["n"] / votes).otherwise(1.0).alias("consistency"),
        F.when(votes > 0, F.size(F.array_distinct("valid"))).otherwise(1).alias("distinct_answers"),
        votes.alias("votes"),
        F.map_from_entries(F.transform(counted, lambda x: F.struct(x["a"].alias("key"), F.bround(-x["n"] / votes, 4).alias("value")))).alias("dist"),
    )


def weighted_answers(annotations: DataFrame, key: str = "question_id", answers: str = "answers") -> DataFrame:
    """(answer, weight, given) over all annotators: 'yes' counts 1, 'maybe' 0.5, anything else 0.1."""
    one = annotations.select(key, answers).dropDuplicates([key])
    rows = one.select(F.explode(answers).alias("a")).select(F.lower(F.trim("a.answer")).alias("answer"), F.col("a.answer_confidence").alias("c"))
    weight = F.when(F.coalesce("c", F.lit("yes")) == "yes", 1.0).when(F.col("c") == "maybe", 0.5).otherwise(0.1)
    return rows.where("answer <> ''").groupBy("answer").agg(F.sum(weight).alias("weight"), F.count("*").alias("given"))
