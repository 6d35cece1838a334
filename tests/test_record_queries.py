import pytest
from pyspark.sql import functions as F

from lumisift.functions import records as C
from lumisift.functions import text as X
from lumisift.functions.json_text import repaired
from lumisift.plans import record_queries
from tests.oracle import DATA, compare, needs_data


@needs_data
@pytest.mark.parametrize("name", sorted(record_queries.SQL))
def test_query_equals_its_sql(spark, name):
    compare(spark, record_queries.QUERIES[name], record_queries.SQL[name])


def values(spark, kind, given_values, expression):
    df = spark.createDataFrame([(v,) for v in given_values], f"v {kind}")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_words_and_numbers(spark):
    assert values(spark, "string", ["taxis", "buses", "berries", "glass", "bus", "keys", None, ""], C.singular) == ["taxi", "bus", "berry", "glass", "bus", "key", None, ""]
    assert values(spark, "string", ["Score: 85, out of 100", "7 of 250", "none", None], C.last_score) == [100, 7, None, None]
    assert values(spark, "long", [0, 5], C.neighbours) == [["0", "1", "2", "10", "100"], ["3", "4", "5", "6", "7", "15", "105"]]


def test_sizes(spark):
    df = spark.createDataFrame([(400, 500), (4000, 1000)], "w int, h int")
    width, height = C.resized(F.col("w"), F.col("h"), 200_000)
    assert [tuple(r) for r in df.select(width, height).collect()] == [(400, 500), (894, 223)]


def test_reasoning_and_targets(spark):
    kind = "cot struct<reasoning_paragraph:string,structured_reasoning:struct<observation:string,analysis:string,conclusion:string>>, a string"
    df = spark.createDataFrame([(("p", ("o", None, "c")), "x"), ((" ", ("o", " ", "c")), None), ((None, None), "y"), (None, "z")], kind)
    reasoning = C.reasoning_text(F.col("cot"))
    assert [r[0] for r in df.select(reasoning).collect()] == ["p", "o\nc", None, None]
    assert [r[0] for r in df.select(C.target_text(reasoning, F.col("a"))).collect()] == ["[Reasoning] p\n[Answer] x", None, "[Answer] y", "[Answer] z"]


def test_json_repair():
    assert repaired('text {"a": 1} more') == '{"a": 1}'
    assert repaired('{"a": [1, 2,], "b": "x}",}') == '{"a": [1, 2], "b": "x}"}'
    assert repaired("{a: 1, 'b\": 2}") == '{"a": 1, "b": 2}'
    assert repaired('{"a": 1, "b": {"c": "cut of') == '{"a": 1, "b": {"c": "cut of"}}'
    assert repaired('{"a": 1, "b": tr') == '{"a": 1}'
    assert [repaired(t) for t in (None, "", "none", "[1]", "{")] == [None, None, None, None, "{}"]


@needs_data
def test_payloads_are_repaired(spark):
    for r in record_queries.repaired_payloads(spark, str(DATA)).collect():
        assert r["whole"] <= r["usable"] <= r["samples"]


def test_number_tasks_and_entities(spark):
    df = spark.createDataFrame([("How many cars?", "3"), ("What year is it?", "1999"), ("Is it so?", "12"), ("Is it so?", "300"), ("Is it so?", "yes"), (None, None)], "q string, a string")
    found = df.select(X.number_task(F.col("q"), F.col("a"))["task"]).collect()
    assert [r[0] for r in found] == ["counting", "reading", "counting", "reading", None, None]
    assert values(spark, "string", ["Fire Trucks and a traffic light", None], X.merged_entities) == ["firetrucks and a trafficlight", None]


def test_number_tasks_of_all_labels(spark, tmp_path):
    given = [("How many cars?", "(3)"), ("How many cars?", "zero."), ("What year is it?", "früh"), ("Is it so?", " 12\t"), ("Is it so?", "-1"), ("Is it so?", "(10)"), ("Is it so?", "3.0"), ("Count the vans", None), ("Is it so?", "yes"), (None, "3")]
    spark.createDataFrame([(q, (a,)) for q, a in given * 2], "question string, hard_label struct<answer:string>").write.parquet(f"{tmp_path}/training_records.parquet")
    tasks = ["counting", "counting", "reading", "counting", "reading", None, None, "counting", None]
    found = {tuple(r) for r in record_queries.QUERIES["number_tasks"](spark, str(tmp_path)).select("question", "label", "task").collect()}
    assert found == {(q, a, t) for (q, a), t in zip(given, tasks)}
