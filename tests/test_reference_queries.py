import importlib

import pytest

from lumisift.plans import answer_queries, curation_queries, nested_queries, quality_queries, reference_queries, store_queries, token_queries
from tests.oracle import DATA, compare, needs_data

QUERIES, SQL = reference_queries.QUERIES, reference_queries.SQL


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    compare(spark, QUERIES[name], SQL[name])


OTHERS = {name: (m.QUERIES[name], sql) for m in (answer_queries, curation_queries, nested_queries, quality_queries, store_queries, token_queries) for name, sql in m.SQL.items()}


@needs_data
@pytest.mark.parametrize("name", sorted(OTHERS))
def test_other_query_equals_its_sql(spark, name):
    compare(spark, *OTHERS[name])


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


@needs_data
def test_answer_distances_equal_a_plain_table(spark):
    held = spark.read.parquet(f"{DATA}/training_records.parquet").select("record_id", "hard_label.answer", "soft_label.primary_answer").distinct().collect()
    expected = {r[0]: edits(r[1], r[2]) for r in held if r[1] is not None and r[2] is not None}
    found = {r["record_id"]: r["distance"] for r in QUERIES["answer_distances"](spark, str(DATA)).collect()}
    assert found == {k: d for k, d in expected.items() if d > 0} and found


@needs_data
def test_nested_tables_are_linked(spark):
    tasks, answers, steps = (nested_queries.QUERIES[f"p2_{n}"](spark, str(DATA)) for n in ("tasks", "answers", "steps"))
    for children in (answers, steps):
        orphans = children.join(tasks.select("sample_id", tasks["row_key"].alias("parent_key")), ["sample_id", "parent_key"], "left_anti")
        assert children.count() > 0 == orphans.count()
    found = nested_queries.QUERIES["p2_found"](spark, str(DATA))
    assert found.count() == found.distinct().count() == tasks.count() + answers.count() + steps.count()


def test_entry_module_lists_queries():
    entry = importlib.import_module("__spark_entry__")
    held = entry.queries()
    assert set(QUERIES) <= set(held) and "p2_found" in held
    assert set(entry.oracle_sql()) <= set(held)


@needs_data
def test_flagship_has_rows(spark):
    assert importlib.import_module("__spark_entry__").entry(spark).count() > 0
