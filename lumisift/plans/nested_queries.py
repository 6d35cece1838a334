"""Queries of problem 2: one emission, written once by tag, and a typed read of each tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.operators import nested_tables as nt
from lumisift.runtime import stored_once, table


def emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tagged rows of both sample tables, each once, stored by tag; all queries of a session read the same files."""
    typed, raw = table(spark, sf_dir, "merged_samples"), table(spark, sf_dir, "raw_samples")
    rows = nt.distinct_rows(nt.emit_typed(typed).unionByName(nt.emit_json(raw)))
    return stored_once(rows, "nested-tables", typed.select("sample_id").union(raw.select("sample_id")), ["tag"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emission(spark, sf_dir).select("sample_id", "task", F.col("tag").alias("child"), "child_key")


def p2_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.apply_schema(emission(spark, sf_dir), "task").drop("parent_key", "child_key")


def p2_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.apply_schema(emission(spark, sf_dir), "answer").withColumnRenamed("child_key", "answer")


def p2_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nt.apply_schema(emission(spark, sf_dir), "step").withColumnRenamed("child_key", "step")


def nested_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The emission of the typed samples alone, whose shape SQL can follow."""
    rows = nt.distinct_rows(nt.emit_typed(table(spark, sf_dir, "merged_samples")))
    return rows.select("sample_id", "tag", "row_key", "parent_key", "task", "child_key")


QUERIES = {"p2_found": p2_found, "p2_tasks": p2_tasks, "p2_answers": p2_answers, "p2_steps": p2_steps, "nested_typed_rows": nested_typed_rows}

_SAMPLES = "tasks as (select sample_id, e.key as task, e.value as t from (select sample_id, unnest(map_entries(tasks)) as e from (select distinct on (sample_id) sample_id, tasks from merged_samples)))"
_STEPS = " union all ".join(f"select sample_id, 'step', 't/' || task || '/s/{s}', 't/' || task, task, '{s}' from tasks where regexp_matches(t.cot_reasoning.structured_reasoning.{s}, '[^\\s\\x{{0b}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]')" for s in ("observation", "analysis", "conclusion"))
SQL = {
    "nested_typed_rows": f"""with {_SAMPLES} select sample_id, 'task' as tag, 't/' || task as row_key, null::varchar as parent_key, task, task as child_key from tasks
union all select sample_id, 'answer', 't/' || task || '/a/' || a, 't/' || task, task, a from (select sample_id, task, unnest(map_keys(t.soft_label.answer_distribution)) as a from tasks) union all {_STEPS}"""
}
