"""Problem 2: deeply nested sample records to flat, linked tables in one pass.

Every source row is visited once, depth first, and emits tagged rows
``(tag, sample_id, row_key, parent_key, task, child_key, payload)``:

========  ==========================================  ======================
tag       child_key                                   payload fields
========  ==========================================  ======================
task      the task's name                             TASK_SCHEMA
answer    a candidate answer as written               ANSWER_SCHEMA
step      observation, analysis or conclusion         STEP_SCHEMA
========  ==========================================  ======================

``row_key`` is unique within a sample, ``parent_key`` is the ``row_key`` of the
task that holds an answer or step and null for a task. ``payload`` is JSON;
:func:`apply_schema` types the rows of one tag and :func:`write_tagged` writes
the emission partitioned by tag.

Defined results: a null or incomplete payload, and a JSON value that isn't an
object, gives no rows; a task that isn't an object still counts as a task without
children; an empty or null distribution or reasoning gives no child rows; a
repeated answer of one distribution counts once (the last probability stays);
blank reasoning steps are left out. Repeated source rows are merged by
:func:`distinct_rows`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TASK_SCHEMA = "question string, question_type string, hard_answer string, confidence double, primary_answer string"
ANSWER_SCHEMA = "probability double"
STEP_SCHEMA = "text string"
SCHEMAS = {"task": TASK_SCHEMA, "answer": ANSWER_SCHEMA, "step": STEP_SCHEMA}
STEPS = ("observation", "analysis", "conclusion")
EMITTED = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("sample_id", T.LongType()),
        T.StructField("row_key", T.StringType()),
        T.StructField("parent_key", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("child_key", T.StringType()),
        T.StructField("payload", T.StringType()),
    ]
)
ROOT_TASK = "vqa"


def _object(value: object) -> object:
    """A JSON object or list held as text is opened; anything else is returned as it is."""
    if isinstance(value, str) and value.lstrip()[:1] in ("{", "["):
        try:
            return json.loads(value)
        except ValueError:
            return value
    return value


def _number(value: object) -> float | None:
    try:
        return None if value is None or isinstance(value, (bool, dict, list)) else float(value)
    except ValueError:
        return None


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False)


def _tasks(record: dict) -> Iterator[tuple[str, object]]:
    if "tasks" not in record:
        yield ROOT_TASK, record
        return
    held = _object(record["tasks"])
    if isinstance(held, dict):
        yield from held.items()
    elif isinstance(held, list):
        for position, item in enumerate(held):
            item = _object(item)
            name = item.get("task") or item.get("name") if isinstance(item, dict) else None
            yield str(name or position), item


def _answers(task: dict) -> dict[str, float | None]:
    soft = _object(task.get("soft_label"))
    held = _object(soft.get("answer_distribution")) if isinstance(soft, dict) else None
    if isinstance(held, dict):
        return {k: _number(v) for k, v in held.items()}
    out: dict[str, float | None] = {}
    for item in held if isinstance(held, list) else ():
        if isinstance(item, dict):
            key = next((item[k] for k in ("answer", "key", "token", "text") if item.get(k) is not None), None)
            if key is not None:
                out[_text(key)] = _number(next((item[k] for k in ("prob", "probability", "value", "p") if k in item), None))
        elif isinstance(item, list) and item and item[0] is not None:
            out[_text(item[0])] = _number(item[1] if len(item) > 1 else None)
        elif isinstance(item, str):
            out[item] = None
    return out


def _steps(task: dict) -> dict[str, str]:
    cot = _object(task.get("cot_reasoning"))
    if not isinstance(cot, dict):
        return {}
    held = _object(cot.get("structured_reasoning"))
    found: dict[str, object] = {}
    if isinstance(held, dict):
        found = held
    elif isinstance(held, list):
        for item in held:
            if isinstance(item, dict):
                found[str(item.get("step") or item.get("name") or item.get("type"))] = item.get("text", item.get("content"))
                found |= {k: item[k] for k in STEPS if k in item}
    found = {k: cot[k] for k in STEPS if k in cot} | found
    return {k: found[k] for k in STEPS if isinstance(found.get(k), str) and found[k].strip()}


def visit(sample_id: int, record: dict) -> Iterator[tuple]:
    """Depth-first walk of one record; yields the columns of ``EMITTED``."""
    for task_name, held in _tasks(record):
        key = f"t/{task_name}"
        held = _object(held)
        task = held if isinstance(held, dict) else {}
        hard, soft = _object(task.get("hard_label")), _object(task.get("soft_label"))
        payload = {
            "question": _text(task.get("question")),
            "question_type": _text(task.get("question_type")),
            "hard_answer": _text(hard.get("answer")) if isinstance(hard, dict) else _text(hard),
            "confidence": _number(hard.get("confidence")) if isinstance(hard, dict) else None,
            "primary_answer": _text(soft.get("primary_answer")) if isinstance(soft, dict) else None,
        }
        yield "task", sample_id, key, None, task_name, task_name, json.dumps(payload, ensure_ascii=False)
        for answer, probability in _answers(task).items():
            yield "answer", sample_id, f"{key}/a/{answer}", key, task_name, answer, json.dumps({"probability": probability})
        for step, text in _steps(task).items():
            yield "step", sample_id, f"{key}/s/{step}", key, task_name, step, json.dumps({"text": text}, ensure_ascii=False)


def _strict(text: str) -> object:
    def refuse(name: str) -> None:
        raise ValueError(name)

    return json.loads(text, parse_constant=refuse)


_ARROW = pa.schema([(f.name, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for f in EMITTED])


def _visit_payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[] for _ in EMITTED]
        for sample_id, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                record = _strict(payload)
            except (ValueError, RecursionError):
                continue
            if not isinstance(record, dict):
                continue
            for row in visit(sample_id, record):
                for column, value in zip(columns, row):
                    column.append(value.encode("utf-8", "replace").decode() if isinstance(value, str) else value)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def emit_json(df: DataFrame, id_col: str = "sample_id", payload_col: str = "payload") -> DataFrame:
    """Tagged rows of records held as JSON text whose shape drifts."""
    rows = df.select(F.col(id_col).cast("long").alias("sample_id"), F.col(payload_col).alias("payload")).where(F.col("payload").isNotNull())
    return rows.mapInArrow(_visit_payloads, EMITTED)


def _emitted(tag: str, sample_id: Column, row_key: Column, parent: Column, task: Column, child: Column, payload: Column) -> Column:
    return F.struct(
        F.lit(tag).alias("tag"),
        sample_id.alias("sample_id"),
        row_key.alias("row_key"),
        parent.cast("string").alias("parent_key"),
        task.alias("task"),
        child.alias("child_key"),
        payload.alias("payload"),
    )


def emit_typed(df: DataFrame, id_col: str = "sample_id", tasks_col: str = "tasks") -> DataFrame:
    """Tagged rows of records whose ``tasks`` column is a typed map of structs; all in the JVM, one Generate."""
    rows = df.select(F.col(id_col).cast("long").alias("sample_id"), F.col(tasks_col).alias("tasks"))
    sample = F.col("sample_id")

    def of_task(entry: Column) -> Column:
        name, task = entry["key"], entry["value"]
        key = F.concat(F.lit("t/"), name)
        head = _emitted(
            "task",
            sample,
            key,
            F.lit(None),
            name,
            name,
            F.to_json(
                F.struct(
                    task["question"].alias("question"),
                    task["question_type"].alias("question_type"),
                    task["hard_label"]["answer"].alias("hard_answer"),
                    task["hard_label"]["confidence"].alias("confidence"),
                    task["soft_label"]["primary_answer"].alias("primary_answer"),
                )
            ),
        )
        answers = F.transform(
            F.map_entries(task["soft_label"]["answer_distribution"]),
            lambda a: _emitted("answer", sample, F.concat(key, F.lit("/a/"), a["key"]), key, name, a["key"], F.to_json(F.struct(a["value"].alias("probability")))),
        )
        structured = task["cot_reasoning"]["structured_reasoning"]
        steps = [
            F.when(
                F.coalesce(structured[s], F.lit("")).rlike(r"(?U)\S"),
                _emitted("step", sample, F.concat(key, F.lit(f"/s/{s}")), key, name, F.lit(s), F.to_json(F.struct(structured[s].alias("text")))),
            )
            for s in STEPS
        ]
        none = F.array().cast(T.ArrayType(EMITTED))
        return F.concat(F.array(head), F.coalesce(answers, none), F.array_compact(F.array(*steps)))

    return rows.select(F.explode(F.flatten(F.transform(F.map_entries("tasks"), of_task))).alias("row")).select("row.*").select(*(F.col(f.name).cast(f.dataType) for f in EMITTED))


def distinct_rows(emitted: DataFrame) -> DataFrame:
    """One row per (sample_id, row_key): rows of repeated samples are merged."""
    return emitted.groupBy("tag", "sample_id", "row_key", "parent_key", "task", "child_key").agg(F.max("payload").alias("payload"))


def apply_schema(emitted: DataFrame, tag: str) -> DataFrame:
    """The flat table of one tag, its payload typed."""
    rows = emitted.where(F.col("tag") == tag).withColumn("payload", F.from_json("payload", SCHEMAS[tag]))
    return rows.select("sample_id", "row_key", "parent_key", "task", "child_key", "payload.*")


def write_tagged(emitted: DataFrame, path: str) -> None:
    """Writes the single emission partitioned by tag; read one with ``read_tagged``."""
    emitted.write.mode("overwrite").partitionBy("tag").parquet(path)


def read_tagged(spark, path: str, tag: str) -> DataFrame:
    """The flat table of one tag of a written emission; only its directory is read."""
    return apply_schema(spark.read.parquet(path), tag)
