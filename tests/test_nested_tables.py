import json

from lumisift.operators import nested_tables as nt
from tests.conftest import rows

FULL = {"question": "Q?", "hard_label": {"answer": "a", "confidence": 0.5}}


def emitted(spark, payloads):
    df = spark.createDataFrame([(i, p, "x", "y") for i, p in enumerate(payloads)], "sample_id long, payload string, task string, tag string")
    return nt.emit_json(df)


def keys(df):
    return rows(df, "sample_id", "task", "tag", "child_key")


def test_all_shapes_of_distribution_and_reasoning(spark):
    dist = {"x": 0.7, "y": 0.3}
    steps = {"observation": "o", "analysis": " ", "conclusion": "c"}
    shapes = [
        {"soft_label": {"answer_distribution": dist}, "cot_reasoning": {"structured_reasoning": steps}},
        {"soft_label": {"answer_distribution": [{"answer": k, "prob": v} for k, v in dist.items()]}, "cot_reasoning": {"structured_reasoning": [{"step": k, "text": v} for k, v in steps.items()]}},
        {"soft_label": {"answer_distribution": json.dumps(dist)}, "cot_reasoning": {"structured_reasoning": json.dumps(steps)}},
        {"soft_label": {"answer_distribution": dist}, "cot_reasoning": steps},
    ]
    payloads = [json.dumps({"tasks": {"vqa": s}}) for s in shapes] + [json.dumps({"tasks": [{"task": "vqa", **s}]}) for s in shapes] + [json.dumps(s) for s in shapes]
    found = keys(emitted(spark, payloads))
    expected = [(i, "vqa", tag, key) for i in range(12) for tag, key in (("task", "vqa"), ("answer", "x"), ("answer", "y"), ("step", "observation"), ("step", "conclusion"))]
    assert found == sorted(expected, key=repr)


def test_unreadable_and_empty_payloads_give_nothing(spark):
    payloads = [None, "", "{", "[1]", "3", "null", '{"a": 1', "{'a': 1}", json.dumps({"tasks": {}}), json.dumps({"tasks": None}), '{"tasks": {"t": NaN}}', json.dumps(FULL) + "x"]
    assert keys(emitted(spark, payloads)) == []


def test_null_parts_keep_the_task(spark):
    payload = json.dumps({"tasks": {"t": None, "u": {"soft_label": None, "cot_reasoning": "text"}, "v": {"soft_label": {"answer_distribution": None}}}})
    assert [r[2] for r in keys(emitted(spark, [payload]))] == ["task"] * 3


def test_typed_and_json_forms_agree(spark, tmp_path):
    schema = (
        "sample_id long, tasks map<string, struct<question:string, question_type:string, hard_label:struct<answer:string,confidence:double>,"
        "soft_label:struct<answer_distribution:map<string,double>,primary_answer:string>,"
        "cot_reasoning:struct<structured_reasoning:struct<observation:string,analysis:string,conclusion:string>>>>, task string"
    )
    tasks = {
        "vqa": ("Q?", "color", ("red", 0.9), ({"red": 0.9, "blue": None}, "red"), (("o", None, "\t"),)),
        "other": (None, None, None, None, None),
        "none": None,
    }
    typed = spark.createDataFrame([(1, tasks, "clash"), (1, tasks, "clash"), (2, {}, None), (3, None, None)], schema)
    found = nt.distinct_rows(nt.emit_typed(typed))
    assert keys(found) == sorted([(1, "vqa", "task", "vqa"), (1, "other", "task", "other"), (1, "none", "task", "none"), (1, "vqa", "answer", "red"), (1, "vqa", "answer", "blue"), (1, "vqa", "step", "observation")], key=repr)
    nt.write_tagged(found, str(tmp_path / "t"))
    answers = rows(nt.read_tagged(spark, str(tmp_path / "t"), "answer"), "sample_id", "parent_key", "child_key", "probability")
    assert answers == [(1, "t/vqa", "blue", None), (1, "t/vqa", "red", 0.9)]
    task = nt.apply_schema(found, "task").where("task = 'vqa'").first()
    assert (task["question"], task["hard_answer"], task["confidence"]) == ("Q?", "red", 0.9)


def test_children_link_to_an_emitted_parent_and_long_texts_stay_whole(spark):
    long = "word " * 200_000
    payload = json.dumps({"tasks": {"t": {"cot_reasoning": {"observation": long}, "soft_label": {"answer_distribution": {"a": 1}}}}})
    df = emitted(spark, [payload])
    parents = {r["row_key"] for r in df.where("tag = 'task'").collect()}
    assert {r["parent_key"] for r in df.where("tag <> 'task'").collect()} <= parents
    assert nt.apply_schema(df, "step").first()["text"] == long


def test_empty_tables(spark):
    assert emitted(spark, []).count() == 0
