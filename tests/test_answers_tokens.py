from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumisift.functions import answers as A
from lumisift.functions import curation as Q
from lumisift.functions import numbers as U
from lumisift.functions import tokens as K
from lumisift.functions import types as Y
from lumisift.operators import images
from lumisift.runtime import clear_stored, shared_dir, stored, stored_once
from lumisift.sources import stores
from tests.conftest import rows


def values(spark, held, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in held], f"v {kind}")
    return [r[0] for r in df.select(f(F.col("v"))).collect()]


def test_replies_are_taken_apart_with_fallbacks(spark):
    held = ["[Reasoning] why\n[Answer] red\nrest", "[Answer] a [Answer] b", "none", "[Reasoning] leaked", "[Answer]", None, ""]
    assert values(spark, held, A.short_answer) == ["red", "b", "", "", "", "", ""]
    assert values(spark, held, A.reasoning) == ["why", "", "none", "leaked", "", "", ""]


def test_matches(spark):
    held = [("[Answer] The 2.", "two", False, True), ("[Answer] 3", "two", False, False), ("two vans", "two", False, False), ("I see two red vans", "red two", True, True), ("[Answer] red", "red two", True, False), ("x", "the", True, False), (None, "red", True, False)]
    df = spark.createDataFrame(held, "r string, g string, o boolean, e boolean")
    assert [r[0] == r[1] for r in df.select(A.matches(F.col("r"), F.col("g"), F.col("o")), "e").collect()] == [True] * len(held)


def test_short_forms(spark):
    long = ["A bodyboard", "There is no sign here", "The answer is yes", "I can see three people", "There are 5 cats", "It is a van.", "the x", "there's fog", None, ""]
    assert values(spark, long, A.simplified) == ["bodyboard", "no sign", "answer is yes", "3", "5", "a van", "x", "fog", None, ""]
    assert values(spark, ["Red, and black!", "it's  Été", None, ""], A.closed_form) == ["red and black", "its été", "", ""]
    assert values(spark, ["gray and one", "red or blue or red", "a, b", ""], A.answer_set) == [["grey", "1"], ["red", "blue"], ["a b"], []]
    assert values(spark, ["Score: 85 of 90", "Score: 185, **70**", "7 of 250 and 9", "none", None], A.judge_score) == [85.0, 70.0, 9.0, None, None]
    assert values(spark, ["15", "two", "60 cars", "none", None], lambda c: A.parsed_number(c).cast("int")) == [15, 2, 60, None, None]
    assert values(spark, ["2", "two", "60", "unknown"], lambda c: A.counting_check(c)["valid"]) == [True, False, False, False]
    assert values(spark, ["two", "60", "unknown"], lambda c: A.counting_check(c)["parsed"].cast("int")) == [2, 60, None]
    assert values(spark, ["Is this meant for males or females to use?", "this or that?", "red or blue?"], A.options) == [["males", "females"], ["this", "that"], ["red", "blue"]]
    assert values(spark, ["so\n**Final Answer**: *red*\nend", " plain ", None], A.final_answer) == ["red", "plain", None]
    assert values(spark, ["system user assistant", "Your task is to x. your TASK is to y", "the user"], A.echoes_prompt) == [True, True, False]
    assert values(spark, ["Let's see\nA bus", "First\nx"], A.trimmed_caption) == ["A bus", "x"]


def test_checks_before_use(spark):
    held = ["Orange and white", "red and big", "red, white", None]
    assert values(spark, held, Q.is_color_pair) == [True, False, False, None]
    assert values(spark, ["a toy car", "toys", None], lambda c: Q.has_word(c, ("toy",))) == [True, False, None]
    assert values(spark, ["It might be; perhaps.", "It is.", None], Q.speculative)[:2] == [2, 0]
    assert values(spark, ["A Clearly Visible  bus"], lambda c: Q.without_phrases(c, ("clearly visible",))) == ["A bus"]
    assert values(spark, ["redredredredred", "redredred", "abcabcabcabc", "a long answer here", "", None], Q.repeats_itself) == [True, False, True, False, False, False]
    assert values(spark, ["choice", "color", "location", None], Q.major) == ["closed_choice", "closed_enumerate", "open_type", "open_type"]


def test_scenarios(spark):
    df = spark.createDataFrame([("how many", None), (None, "What color is it?"), ("none of the above", ""), ("", "Is it?"), (None, "Where?"), (None, None), ("zz", "Is it?")], "t string, q string")
    assert [r[0] for r in df.select(A.scenario(F.col("t"), F.col("q"))).collect()] == ["counting", "color", "choice", "yes_no", "open", "other", "other"]


def test_token_validity(spark):
    held = ["", " ", "<pad>", "?", "Ġred", "-red", "red-", "Ab", "##ing", "*t", "the", "7", "red", "van", "trucks", "x" * 21, "yes", None]
    expected = [False] * 11 + [True, True, False, True, False, True, None]
    assert values(spark, held, K.valid) == expected
    assert values(spark, ["van", "wal"], lambda c: K.valid(c, K.Rules(short_words=("van",), pieces=("wal",)))) == [True, False]


def test_canonical_tokens(spark):
    held = ["Two.", "(dogs)", "cities", "boxes", "tables", "glasses", "class", "bus", "right", "--", "Greys", "watches"]
    assert values(spark, held, K.canonical) == ["2", "dog", "city", "box", "tables", "glass", "class", "bus", "yes", "--", "gray", "watch"]
    assert values(spark, ["babies", "boxes", "dogs", "glass", "is", "cheese"], K.stem) == ["baby", "box", "dog", "glass", "is", "cheese"]


def test_filtered_distributions(spark):
    df = spark.createDataFrame([({"Red": 0.5, "the": 0.3, "van": 0.2}, "van"), ({"the": 1.0}, "the"), ({"a": 0.6, "an": 0.4}, None), ({"x": 0.0001, "trucks": 0.5}, "x")], "d map<string,double>, p string")
    kept = df.select(K.kept(F.map_entries("d"), F.col("p")).alias("k")).collect()
    assert [{e["key"]: round(e["value"], 3) for e in r["k"]} for r in kept] == [{"red": 0.714, "van": 0.286}, {"the": 1.0}, {}, {"trucks": 1.0}]


def test_type_levels(spark):
    df = spark.createDataFrame([(["vehicle"], ["vehicle"]), (["person"], ["vehicle"]), (["number"], ["vehicle"]), ([], ["vehicle"]), (["number"], []), (["object"], [])], "m array<string>, t array<string>")
    found = df.select(*Y.outcome(F.col("m"), F.col("t"))).collect()
    assert [(r["ok"], r["typed"], r["level"]) for r in found] == [(True, True, 4), (False, True, 1), (False, True, 2), (False, True, 4), (False, False, 2), (True, False, 4)]


def plain_candidates(text):
    digits = "".join(c for c in text if c.isdigit())
    if not digits:
        return [text]
    n = int(digits)
    held = {str(n + d) for d in (-2, -1, 0, 1, 2, -10, 10, -100, 100) if n + d >= 0}
    if 2 <= len(digits) <= 4:
        held |= set(sorted({"".join(p) for p in permutations(digits)} - {digits})[:10])
    confused = {"0": "Oo", "1": "lIi", "2": "Zz", "5": "Ss", "8": "B"}
    held |= {digits[:i] + r + digits[i + 1 :] for i, c in enumerate(digits) for r in confused.get(c, "")}
    held |= {digits[:i] + " " + digits[i:] for i in range(1, len(digits))}
    cut = sorted(held, key=lambda x: (" " in x, any(c.isalpha() for c in x), len(x), x))[:50]
    return sorted(cut, key=lambda x: (len(x), x))


def test_reading_candidates_equal_a_plain_version(spark):
    held = ["7", "12", "105", "2581", "58210", "0", "no", "20085218520852", "bus 21"]
    assert values(spark, held, U.candidates) == [plain_candidates(h) for h in held]
    assert values(spark, ["12", "21", "x"], U.spoken) == ["twelve", None, None]


def test_captions_count_half(spark):
    image = spark.createDataFrame([(1, 10, 10), (2, 10, 10), (3, 10, 10)], "id long, width int, height int")
    none = spark.createDataFrame([], "image_id long, id long, category_id int")
    asked = spark.createDataFrame([(1, "a road"), (2, "a road")], "image_id long, question string")
    told = spark.createDataFrame([(1, "the lane"), (3, "the lane"), (2, "a toy car")], "image_id long, caption string")
    assert rows(images.scores(image, none, asked, captions=told), "image_id", "text_score") == [(1, 1.0), (2, 0.5), (3, 0.5)]
    assert rows(images.scores(image, none, asked, captions=told, words=("toy",), negative=("zz",)), "image_id", "text_score") == [(1, 0.0), (2, 0.5), (3, 0.0)]


def test_stores(spark, tmp_path):
    kind = "image_id string, image_path string, tasks map<string,struct<answer:string,logits:array<double>>>, logits string, metadata struct<a:int,top_k:int>"
    df = spark.createDataFrame([("1", "d/COCO_7.jpg", {"vqa": ("a", [1.0]), "logits": ("b", None)}, "x", (1, 2)), ("2", "", {"vqa": ("a", None)}, None, None), ("cat", None, {"vqa": None}, None, None), (" ", "p.jpg", {"v": None}, None, None), ("3", "p.jpg", {}, None, None)], kind)
    assert stores.save_samples(df, str(tmp_path / "s")) == (3, 2)
    back = spark.read.json(str(tmp_path / "s"))
    assert rows(back, "stored_name") == [("COCO_7",), ("COCO_val2014_000000000002",), ("cat",)]
    assert set(back.columns) == {"image_id", "image_path", "tasks", "metadata", "stored_name"} and back.schema["tasks"].dataType.names == ["vqa"]
    assert rows(stores.saved_ids(back)) == [("1",), ("2",), ("cat",)]
    assert rows(stores.sample_of(back, "2"), "image_id") == [("2",)] and rows(stores.sample_of(back, "COCO_7"), "image_id") == [("1",)]
    ids = spark.createDataFrame([("1",)], "image_id string")
    stores.append_checkpoint(ids, str(tmp_path / "c"))
    stores.append_checkpoint(ids, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).count() == 2
    made = []
    make = lambda: made.append(1) or ids
    assert [stores.ground_truth(spark, str(tmp_path / "g"), make, m).count() for m in ("disabled", "auto", "auto", "rebuild")] == [1] * 4 and len(made) == 3
    (tmp_path / "pool.json").write_text('{"color": {"red": 3},\n "count": {"1": 2}}')
    assert rows(stores.pool(spark, str(tmp_path / "pool.json"))) == [("color", "red", 3), ("count", "1", 2)]
    (tmp_path / "scenes.json").write_text('{"7": {"primary_scene": "road", "scenes": ["road"]}}')
    assert rows(stores.scene_map(spark, str(tmp_path / "scenes.json")), "image_id", "primary_scene") == [("7", "road")]


def test_training_samples_need_question_target_and_image(spark):
    kind = "image_path string, question string, question_category string, hard_label struct<answer:string>, soft_label struct<answer_distribution:map<string,double>>, cot_reasoning struct<reasoning_paragraph:string,answer:string>"
    held = [("a/x.jpg", "Q", "open", None, None, ("r", "red")), ("b/y.jpg", "Q", None, ("blue",), ({"blue": 1.0},), None), ("", "Q", None, ("c",), None, None), ("a/x.jpg", "", None, ("c",), None, None), ("a/x.jpg", "Q", None, None, None, ("r", None)), ("lost.jpg", "Q", None, ("c",), None, None), ("z/w.jpg", "Q", None, ("c",), None, None)]
    files = spark.createDataFrame([("a/x.jpg",), ("images/b/y.jpg",), ("other/w.jpg",), ("other2/w.jpg",)], "path string")
    df = spark.createDataFrame(held, kind)
    assert stores.training_samples(df).count() == 4
    found = stores.training_samples(df, files)
    assert rows(found, "image_path", "target", "is_closed", "is_open") == [("a/x.jpg", "[Reasoning] r\n[Answer] red", False, True), ("images/b/y.jpg", "[Answer] blue", True, False), ("other/w.jpg", "[Answer] c", False, False)]


def test_stored_folders_are_reused_and_removed(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    first = stored_once(source, "kept", source)
    assert stored_once(source.limit(0), "kept", source).count() == 5  # read, not made again
    other = stored(source, "other")
    assert other.count() == 5 and clear_stored(spark) >= 2
    assert stored_once(source, "kept", source).count() == 5  # made again after its removal
    assert first.columns == ["id"] and shared_dir(spark)


@settings(max_examples=20, deadline=None)
@given(st.sampled_from(["128m", "134217728", "134217728b", "1g", "512k"]))
def test_sizes_are_read(text):
    from lumisift.runtime import _bytes_of

    assert _bytes_of(text) == {"128m": 1 << 27, "134217728": 1 << 27, "134217728b": 1 << 27, "1g": 1 << 30, "512k": 1 << 19}[text]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    held = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        shared_dir(held)
