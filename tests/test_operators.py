import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumisift.functions import distributions as D
from lumisift.functions import text as X
from lumisift.operators import images, numbering, reports, votes
from lumisift.sources import readers
from lumisift.streaming import batches
from tests.conftest import rows


def column(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expression(F.col("v"))).collect()]


def test_answer_forms(spark):
    assert column(spark, ["Yes, there is a dog.", "  DARK BLUE  ", None, ""], X.format_clean) == ["yes, there is a dog", "dark blue", "", ""]
    assert column(spark, ["Yes, there is.", "No.", "Maybe", "I know"], X.yes_no) == ["yes", "no", None, "no"]
    assert column(spark, ["one", "15", "twenty", "fifty", None], X.number_of) == ["1", "15", "20", None, None]
    assert column(spark, ["one", "15", "60", "fifty"], X.counting_confidence) == [1.0, 1.0, 0.5, 0.3]
    assert column(spark, ["dark blue", "very dark blue", "pink", "a red car", "dark", ""], X.color_core) == ["blue", "blue", "pink", "red", None, None]
    assert column(spark, ["left side", "center", "in the background", "bottom right", "top-left corner", "sky"], X.place_core) == ["left", "center", "back", "right", "left", None]
    assert column(spark, ["The  Red-car!", "two", "A"], X.match_form) == ["redcar", "two", ""]


def test_replies_and_markdown(spark):
    assert column(spark, ["## Head\n**bold** and *it*\n1. item"], X.plain_text) == ["Head bold and it item"]
    assert column(spark, ["say \"x-1\" and “y”, don't"], X.without_quotes) == ["say x-1 and y, don't"]
    assert column(spark, ["ab\x00\x01", "ab\n", ""], X.control_share) == [0.5, 0.0, 0.0]


def test_question_types(spark):
    asked = ["Is it red or blue?", "Is there a dog?", "What color is it?", "How many cars?", "Where is it?", "Why so?", "Hm"]
    assert column(spark, asked, X.question_type) == ["choice", "yes_no", "color", "counting", "location", "open", None]


probabilities = st.dictionaries(st.text("abcde", min_size=1, max_size=2), st.floats(0.01, 1.0), min_size=1, max_size=6)


@settings(max_examples=15, deadline=None)
@given(probabilities, probabilities)
def test_distribution_algebra(spark, p, q):
    df = spark.createDataFrame([(p, q)], "p map<string,double>, q map<string,double>").select(D.entries(F.col("p")).alias("p"), D.entries(F.col("q")).alias("q"))
    a, b = D.renormalised(F.col("p")), D.renormalised(F.col("q"))
    got = df.select(D.total(a).alias("one"), D.entropy(a).alias("h"), D.divergence(a, b).alias("kl"), D.cosine(a, b).alias("cos"), D.nucleus(F.col("p"), 0.9, 20).alias("n"), D.softened(F.col("p"), 1.0).alias("s")).first()
    x = {k: v / sum(p.values()) for k, v in p.items()}
    y = {k: v / sum(q.values()) for k, v in q.items()}
    assert math.isclose(got["one"], 1.0)
    assert math.isclose(got["h"], -sum(v * math.log2(v) for v in x.values()), abs_tol=1e-9)
    assert math.isclose(got["kl"], sum(v * math.log(v / max(y.get(k, 0), 1e-10)) for k, v in x.items()), abs_tol=1e-9)
    dot = sum(v * y.get(k, 0) for k, v in x.items())
    assert math.isclose(got["cos"], dot / math.hypot(*x.values()) / math.hypot(*y.values()), abs_tol=1e-9)
    kept, left = 0, 0.0
    for v in sorted(x.values(), reverse=True):
        kept += 1
        left += v
        if left > 0.9:
            break
    assert len(got["n"]) == kept or math.isclose(left, 0.9, abs_tol=1e-9)
    assert all(math.isclose(e["value"], x[e["key"]], abs_tol=1e-9) for e in got["s"])


def test_distributions_of_nothing(spark):
    df = spark.createDataFrame([(None,), ({},), ({"a": 0.0},), ({"a": None},)], "p map<string,double>")
    assert [r[0] for r in df.select(F.size(D.nucleus(D.entries(F.col("p")), 0.9, 5))).collect()] == [0, 0, 0, 0]


def test_of_equal_keys_the_last_stays(spark):
    held = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("a", 0.1), ("b", 0.2), ("a", 0.3))))
    assert spark.range(1).select(D.to_map(held)).first()[0] == {"b": 0.2, "a": 0.3}


def test_vote(spark):
    kind = "question_id long, answers array<struct<answer:string,answer_confidence:string>>, multiple_choice_answer string, answer string"
    given_rows = [
        (1, [("Red", "yes"), ("blue ", None), ("blue", "maybe"), ("red", "no")], "x", "clash"),
        (2, [("b", "yes"), ("a", "yes")], "x", None),
        (3, [("b", "no"), (" ", "yes"), (None, "yes")], " Car ", None),
        (4, [], None, None),
        (5, None, "y", None),
        (1, [("Red", "yes"), ("blue ", None), ("blue", "maybe"), ("red", "no")], "x", "clash"),
    ]
    found = rows(votes.vote(spark.createDataFrame(given_rows, kind)), "question_id", "answer", "votes")
    assert found == [(1, "blue", 3), (2, "b", 2), (3, "car", 0), (4, "", 0), (5, "y", 0)]
    assert votes.vote(spark.createDataFrame([], kind)).count() == 0
    assert rows(votes.weighted_answers(spark.createDataFrame(given_rows[:1], kind))) == [("blue", 1.5, 2), ("red", 1.1, 2)]


def test_numbers_and_running_sums(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("k"))
    assert [r["number"] - r["k"] for r in numbering.numbered(df, ["k"]).collect()] == [1] * 1000
    sums = numbering.running_sum(df, ["id"], F.col("k"), "s").orderBy("id").collect()
    total = 0
    for r in sums:
        total += r["k"]
        assert r["s"] == total
    assert numbering.numbered(df.where("false"), ["k"]).count() == 0


def test_samples(spark):
    df = spark.range(900).select("id", F.when(F.col("id") < 600, "a").when(F.col("id") < 890, "b").otherwise("c").alias("g"))
    assert numbering.sample(df, "id", 10).collect() == numbering.sample(df.repartition(7), "id", 10).collect()
    assert {r["g"]: r["count"] for r in numbering.sample_per_group(df, "id", "g", 20).groupBy("g").count().collect()} == {"a": 20, "b": 20, "c": 10}
    assert {r["g"]: r["count"] for r in numbering.sample_in_proportion(df, "id", "g", 90).groupBy("g").count().collect()} == {"a": 60, "b": 29, "c": 1}
    capped = numbering.capped(df, "id", "g", {"a": 0.5, "c": 0.5})
    assert {r["g"]: r["count"] for r in capped.groupBy("g").count().collect()} == {"a": 450, "b": 290, "c": 10}
    first = df.where("g = 'a'").orderBy(numbering.seeded("id", 42), "id").limit(450)
    assert rows(capped.where("g = 'a'"), "id") == rows(first, "id")


def test_reports(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.2,), (0.9,), (1.0,), (None,)], "v double")
    p = reports.profile(df, "v").first()
    assert (p["n"], p["q1"], p["q2"], p["q3"]) == (5, 0.2, 0.2, 0.9)
    closed = reports.calibration(df, F.col("v"), F.col("v") > 0.5).first()
    half = reports.calibration(df, F.col("v"), F.col("v") > 0.5, half_open=True).first()
    assert (closed["n"], half["n"]) == (5, 5)
    assert math.isclose(closed["ece"], (0.1 + 2 * 0.2 + 2 * 0.05) / 5) and math.isclose(half["ece"], (0.1 + 2 * 0.2 + 0.1) / 5)
    c = reports.concentration(df, F.col("v")).first()
    assert c["distinct_values"] == 4 and math.isclose(c["repetition"], 0.2)
    assert rows(reports.top(df, F.col("v"), 1)) == [(0.2, 2)]
    assert rows(reports.completeness(df, {"v": F.col("v")}), "field", "rows", "held") == [("v", 6, 5)]


def test_image_scores(spark):
    image = spark.createDataFrame([(1, 200, 100), (2, None, 0), (3, 300, 100)], "id long, width int, height int")
    instance = spark.createDataFrame([(1, 1, 3), (1, 1, 3), (1, 2, 1), (3, 3, None), (3, 4, 12)], "image_id long, id long, category_id int")
    asked = spark.createDataFrame([(1, "Is the road wet?"), (3, "A toy car?"), (2, None)], "image_id long, question string")
    found = {r["image_id"]: r for r in images.scores(image, instance, asked).collect()}
    assert math.isclose(found[1]["category_score"], 0.5 + 4.15 / 15) and found[1]["text_score"] == 0.5 and math.isclose(found[1]["scene_score"], 0.8)
    assert (found[2]["category_score"], found[2]["scene_score"], found[2]["objects"]) == (0.0, 0.5, 0)
    assert math.isclose(found[3]["category_score"], 0.3 / 20) and found[3]["text_score"] == 0.0 and math.isclose(found[3]["scene_score"], 0.7)
    category = spark.createDataFrame([(1, "p", "person"), (3, "c", "vehicle"), (12, "h", None)], "id int, name string, supercategory string")
    assert rows(images.scenes(instance, category)) == [(1, "mixed", 2), (3, "mixed", 2)]


def test_readers(spark, tmp_path):
    held = tmp_path / "records"
    held.mkdir()
    (held / "a.json").write_text(json.dumps({"image_id": "1", "question": "Q"}))
    (held / "bad.json").write_text('{"image_id": ')
    (held / "report_x.json").write_text(json.dumps({"image_id": "2"}))
    assert rows(readers.json_files(spark, str(held), "image_id string, question string")) == [("1", "Q")]
    readers.write_lines(spark.createDataFrame([("1", "open"), ("2", "closed")], "image_id string, question_category string"), str(tmp_path / "out"), "question_category")
    assert readers.json_lines(spark, str(tmp_path / "out/question_category=open")).count() == 1
    (tmp_path / "ann.json").write_text(json.dumps({"questions": [{"question_id": 1, "image_id": 2, "question": "Q"}]}))
    assert rows(readers.annotations(spark, str(tmp_path / "ann.json"), "questions", "questions")) == [(1, 2, "Q")]
    (tmp_path / "words.txt").write_text("# section\nRoad\n\n# negative words\ntoy\n# more\ndoll\n")
    assert readers.keywords(str(tmp_path / "words.txt")) == (["road"], ["toy", "doll"])
    assert rows(readers.remaining(spark.range(3), spark.range(1), "id")) == [(1,), (2,)]


def test_stream(spark, tmp_path):
    events = spark.createDataFrame([("2024-01-01 01:00:00", "a", 1.0), ("2024-01-01 05:00:00", "a", 2.0), ("2024-01-02 01:00:00", "b", 4.0)], "ts string, event_type string, value double")
    events.selectExpr("cast(ts as timestamp) as ts", "event_type", "value").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "in"))
    found = batches.run_once(spark, batches.windowed(stream, "ts", "event_type", "value"), "test")
    assert rows(found, "group", "n", "total") == [("a", 2, 3.0), ("b", 1, 4.0)]


def test_rows_later_than_the_watermark_are_left_out(spark, tmp_path):
    def arrive(name, *held):
        df = spark.createDataFrame(list(held), "ts string, event_type string, value double")
        df.selectExpr("cast(ts as timestamp) as ts", "event_type", "value").coalesce(1).write.parquet(str(tmp_path / "in" / name))

    arrive("a", ("2024-01-01 01:00:00", "a", 1.0), ("2024-03-01 01:00:00", "a", 2.0))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    aggregated = batches.windowed(stream, "ts", "event_type", "value", late="30 days")
    seen = []
    query = aggregated.writeStream.outputMode("update").foreachBatch(lambda batch, _: seen.extend(batch.collect())).option("checkpointLocation", str(tmp_path / "state"))
    query.trigger(availableNow=True).start().awaitTermination()
    arrive("b", ("2024-01-01 02:00:00", "a", 4.0), ("2024-02-20 01:00:00", "a", 8.0))
    query.trigger(availableNow=True).start().awaitTermination()
    found = {(r["window_start"].month, r["n"], r["total"]) for r in seen}
    assert (2, 1, 8.0) in found and not any(total in (4.0, 5.0) for _, _, total in found)
