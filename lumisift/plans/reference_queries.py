"""Queries of the record, label and image operators over the annotation and sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.functions import distributions as D
from lumisift.functions import text as X
from lumisift.operators import images as I
from lumisift.operators import numbering as N
from lumisift.operators import reports as R
from lumisift.operators import votes as V
from lumisift.runtime import cut_lineage, table
from lumisift.streaming import batches

QUERIES: dict = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _r(c: Column | str, name: str, digits: int = 6) -> Column:
    return F.round(c, digits).alias(name)


def _records(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    """Columns of the training records, each record once; only what they need is read and shuffled."""
    return table(spark, sf_dir, "training_records").select("record_id", *columns).dropDuplicates(["record_id"])


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "training_records").where("question_category = 'closed' and hard_label.answer is not null").select(F.col("hard_label.answer").alias("answer")).distinct()


def _dists(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, F.col("hard_label.answer").alias("hard"), D.entries(F.col("soft_label.answer_distribution")).alias("d"))
    return rows.where(F.size("d") > 0)


def _long(rows: DataFrame, *keys: str, digits: int | None = 6) -> DataFrame:
    p = F.col("col.value").alias("p") if digits is None else _r("col.value", "p", digits)
    return rows.select(*keys, F.posexplode("d")).select(*keys, "pos", F.col("col.key").alias("token"), p)


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "merged_samples").dropDuplicates(["sample_id"])
    return one.select("sample_id", F.col("quality_score"), F.explode("tasks").alias("task", "t"))


# --- text of answers and questions


@_query
def normalise_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("answer")
    return _answers(spark, sf_dir).select("answer", X.format_clean(a).alias("clean"), X.yes_no(a).alias("yes_no"), X.match_form(a).alias("match_form"))


@_query
def normalise_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("answer", X.number_of(F.col("answer")).alias("number"), X.counting_confidence(F.col("answer")).alias("confidence"))


@_query
def normalise_colors_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("answer", X.color_core(F.col("answer")).alias("color"), X.place_core(F.col("answer")).alias("place"))


@_query
def plain_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("cot_reasoning.raw_reasoning")
    return _records(spark, sf_dir, X.plain_text(raw).alias("plain"), X.without_quotes(F.col("cot_reasoning.reasoning_paragraph")).alias("unquoted")).where("plain is not null")


@_query
def reply_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("cot_reasoning.reasoning_paragraph")
    signals = [
        F.length(text).alias("chars"),
        F.size(F.split(text, " ")).alias("pieces"),
        _r(X.jaccard(X.words_of(F.col("question")), X.words_of(text)), "overlap"),
        _r(X.control_share(text), "control_share"),
        X.synonymous(F.col("hard_label.answer"), F.col("cot_reasoning.answer")).alias("same_answer"),
    ]
    return _records(spark, sf_dir, *signals).where("chars is not null")


@_query
def answer_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit distance, in characters, of each answer to its distribution's primary answer (other engines count bytes, so it has no oracle)."""
    distance = F.levenshtein(F.col("hard_label.answer"), F.col("soft_label.primary_answer"))
    return _records(spark, sf_dir, distance.alias("distance")).where("distance > 0")


@_query
def classify_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "vqa_questions").where("question is not null").select("question").distinct()
    return asked.select("question", X.question_type(F.col("question")).alias("type"), F.array_join(X.choice_options(F.col("question")), "|").alias("options"))


@_query
def question_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, "question_type", X.question_type(F.col("question")).alias("by_rule"))
    return rows.groupBy("question_type", "by_rule").agg(F.count("*").alias("records"))


# --- ground truth


@_query
def vote_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.vote(table(spark, sf_dir, "vqa_annotations"))
    return rows.select("question_id", "answer", _r("consistency", "consistency", 4), "distinct_answers", "votes")


@_query
def join_ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "vqa_questions").distinct()
    voted = V.vote(table(spark, sf_dir, "vqa_annotations"))
    return asked.join(voted, "question_id", "left").select("question_id", "image_id", F.trim("question").alias("question"), "answer", _r("consistency", "consistency", 4))


@_query
def questions_without_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "vqa_questions").distinct().join(table(spark, sf_dir, "vqa_annotations"), "question_id", "left_anti")


@_query
def first_question_of_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "vqa_questions").groupBy("image_id").agg(F.min(F.struct("question_id", "question")).alias("q"))
    return asked.select("image_id", "q.question_id", "q.question")


# --- distributions


@_query
def renormalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_dists(spark, sf_dir).withColumn("d", D.renormalised(F.col("d"))), "record_id")


@_query
def soften(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_dists(spark, sf_dir).withColumn("d", D.softened(F.col("d"), 3.0)), "record_id")


@_query
def nucleus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_dists(spark, sf_dir).withColumn("d", D.nucleus(F.col("d"), 0.9, 20)), "record_id")


@_query
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_dists(spark, sf_dir).withColumn("d", F.slice(D.ranked(F.col("d")), 1, 2)), "record_id")


@_query
def merge_equal_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _long(_dists(spark, sf_dir).withColumn("d", D.renormalised(F.col("d"))), "record_id", digits=None)
    return rows.groupBy("record_id", X.match_form(F.col("token")).alias("token")).agg(_r(F.sum("p"), "p"))


@_query
def merge_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _long(_dists(spark, sf_dir), "record_id", digits=None).withColumn("x", F.ln("p") / 3)
    top = F.max("x").over(Window.partitionBy("record_id"))
    merged = rows.withColumn("e", F.exp(F.col("x") - top)).groupBy("record_id", X.match_form(F.col("token")).alias("token")).agg(F.sum("e").alias("e"))
    return merged.select("record_id", "token", _r(F.col("e") / F.sum("e").over(Window.partitionBy("record_id")), "p"))


@_query
def distribution_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("d")
    rows = _dists(spark, sf_dir).withColumn("raw_sum", D.total(d)).withColumn("d", D.renormalised(d))
    order = D.ranked(d)
    first, second = F.get(order, F.lit(0)), F.get(order, F.lit(1))
    hard = D.probability(d, F.col("hard"))
    return rows.select(
        "record_id", _r("raw_sum", "raw_sum"), F.size("d").alias("tokens"), first["key"].alias("primary"), _r(D.entropy(d), "entropy"),
        _r(first["value"] - F.coalesce(second["value"], F.lit(0.0)), "gap"), _r(F.when(F.col("hard").isNotNull(), -F.ln(F.greatest(hard, F.lit(1e-10)))), "cross_entropy"),
    )


@_query
def compare_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tasks(spark, sf_dir).select("sample_id", "task", D.entries(F.col("t.gt_dist")).alias("p"), D.entries(F.col("t.soft_label.answer_distribution")).alias("q"))
    rows = rows.where((F.size("p") > 0) & (F.size("q") > 0)).select("sample_id", "task", D.renormalised(F.col("p")).alias("p"), D.renormalised(F.col("q")).alias("q"))
    p, q = F.col("p"), F.col("q")
    return rows.select("sample_id", "task", _r(D.divergence(p, q), "kl", 5), _r(D.cosine(p, q), "cosine", 5), (F.get(D.ranked(p), F.lit(0))["key"] == F.get(D.ranked(q), F.lit(0))["key"]).alias("same_top"))


# --- reports


@_query
def confidence_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = R.profile(_records(spark, sf_dir, F.col("hard_label.confidence").alias("c")), "c")
    return p.select("n", *(_r(c, c) for c in ("mean", "std", "least", "greatest", "q1", "q2", "q3")))


def _tier(c: Column) -> Column:
    return F.when(c < 0.4, "low").when(c <= 0.95, "middle").when(c <= 0.98, "high").when(c.isNotNull(), "ultra").otherwise("none")


@_query
def confidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, "question_category", _tier(F.col("hard_label.confidence")).alias("tier"))
    return rows.rollup("question_category", "tier").agg(F.count("*").alias("records"), F.grouping_id().alias("level"))


@_query
def cap_confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, _tier(F.col("hard_label.confidence")).alias("tier"))
    return N.capped(rows, "record_id", "tier", {"middle": 0.35, "ultra": 0.01})


@_query
def calibration_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tasks(spark, sf_dir)
    c, ok = F.col("t.hard_label.confidence"), X.match_form(F.col("t.hard_label.answer")) == X.match_form(F.col("t.ground_truth"))
    ok = F.when(F.col("t.ground_truth").isNotNull() & F.col("t.hard_label.answer").isNotNull(), ok)
    both = [R.calibration(rows, c, ok, half).select(F.lit(name).alias("bins"), "n", _r("ece", "ece")) for name, half in (("closed", False), ("half_open", True))]
    return both[0].unionByName(both[1])


@_query
def answer_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.concentration(_records(spark, sf_dir, X.format_clean(F.col("hard_label.answer")).alias("a")), F.col("a"))
    return rows.select("n", "distinct_values", *(_r(c, c) for c in ("entropy", "top_share", "repetition")))


@_query
def top_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top(_records(spark, sf_dir, X.format_clean(F.col("hard_label.answer")).alias("a")), F.col("a"), 20)


@_query
def repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top(_records(spark, sf_dir, F.col("cot_reasoning.reasoning_paragraph").alias("a")), F.col("a"), 5)


@_query
def reasoning_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("cot_reasoning.reasoning_paragraph")
    rows = _records(spark, sf_dir, "source", n.alias("n")).where("n is not null")
    return rows.groupBy("source").agg(F.count("*").alias("texts"), _r(F.avg("n"), "mean"), F.min("n").alias("least"), F.max("n").alias("greatest"), F.count_if(F.col("n") < 20).alias("short"), F.count_if(F.col("n") > 500).alias("long"))


@_query
def task_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tasks(spark, sf_dir).groupBy("task").agg(F.count("*").alias("tasks"), F.avg("t.hard_label.confidence").alias("mean"), F.avg(F.size(D.entries(F.col("t.soft_label.answer_distribution")))).alias("tokens"))
    return rows.select("task", "tasks", _r("mean", "mean"), _r("tokens", "tokens"))


@_query
def sample_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {f: F.col(f"t.{f}") for f in ("question", "ground_truth", "hard_label.answer", "hard_label.confidence", "soft_label.answer_distribution", "cot_reasoning.reasoning_paragraph", "candidate_pool")}
    return R.completeness(_tasks(spark, sf_dir), fields).select("field", "rows", "held", _r("share", "share"))


@_query
def quality_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "merged_samples").dropDuplicates(["sample_id"])
    score = F.col("quality_score.final_score")
    bucket = F.when(score.isNull(), "unscored").when(score >= 70, "high").when(score >= 40, "middle").otherwise("low")
    return one.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("samples"), _r(F.avg(score), "mean"), F.sum(F.coalesce(F.size("quality_score.issues"), F.lit(0))).alias("issues"))


@_query
def issue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "merged_samples").dropDuplicates(["sample_id"])
    return one.select(F.explode("quality_score.issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("samples"))


@_query
def evaluate_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = X.match_form(F.col("hard_label.answer")) == X.match_form(F.col("soft_label.primary_answer"))
    cot = X.match_form(F.col("hard_label.answer")) == X.match_form(F.col("cot_reasoning.answer"))
    rows = _records(spark, sf_dir, "question_type", exact.alias("soft"), cot.alias("cot"))
    return rows.groupBy("question_type").agg(F.count("*").alias("records"), _r(F.avg(F.col("soft").cast("int")), "soft_match"), _r(F.avg(F.col("cot").cast("int")), "reasoning_match"))


@_query
def category_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlation of how often each category is labelled in images and given as an answer."""
    names = table(spark, sf_dir, "categories").select(F.col("id").alias("category_id"), "name")
    one = table(spark, sf_dir, "instances").select("image_id", "id", "category_id").distinct()
    labelled = one.groupBy("category_id").agg(F.count("*").alias("seen"))
    said = _records(spark, sf_dir, X.format_clean(F.col("hard_label.answer")).alias("name")).groupBy("name").agg(F.count("*").alias("said"))
    rows = names.join(labelled, "category_id", "left").join(said, "name", "left").na.fill(0, ["seen", "said"])
    return rows.agg(F.count("*").alias("categories"), F.sum("seen").alias("seen"), F.sum("said").alias("said"), _r(F.corr("seen", "said"), "correlation"))


@_query
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of repeated sample rows the one that arrived last."""
    last = table(spark, sf_dir, "merged_samples").groupBy("sample_id").agg(F.max("received_at").alias("received_at"), F.count("*").alias("copies"))
    return last.select("sample_id", F.unix_micros("received_at").alias("received_us"), "copies")


# --- images, scenes, vocabularies


@_query
def image_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.scores(table(spark, sf_dir, "images"), table(spark, sf_dir, "instances"), table(spark, sf_dir, "vqa_questions"))
    return rows.select("image_id", "objects", *(_r(c, c) for c in ("category_score", "text_score", "scene_score", "score")))


@_query
def image_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances of the images that score at least 0.7, numbered anew."""
    kept = image_scores(spark, sf_dir).where("score >= 0.7").select("image_id")
    one = table(spark, sf_dir, "instances").select("image_id", "id", "category_id").distinct().join(kept, "image_id", "left_semi")
    return N.numbered(one, ["image_id", "id", "category_id"], "new_id")


@_query
def image_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = F.col("width") * F.col("height")
    group = F.when(pixels < 250_000, "small").when(pixels < 1_000_000, "medium").otherwise("large")
    return table(spark, sf_dir, "images").where("width > 0 and height > 0").groupBy(group.alias("size")).agg(F.count("*").alias("images"), F.sum(pixels.cast("long")).alias("pixels"))


@_query
def image_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.scenes(table(spark, sf_dir, "instances"), table(spark, sf_dir, "categories"))


@_query
def scene_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each scene the 20 answers with the most votes."""
    asked = table(spark, sf_dir, "vqa_questions").distinct()
    voted = V.vote(table(spark, sf_dir, "vqa_annotations")).select("question_id", "answer", "votes")
    scenes = I.scenes(table(spark, sf_dir, "instances"), table(spark, sf_dir, "categories")).select("image_id", "scene")
    counts = asked.join(voted, "question_id").join(scenes, "image_id").where("answer <> ''").groupBy("scene", "answer").agg(F.sum("votes").alias("votes"))
    rank = F.row_number().over(Window.partitionBy("scene").orderBy(F.desc("votes"), "answer"))
    return counts.withColumn("rank", rank).where("rank <= 20")


@_query
def answer_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.weighted_answers(table(spark, sf_dir, "vqa_annotations")).where("given >= 2")
    return rows.select("answer", _r("weight", "weight", 4), "given")


@_query
def vocabulary_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all given answers that the 100 heaviest make up."""
    rows = cut_lineage(V.weighted_answers(table(spark, sf_dir, "vqa_annotations")))
    kept = rows.orderBy(F.desc("weight"), "answer").limit(100).agg(F.sum("given").alias("covered"), F.lit(1).alias("one"))
    whole = rows.agg(F.sum("given").alias("given"), F.count("*").alias("answers"), F.lit(1).alias("one"))
    return whole.join(kept, "one").select("answers", "given", "covered", _r(F.col("covered") / F.col("given"), "coverage"))


@_query
def unseen_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source, how many closed answers name a category that isn't labelled in their image."""
    names = table(spark, sf_dir, "categories").select(F.col("id").alias("category_id"), "name")
    seen = table(spark, sf_dir, "instances").select("image_id", "category_id").distinct().join(names, "category_id").select("image_id", "name").withColumn("seen", F.lit(1)).distinct()
    image = F.regexp_extract("image_id", r"(\d+)[^0-9]*$", 1).try_cast("long")
    said = _records(spark, sf_dir, "source", image.alias("image_id"), X.format_clean(F.col("hard_label.answer")).alias("name")).join(names.select("name"), "name", "left_semi")
    joined = said.join(seen, ["image_id", "name"], "left")
    return joined.groupBy("source").agg(F.count("*").alias("named"), F.count_if(F.col("seen").isNull()).alias("unseen"))


@_query
def images_of_all_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "vqa_questions").select("image_id")
    labelled = table(spark, sf_dir, "instances").select("image_id")
    known = table(spark, sf_dir, "images").select(F.col("id").alias("image_id"))
    return asked.union(labelled).distinct().intersect(known)


# --- sampling, batches, streams, vectors


@_query
def sample_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sample(table(spark, sf_dir, "images").select("id", "split"), "id", 100)


@_query
def sample_images_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sample_per_group(table(spark, sf_dir, "images").select("id", "split"), "id", "split", 25)


@_query
def sample_images_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.sample_in_proportion(table(spark, sf_dir, "images").select("id", "split"), "id", "split", 100)


@_query
def batch_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each 1000 events in order of their ids."""
    rows = N.numbered(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), ["event_id"])
    batch = F.floor((F.col("number") - 1) / 1000)
    return rows.groupBy(batch.alias("batch")).agg(F.count("*").alias("events"), _r(F.avg("value"), "mean", 4), F.count_if(F.col("event_type") == "click").alias("clicks"))


@_query
def stream_daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = batches.daily_events(spark, sf_dir)
    return rows.select(F.unix_micros("window_start").alias("day_us"), F.col("group").alias("event_type"), "n", _r("total", "total", 3))


@_query
def label_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each vector with the mean vector of its label; dimensions are averaged by a distributed aggregate."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    cells = vectors.select("label", F.posexplode("v")).groupBy("label", "pos").agg(F.avg("col").alias("m"))
    means = cells.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("mean"))  # one value a dimension

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)

    v, m = F.col("v"), F.col("mean")
    return vectors.join(means, "label").select("vec_id", "label", _r(dot(v, m) / F.sqrt(dot(v, v) * dot(m, m)), "cosine", 5))


from lumisift.plans.reference_sql import SQL  # noqa: E402, F401 - the oracles of these queries
