"""Reports on the quality of labels, reasoning and images, and the tables around them; each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.functions import numbers as U
from lumisift.functions import tokens as K
from lumisift.operators import images as I
from lumisift.operators import numbering as N
from lumisift.operators import reports as R
from lumisift.operators import votes as V
from lumisift.plans.reference_queries import _answers, _r, _records, _tasks
from lumisift.plans.reference_queries import image_scores as _image_scores
from lumisift.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_RECORDS = "records as (select distinct on (record_id) * from training_records)"
_SAMPLES = "samples as (select distinct on (sample_id) * from merged_samples), tasks as (select sample_id, e.key as task, e.value as t from (select sample_id, unnest(map_entries(tasks)) as e from samples))"


def _share(n, of) -> F.Column:
    return F.coalesce(n / F.nullif(of, F.lit(0)), F.lit(0.0))


@_query(
    f"""with {_RECORDS}, c as (select hard_label.confidence as c from records where hard_label.confidence is not null)
select count(*) as n, round(avg(c), 6) as mean, round(quantile_cont(c, 0.5), 6) as median, round(stddev_pop(c), 6) as std, count(*) filter (where c < 0.3) as below_30, count(*) filter (where c >= 0.3 and c < 0.5) as below_50,
  count(*) filter (where c >= 0.5 and c < 0.7) as below_70, count(*) filter (where c >= 0.7 and c < 0.9) as below_90, count(*) filter (where c >= 0.9) as from_90 from c"""
)
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median, deviation and five bins of the labels' confidence."""
    c = F.col("c")
    rows = _records(spark, sf_dir, F.col("hard_label.confidence").alias("c")).where("c is not null")
    bins = {"below_30": c < 0.3, "below_50": (c >= 0.3) & (c < 0.5), "below_70": (c >= 0.5) & (c < 0.7), "below_90": (c >= 0.7) & (c < 0.9), "from_90": c >= 0.9}
    return rows.agg(F.count("*").alias("n"), _r(F.avg(c), "mean"), _r(F.percentile(c, 0.5), "median"), _r(F.stddev_pop(c), "std"), *(F.count_if(held).alias(name) for name, held in bins.items()))


@_query(
    f"""with {_SAMPLES}, s as (select quality_score.final_score as s from samples where quality_score.final_score is not null)
select count(*) as n, round(avg(s), 4) as mean, round(quantile_cont(s, 0.5), 4) as median, round(stddev_pop(s), 4) as std, count(*) filter (where s < 30) as below_30, count(*) filter (where s >= 30 and s < 50) as below_50,
  count(*) filter (where s >= 50 and s < 70) as below_70, count(*) filter (where s >= 70 and s < 90) as below_90, count(*) filter (where s >= 90) as from_90 from s"""
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, median, deviation and five bins of the samples' scores."""
    s = F.col("s")
    rows = table(spark, sf_dir, "merged_samples").select("sample_id", F.col("quality_score.final_score").alias("s")).dropDuplicates(["sample_id"]).where("s is not null")
    bins = {"below_30": s < 30, "below_50": (s >= 30) & (s < 50), "below_70": (s >= 50) & (s < 70), "below_90": (s >= 70) & (s < 90), "from_90": s >= 90}
    return rows.agg(F.count("*").alias("n"), _r(F.avg(s), "mean", 4), _r(F.percentile(s, 0.5), "median", 4), _r(F.stddev_pop(s), "std", 4), *(F.count_if(held).alias(name) for name, held in bins.items()))


@_query(
    f"""with {_SAMPLES}, c as (select t.hard_label.confidence as c from tasks where t.hard_label.confidence is not null)
select count(*) as n, count(*) filter (where c < 0.3) as low, count(*) filter (where c > 0.95) as high, round(count(*) filter (where c < 0.3) / count(*), 4) as low_share, round(count(*) filter (where c > 0.95) / count(*), 4) as high_share,
  count(*) filter (where c < 0.3) / count(*) < 0.2 and count(*) filter (where c > 0.95) / count(*) < 0.1 as passed from c"""
)
def confidence_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tasks are labelled with very low or very high confidence, and whether that is within bounds."""
    rows = _tasks(spark, sf_dir).select(F.col("t.hard_label.confidence").alias("c")).where("c is not null")
    m = rows.agg(F.count("*").alias("n"), F.count_if(F.col("c") < 0.3).alias("low"), F.count_if(F.col("c") > 0.95).alias("high"))
    low, high = _share(F.col("low"), F.col("n")), _share(F.col("high"), F.col("n"))
    return m.select("n", "low", "high", _r(low, "low_share", 4), _r(high, "high_share", 4), ((low < 0.2) & (high < 0.1)).alias("passed"))


_INVALID = "('unknown', 'n/a', 'none', 'null', 'nothing', 'i don''t know', 'cannot determine', 'unclear', 'no answer', 'not sure', '')"
#: Answers that say nothing.
INVALID = ("unknown", "n/a", "none", "null", "nothing", "i don't know", "cannot determine", "unclear", "no answer", "not sure", "")


@_query(
    f"""with {_SAMPLES}, a as (select t.hard_label.answer as a from tasks where t.hard_label.answer <> '')
select count(*) as n, count(*) filter (where lower(trim(a)) in {_INVALID}) as invalid, count(*) filter (where length(a) < 3) as short, count(*) filter (where length(a) > 100) as long,
  count(*) filter (where lower(trim(a)) in {_INVALID}) / count(*) < 0.05 and count(*) filter (where length(a) < 3) / count(*) < 0.1 as passed from a"""
)
def answer_reasonability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many answers say nothing, are short or long, and whether that is within bounds."""
    a = F.col("a")
    rows = _tasks(spark, sf_dir).select(F.col("t.hard_label.answer").alias("a")).where("a <> ''")
    m = rows.agg(F.count("*").alias("n"), F.count_if(F.lower(F.trim(a)).isin(*INVALID)).alias("invalid"), F.count_if(F.length(a) < 3).alias("short"), F.count_if(F.length(a) > 100).alias("long"))
    return m.withColumn("passed", (_share(F.col("invalid"), F.col("n")) < 0.05) & (_share(F.col("short"), F.col("n")) < 0.1))


@_query(
    f"""with {_SAMPLES}, m as (select task, avg(t.hard_label.confidence) as mean from tasks group by task having avg(t.hard_label.confidence) is not null)
select count(*) as tasks, round(max(mean) - min(mean), 4) as spread, max(mean) - min(mean) < 0.2 as passed from m"""
)
def task_confidence_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the tasks' mean confidences lie apart."""
    m = _tasks(spark, sf_dir).groupBy("task").agg(F.avg("t.hard_label.confidence").alias("mean")).where("mean is not null")
    spread = F.max("mean") - F.min("mean")
    return m.agg(F.count("*").alias("tasks"), _r(spread, "spread", 4), (spread < 0.2).alias("passed"))


@_query(
    f"""with {_RECORDS}, a as (select lower(trim(hard_label.answer)) as a, count(*) as n from records where trim(hard_label.answer) <> '' group by 1)
select sum(n)::bigint as n, count(*) as distinct_answers, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) as entropy, round(max(n) / sum(n), 6) as top_share, round(coalesce(sum(n) filter (where a in ('yes', 'no')), 0) / sum(n), 6) as yes_no_share,
  log2(sum(n)) - sum(n * log2(n)) / sum(n) >= 3 and max(n) / sum(n) < 0.3 as passed from a"""
)
def answer_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy of the answers, the share of the most frequent one and of yes and no, and whether they are varied enough."""
    rows = _records(spark, sf_dir, F.lower(F.trim("hard_label.answer")).alias("a")).where("a <> ''")
    c = R.concentration(rows, F.col("a")).select("n", F.col("distinct_values").alias("distinct_answers"), "entropy", "top_share")
    yes_no = rows.agg((F.count_if(F.col("a").isin("yes", "no")) / F.count("*")).alias("yes_no_share"))
    both = c.join(F.broadcast(yes_no))  # one row each
    return both.select("n", "distinct_answers", _r("entropy", "entropy"), _r("top_share", "top_share"), _r("yes_no_share", "yes_no_share"), ((F.col("entropy") >= 3) & (F.col("top_share") < 0.3)).alias("passed"))


@_query(
    f"""with {_SAMPLES}, c as (select t.cot_reasoning as c from tasks), f as (select coalesce(c.raw_reasoning, '') = '' as empty, coalesce(c.quality_metrics.logical_flow_score, 0.0) as flow from c)
select count(*) as n, count(*) filter (where empty) as empty, round(avg(flow) filter (where not empty), 4) as mean_flow, count(*) filter (where not empty and flow < 0.5) as low_flow, coalesce(avg(flow) filter (where not empty), 1.0) >= 0.5 and count(*) filter (where empty) / count(*) < 0.2 as passed from f"""
)
def logical_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tasks lack reasoning, and how coherent the rest is."""
    rows = _tasks(spark, sf_dir).select((F.coalesce("t.cot_reasoning.raw_reasoning", F.lit("")) == "").alias("empty"), F.coalesce("t.cot_reasoning.quality_metrics.logical_flow_score", F.lit(0.0)).alias("flow"))
    flow = F.when(~F.col("empty"), F.col("flow"))
    m = rows.agg(F.count("*").alias("n"), F.count_if("empty").alias("empty"), F.avg(flow).alias("mean"), F.count_if(flow < 0.5).alias("low_flow"))
    return m.select("n", "empty", _r("mean", "mean_flow", 4), "low_flow", ((F.coalesce("mean", F.lit(1.0)) >= 0.5) & (_share(F.col("empty"), F.col("n")) < 0.2)).alias("passed"))


@_query(
    f"""with {_SAMPLES}, s as (select coalesce(t.cot_reasoning.quality_metrics.step_count, 0) as s from tasks where t.cot_reasoning is not null)
select count(*) as n, round(avg(s) filter (where s > 0), 2) as mean, min(s) filter (where s > 0) as least, max(s) as greatest, count(*) filter (where s < 2) as few, count(*) filter (where s < 2) / count(*) < 0.3 as passed from s"""
)
def step_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many steps the reasoning of a task has."""
    s = F.col("s")
    rows = _tasks(spark, sf_dir).where("t.cot_reasoning is not null").select(F.coalesce("t.cot_reasoning.quality_metrics.step_count", F.lit(0)).alias("s"))
    m = rows.agg(F.count("*").alias("n"), _r(F.avg(F.when(s > 0, s)), "mean", 2), F.min(F.when(s > 0, s)).alias("least"), F.max(s).alias("greatest"), F.count_if(s < 2).alias("few"))
    return m.withColumn("passed", _share(F.col("few"), F.col("n")) < 0.3)


#: Words that show the steps of a reasoning.
STEP_WORDS = ("first", "next", "then", "finally", "therefore", "because", "so")


@_query(
    f"""with {_SAMPLES}, r as (select lower(t.cot_reasoning.raw_reasoning) as r from tasks where t.cot_reasoning.raw_reasoning <> ''),
k as (select unnest(['first', 'next', 'then', 'finally', 'therefore', 'because', 'so']) as word), n as (select count(*) as n from r)
select word, count(*) filter (where contains(r, word)) as texts, round(count(*) filter (where contains(r, word)) / any_value(n), 4) as share from r, k, n group by word"""
)
def keyword_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many reasonings each word of its steps occurs."""
    rows = _tasks(spark, sf_dir).select(F.lower("t.cot_reasoning.raw_reasoning").alias("r")).where("r <> ''")
    counts = rows.agg(F.count("*").alias("n"), F.map_from_arrays(F.array(*map(F.lit, STEP_WORDS)), F.array(*(F.count_if(F.contains("r", F.lit(w))) for w in STEP_WORDS))).alias("held"))
    return counts.select("n", F.explode("held").alias("word", "texts")).select("word", "texts", _r(_share(F.col("texts"), F.col("n")), "share", 4))


@_query(
    f"""with {_SAMPLES}, q as (select sample_id, task, t.cot_reasoning.quality_metrics as q from tasks where t.cot_reasoning is not null),
r as (select 1.0 - (coalesce(q.logical_flow_score, 0.0) * 0.4 + least(coalesce(q.keyword_count, 0) / 4.0, 1.0) * 0.3 + least(coalesce(q.step_count, 0) / 5.0, 1.0) * 0.3) as risk from q)
select count(*) as n, round(avg(risk), 4) as mean, count(*) filter (where risk > 0.5) as high, count(*) filter (where risk > 0.5) / count(*) < 0.1 as passed from r"""
)
def reasoning_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk that a reasoning is made up, by its coherence, its step words and its steps."""
    q = "t.cot_reasoning.quality_metrics."
    part = lambda name, most: F.least(F.coalesce(q + name, F.lit(0)) / most, F.lit(1.0))
    risk = 1.0 - (F.coalesce(q + "logical_flow_score", F.lit(0.0)) * 0.4 + part("keyword_count", 4.0) * 0.3 + part("step_count", 5.0) * 0.3)
    rows = _tasks(spark, sf_dir).where("t.cot_reasoning is not null").select(risk.alias("risk"))
    m = rows.agg(F.count("*").alias("n"), _r(F.avg("risk"), "mean", 4), F.count_if(F.col("risk") > 0.5).alias("high"))
    return m.withColumn("passed", _share(F.col("high"), F.col("n")) < 0.1)


@_query(
    """with e as (select *, row_number() over (order by event_id) - 1 as i from events)
select i // 1000 as batch, count(*) as samples, round(avg(value), 6) as mean_rate, count(*) filter (where event_type = 'click') as retained, round(count(*) filter (where event_type = 'click') / count(*), 6) as retained_share,
  epoch_us(min(ts)) as first_us, epoch_us(max(ts)) as last_us, count(*) filter (where event_type = 'click') / count(*) < 0.2 as alert from e group by 1"""
)
def batch_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates and time span of each thousand samples, and an alert where too few are retained."""
    rows = N.numbered(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), ["event_id"])
    click = F.col("event_type") == "click"
    m = rows.groupBy(F.floor((F.col("number") - 1) / 1000).alias("batch")).agg(F.count("*").alias("samples"), _r(F.avg("value"), "mean_rate"), F.count_if(click).alias("retained"), F.unix_micros(F.min(F.col("ts").cast("timestamp"))).alias("first_us"), F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("last_us"))
    share = F.col("retained") / F.col("samples")
    return m.withColumn("retained_share", F.round(share, 6)).withColumn("alert", share < 0.2)


@_query(
    """with t as (select quality_score.bucket as bucket, metadata.total_time as s from (select distinct on (sample_id) * from merged_samples) where metadata.total_time > 0), r as (select *, row_number() over (partition by bucket order by s) - 1 as i, count(*) over (partition by bucket) as n from t)
select bucket, any_value(n) as samples, round(avg(s), 4) as mean, round(max(s) filter (where i = n // 2), 4) as upper_median, round(any_value(n) / sum(s), 6) as throughput from r group by bucket"""
)
def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds a sample took: mean, upper median and samples a second, by bucket."""
    rows = table(spark, sf_dir, "merged_samples").select("sample_id", F.col("quality_score.bucket").alias("bucket"), F.col("metadata.total_time").alias("s")).dropDuplicates(["sample_id"]).where("s > 0")
    upper = F.expr("-percentile_disc(0.5) within group (order by -s)")  # of an even number the greater of the middle two
    return rows.groupBy("bucket").agg(F.count("*").alias("samples"), _r(F.avg("s"), "mean", 4), _r(upper, "upper_median", 4), _r(F.count("*") / F.sum("s"), "throughput"))


@_query(
    f"""with {_RECORDS}, n as (select source, length(cot_reasoning.reasoning_paragraph) as n from records where cot_reasoning.reasoning_paragraph is not null) select source, count(*) as texts, round(quantile_cont(n, 0.25), 4) as q25, round(quantile_cont(n, 0.5), 4) as median, round(quantile_cont(n, 0.75), 4) as q75 from n group by source"""
)
def length_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interpolated percentiles of the reasonings' lengths by source."""
    rows = _records(spark, sf_dir, "source", F.length("cot_reasoning.reasoning_paragraph").alias("n")).where("n is not null")
    p = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))  # counts of distinct lengths
    return rows.groupBy("source").agg(F.count("*").alias("texts"), p.alias("p")).select("source", "texts", *(_r(F.col("p")[i], name, 4) for i, name in enumerate(("q25", "median", "q75"))))


from lumisift.plans.reference_sql import _SCORES  # noqa: E402


@_query(
    f"""with {_SCORES} select count(*) as images, count(*) filter (where score >= 0.7) as kept, round(count(*) filter (where score >= 0.7) / count(*), 6) as retention, round(avg(score), 6) as mean, round(stddev_pop(score), 6) as std, round(min(score), 6) as least, round(max(score), 6) as greatest,
  round(quantile_cont(score, 0.25), 6) as q25, round(quantile_cont(score, 0.5), 6) as median, round(quantile_cont(score, 0.75), 6) as q75, round(avg(category_score), 6) as category_mean, round(avg(text_score), 6) as text_mean, round(avg(scene_score), 6) as scene_mean from scored"""
)
def image_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of the images' scores and how many of them are kept."""
    s = F.col("score")
    m = _image_scores(spark, sf_dir).agg(
        F.count("*").alias("images"), F.count_if(s >= 0.7).alias("kept"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("least"), F.max(s).alias("greatest"),
        F.percentile(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("p"), *(F.avg(f"{c}_score").alias(f"{c}_mean") for c in ("category", "text", "scene")),
    )
    return m.select("images", "kept", _r(F.col("kept") / F.col("images"), "retention"), *(_r(c, c) for c in ("mean", "std", "least", "greatest")), *(_r(F.col("p")[i], name) for i, name in enumerate(("q25", "median", "q75"))), *(_r(f"{c}_mean", f"{c}_mean") for c in ("category", "text", "scene")))


@_query(f"with {_SCORES}, kept as (select image_id from scored where score >= 0.7) select c.name as name, count(*) as objects, count(distinct image_id) as images from one join categories c on one.category_id = c.id where image_id in (select image_id from kept) group by c.name")
def kept_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each category is labelled in the images that are kept."""
    kept = _image_scores(spark, sf_dir).where("score >= 0.7").select("image_id")
    one = table(spark, sf_dir, "instances").select("image_id", "id", "category_id").distinct().join(kept, "image_id", "left_semi")
    named = one.join(table(spark, sf_dir, "categories").select(F.col("id").alias("category_id"), "name"), "category_id")
    return named.groupBy("name").agg(F.count("*").alias("objects"), F.count_distinct("image_id").alias("images"))


@_query(
    r"""with q as (select distinct question_id, question from vqa_questions), m as (select coalesce(regexp_matches(lower(question), '\b(?:road|traffic|car|driver|lane|street|crosswalk)s?\b') and not regexp_matches(lower(question), '\b(?:toy|painting|indoor)s?\b'), false) as hit from q)
select count(*) as calls, count(*) filter (where hit) as hits, round(count(*) filter (where hit) / count(*), 6) as hit_rate from m"""
)
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many questions the keywords match."""
    rows = table(spark, sf_dir, "vqa_questions").select("question_id", "question").distinct().select(F.coalesce(I.keyword_match(F.col("question")), F.lit(False)).alias("hit"))
    return rows.agg(F.count("*").alias("calls"), F.count_if("hit").alias("hits"), _r(F.count_if("hit") / F.count("*"), "hit_rate"))


@_query(
    f"""with {_SAMPLES} select count(*) as samples, count(*) filter (where image_id is null or trim(image_id) = '') as no_image, count(*) filter (where tasks is null or cardinality(tasks) = 0) as no_tasks, count(*) filter (where metadata is null) as no_metadata, count(*) filter (where quality_score.is_valid is null) as not_judged,
  (select count(*) from tasks where coalesce(t.question, '') = '') as no_question, (select count(*) from tasks where t.hard_label is null) as no_label, (select count(*) from tasks where t.hard_label.confidence < 0 or t.hard_label.confidence > 1) as bad_confidence from samples"""
)
def sample_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What samples and tasks lack."""
    one = table(spark, sf_dir, "merged_samples").dropDuplicates(["sample_id"])
    tasks = F.coalesce(F.map_values("tasks"), F.array().cast("array<" + table(spark, sf_dir, "merged_samples").schema["tasks"].dataType.valueType.simpleString() + ">"))
    lacking = lambda f: F.sum(F.size(F.filter(tasks, f))).cast("long")
    c = lambda t: t["hard_label"]["confidence"]
    return one.agg(
        F.count("*").alias("samples"), F.count_if(F.col("image_id").isNull() | (F.trim("image_id") == "")).alias("no_image"), F.count_if(F.col("tasks").isNull() | (F.size("tasks") == 0)).alias("no_tasks"), F.count_if(F.col("metadata").isNull()).alias("no_metadata"),
        F.count_if(F.col("quality_score.is_valid").isNull()).alias("not_judged"), lacking(lambda t: F.coalesce(t["question"], F.lit("")) == "").alias("no_question"), lacking(lambda t: t["hard_label"].isNull()).alias("no_label"), lacking(lambda t: F.coalesce((c(t) < 0) | (c(t) > 1), F.lit(False))).alias("bad_confidence"),
    )


@_query(f"with {_SAMPLES}, i as (select distinct image_id from samples where image_id is not null) select (select count(*) from samples) as samples, (select count(*) from i) as images, (select string_agg(image_id, ',' order by image_id) from (select image_id from i order by image_id limit 100)) as first_ids")
def sample_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many samples and images there are, and the first hundred ids of images."""
    one = table(spark, sf_dir, "merged_samples").select("sample_id", "image_id").dropDuplicates(["sample_id"])
    first = one.where("image_id is not null").select("image_id").distinct().orderBy("image_id").limit(100)
    ids = first.agg(F.array_join(F.array_sort(F.collect_list("image_id")), ",").alias("first_ids"))
    return one.agg(F.count("*").alias("samples"), F.count_distinct("image_id").alias("images")).join(F.broadcast(ids))  # one row each


from lumisift.plans.reference_sql import _VOTE  # noqa: E402


@_query(f"with {_VOTE}, k as (select image_id || '||' || trim(question) as key, answer from (select distinct * from vqa_questions) join voted using (question_id) where question is not null) select key, key[:strpos(key, '||') - 1]::bigint as image_id, key[strpos(key, '||') + 2:] as question, count(*) as answers from k group by key")
def truth_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth by the key image and question, and the key taken apart at its first separator."""
    asked = table(spark, sf_dir, "vqa_questions").distinct().where("question is not null")
    voted = V.vote(table(spark, sf_dir, "vqa_annotations"))
    keyed = asked.join(voted, "question_id").select(F.concat_ws("||", F.col("image_id").cast("string"), F.trim("question")).alias("key"))
    parts = F.split("key", r"\|\|", 2)
    return keyed.groupBy("key").agg(F.count("*").alias("answers")).select("key", F.get(parts, F.lit(0)).cast("long").alias("image_id"), F.get(parts, F.lit(1)).alias("question"), "answers")


@_query(f"with {_VOTE}, s as (select question_id, count(*) as k, round(sum(n), 0) as n from votes group by 1) select v.question_id, v.answer, round(v.n / s.n, 3) as share from votes v join s using (question_id)")
def vote_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of the votes of each valid answer."""
    voted = V.vote(table(spark, sf_dir, "vqa_annotations"))
    return voted.select("question_id", F.explode("dist").alias("answer", "share")).select("question_id", "answer", _r("share", "share", 3))


_KIND = "case when regexp_matches(a, '^[0-9]+$') then 'number' when a in ('yes', 'no') then 'yesno' when a in ('red', 'green', 'blue', 'yellow', 'orange', 'purple', 'pink', 'brown', 'black', 'white', 'gray', 'grey', 'cyan', 'magenta', 'turquoise', 'azure', 'silver', 'golden', 'bronze', 'maroon', 'navy', 'teal', 'olive', 'lime') then 'color' else 'object' end"


def _kind(a) -> F.Column:
    return F.when(a.rlike(r"^[0-9]+\z"), "number").when(a.isin(*K.WHITELISTS["binary"]), "yesno").when(a.isin(*K.WHITELISTS["color"]), "color").otherwise("object")


_POOL = f"given as (select lower(trim(a.answer)) as a from (select unnest(answers) as a from (select distinct on (question_id) question_id, answers from vqa_annotations))), pool as (select {_KIND} as category, a as answer, count(*) as freq from given where a <> '' group by all having count(*) >= 2 or {_KIND} <> 'object')"


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.weighted_answers(table(spark, sf_dir, "vqa_annotations"))
    kind = _kind(F.col("answer"))
    return rows.select(kind.alias("category"), "answer", F.col("given").alias("freq")).where("freq >= 2 or category <> 'object'")


@_query(f"with {_POOL} select category, answer, freq from pool")
def answer_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All given answers by category, rare objects left out."""
    return _pool(spark, sf_dir)


@_query(f"with {_POOL} select case category when 'number' then 'count' when 'yesno' then 'binary' else category end as scene, answer, row_number() over (partition by category order by freq desc, answer) as rank, freq as weight from pool where category <> 'object' union all select 'other', answer, row_number() over (order by freq desc, answer), freq from (select * from pool where category = 'object' order by freq desc, answer limit 50)")
def scene_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates of each kind of question: all of the closed kinds, the fifty most frequent objects for other questions."""
    name = F.when(F.col("category") == "number", "count").when(F.col("category") == "yesno", "binary").when(F.col("category") == "object", "other").otherwise(F.col("category"))
    ranked = _pool(spark, sf_dir).withColumn("rank", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("freq"), "answer")))
    return ranked.where("rank <= 50 or category <> 'object'").select(name.alias("scene"), "answer", "rank", F.col("freq").alias("weight"))


@_query(
    f"""with {_RECORDS}, {_POOL}, best as (select case category when 'number' then 'count' when 'yesno' then 'binary' when 'object' then 'other' else category end as kind, list(answer order by freq desc, answer)[:20] as listed from pool group by 1),
q as (select record_id, lower(trim(soft_label.primary_answer)) as best, case when regexp_matches(lower(question), 'how many|how much|count|number|quantity|多少|几个|数量') then 'count' when regexp_matches(lower(question), 'what color|color is|what colour|colour is|颜色|色彩') then 'color' when regexp_matches(lower(question), 'is there|are there|is it|are they|does|do you|can you|could you|是否|有没有') then 'binary' else 'other' end as kind from records where question is not null)
select record_id, kind, array_to_string((case when coalesce(q.best, '') = '' or list_contains(listed, q.best) then listed else list_prepend(q.best, listed) end)[:20], '|') as candidates from q join best using (kind)"""
)
def question_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to twenty candidates for each question by its kind, its most likely answer among them; the listed ones are a bounded table."""
    name = F.when(F.col("category") == "number", "count").when(F.col("category") == "yesno", "binary").when(F.col("category") == "object", "other").otherwise(F.col("category"))
    ranked = _pool(spark, sf_dir).withColumn("rank", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("freq"), "answer"))).where("rank <= 20")
    listed = ranked.groupBy(name.alias("kind")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "answer"))), lambda x: x["answer"]).alias("listed"))  # at most twenty a kind
    best = F.lower(F.trim("soft_label.primary_answer"))
    rows = _records(spark, sf_dir, K.answer_type(F.col("question")).alias("kind"), F.col("question").isNotNull().alias("held"), best.alias("best")).where("held")
    joined = rows.join(F.broadcast(listed), "kind")
    full = F.when((F.coalesce("best", F.lit("")) == "") | F.array_contains("listed", F.col("best")), F.col("listed")).otherwise(F.concat(F.array("best"), "listed"))
    return joined.select("record_id", "kind", F.array_join(F.slice(full, 1, 20), "|").alias("candidates"))


def reading_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the number in each answer may be confused with, and its word; without an oracle (permutations), tested against a plain version."""
    rows = _answers(spark, sf_dir)
    return rows.select("answer", F.array_join(U.candidates(F.col("answer")), "|").alias("candidates"), U.spoken(F.col("answer")).alias("word"))


QUERIES["reading_candidates"] = reading_candidates
