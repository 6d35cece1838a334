"""Queries that pick, check and count samples and answers for further use; each with its oracle, whose word lists are written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.functions import answers as A
from lumisift.functions import curation as Q
from lumisift.functions import distributions as D
from lumisift.plans.reference_queries import _answers, _dists, _r, _records, _tasks
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
_ANSWERS = "answers as (select distinct hard_label.answer as answer from training_records where question_category = 'closed' and hard_label.answer is not null)"
_SAMPLES = "samples as (select distinct on (sample_id) * from merged_samples), tasks as (select sample_id, e.key as task, e.value as t from (select sample_id, unnest(map_entries(tasks)) as e from samples))"
_DISTS = f"{_RECORDS}, d as (select record_id, hard_label.answer as hard, soft_label.primary_answer as best, list_filter(map_entries(soft_label.answer_distribution), lambda e: e.value > 0) as d from records), cells as (select record_id, hard, best, i - 1 as pos, d[i].key as token, d[i].value as v from (select record_id, hard, best, d, unnest(range(1, len(d) + 1)) as i from d where len(d) > 0))"


@_query(
    f"""with {_SAMPLES} select sample_id, task, round(t.hard_label.confidence, 6) as confidence from tasks where t.hard_label.confidence >= 0.7 and t.cot_reasoning.structured_reasoning is not null and cardinality(t.soft_label.answer_distribution) >= 2
order by t.hard_label.confidence desc, sample_id, task limit 10"""
)
def example_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most confident tasks with structured reasoning and at least two candidates, as examples for a prompt."""
    good = "t.hard_label.confidence >= 0.7 and t.cot_reasoning.structured_reasoning is not null and size(t.soft_label.answer_distribution) >= 2"
    rows = _tasks(spark, sf_dir).where(good).select("sample_id", "task", F.col("t.hard_label.confidence").alias("c"))
    return rows.orderBy(F.desc("c"), "sample_id", "task").limit(10).select("sample_id", "task", _r("c", "confidence"))


@_query(
    f"""with {_ANSWERS}, t as (select answer, string_split(lower(answer), ' ') as w from answers)
select answer, contains(lower(answer), ' and ') and len(list_distinct(list_filter(w, lambda x: x in ('red', 'green', 'blue', 'yellow', 'orange', 'purple', 'pink', 'brown', 'black', 'white', 'gray', 'grey', 'cyan', 'magenta')))) >= 2 as color_pair,
  len(list_filter(w, lambda x: x in ('indoor', 'kitchen', 'toy', 'room', 'beach'))) > 0 as blacklisted from t"""
)
def answer_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that combine colours, and those with a word of a list."""
    a = F.col("answer")
    return _answers(spark, sf_dir).select("answer", Q.is_color_pair(a).alias("color_pair"), Q.has_word(a, ("indoor", "kitchen", "toy", "room", "beach")).alias("blacklisted"))


@_query(
    f"""with {_RECORDS}, t as (select record_id, lower(cot_reasoning.reasoning_paragraph) as r, cot_reasoning.reasoning_paragraph as p from records where cot_reasoning.reasoning_paragraph is not null),
w as (select record_id, p, len(list_filter(['appear', 'seem', 'seems', 'appeared', 'seemed', 'probably', 'likely', 'possibly', 'perhaps', 'maybe', 'suggest', 'suggests', 'suggested', 'suggesting', 'might', 'could be', 'may be', 'would be', 'unclear', 'uncertain', 'ambiguous'], lambda x: contains(r, x))) as speculative, len(regexp_extract_all(p, '[\\p{{L}}\\p{{N}}_]+')) as words from t)
select record_id, speculative, words, words > 350 as long, words < 15 as short from w"""
)
def reasoning_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that only guess in each reasoning, and whether it is too long or too short."""
    text = F.col("cot_reasoning.reasoning_paragraph")
    words = A.count_words(text)
    return _records(spark, sf_dir, Q.speculative(text).alias("speculative"), words.alias("words"), (words > 350).alias("long"), (words < 15).alias("short")).where("words is not null")


@_query(
    rf"""with {_RECORDS}, t as (select record_id, cot_reasoning.reasoning_paragraph as p from records where cot_reasoning.reasoning_paragraph is not null)
select record_id, trim(regexp_replace(regexp_replace(p, '(?i)clearly visible|fully visible|barely visible|partially visible|overall scene|general view|surrounding area|bright light|natural light', '', 'g'), '\s+', ' ', 'g')) as trimmed from t where regexp_matches(p, '(?i)clearly visible|fully visible|barely visible|partially visible|overall scene|general view|surrounding area|bright light|natural light')"""
)
def trimmed_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasonings without phrases that say nothing about the answer, where there are any."""
    phrases = ("clearly visible", "fully visible", "barely visible", "partially visible", "overall scene", "general view", "surrounding area", "bright light", "natural light")
    text = F.col("cot_reasoning.reasoning_paragraph")
    return _records(spark, sf_dir, F.when(text.rlike("(?i)" + "|".join(phrases)), Q.without_phrases(text, phrases)).alias("trimmed")).where("trimmed is not null")


@_query(
    f"""with {_DISTS}, g as (select record_id, any_value(hard) as hard, any_value(best) as best, count(*) as n, max(v) as top, coalesce(max(v) filter (where token = hard), 0.0) as truth from cells group by record_id),
c as (select *, length(best) > 10 and len(list_filter(range(3, greatest(4, length(best) // 2)), lambda k: k < length(best) // 2 and contains(best, repeat(best[:k], 4)))) > 0 as repeats from g)
select record_id, case when coalesce(repeats, false) then 'repeats' when top > 0.9 and n < 3 then 'certain' when truth = 0 and top > 0.9 then 'lost' end as reason, n < 3 as few from c"""
)
def label_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a distribution can't be trusted: its answer repeats itself, one of few candidates has almost everything, or the label has nothing."""
    d = F.col("d")
    rows = _records(spark, sf_dir, F.col("hard_label.answer").alias("hard"), F.col("soft_label.primary_answer").alias("best"), D.entries(F.col("soft_label.answer_distribution")).alias("d")).where(F.size("d") > 0)
    top = F.array_max(F.transform(d, lambda e: e["value"]))
    return rows.select("record_id", Q.guard(F.col("best"), F.size(d), top, D.probability(d, F.col("hard"))).alias("reason"), (F.size(d) < 3).alias("few"))


@_query(
    f"""with {_DISTS}, w as (select record_id, token, v, len(list_filter(string_split(trim(token), ' '), lambda x: x <> '')) as k from cells)
select record_id, token, round(greatest(ln(v) * greatest(k, 1), -10.0), 6) as log_joint from w"""
)
def joint_log_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logarithm of each candidate's probability taken once for each of its words, not below -10."""
    rows = _dists(spark, sf_dir).select("record_id", F.explode("d").alias("e"))
    words = F.size(F.filter(F.split(F.trim("e.key"), " "), lambda w: w != ""))
    return rows.select("record_id", F.col("e.key").alias("token"), _r(F.greatest(F.ln("e.value") * F.greatest(words, F.lit(1)), F.lit(-10.0)), "log_joint"))


@_query(
    f"""with {_SAMPLES} select task, count(*) as tasks, count(*) filter (where t.soft_label.answer_distribution is not null and t.soft_label.primary_answer is not null) as complete, sum(coalesce(cardinality(t.soft_label.answer_distribution), 0))::bigint as tokens,
round(avg(t.soft_label.kl_weight), 6) as mean_weight from tasks group by task"""
)
def soft_label_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By task how many distributions there are, with all that is needed, and of how many tokens."""
    dist = F.col("t.soft_label.answer_distribution")
    size = F.when(dist.isNotNull(), F.size(dist)).otherwise(0)
    return _tasks(spark, sf_dir).groupBy("task").agg(F.count("*").alias("tasks"), F.count_if(dist.isNotNull() & F.col("t.soft_label.primary_answer").isNotNull()).alias("complete"), F.sum(size).alias("tokens"), _r(F.avg("t.soft_label.kl_weight"), "mean_weight"))


@_query(
    """with s as (select distinct on (sample_id) * from merged_samples) select metadata.teacher_model as model, count(*) as samples, round(avg(metadata.total_time), 4) as mean_time, round(sum(metadata.total_time), 2) as time, sum(coalesce(cardinality(tasks), 0))::bigint as tasks from s group by 1"""
)
def generation_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By model how many samples and tasks it made and how long that took."""
    one = table(spark, sf_dir, "merged_samples").select("sample_id", "metadata", F.when(F.col("tasks").isNotNull(), F.size("tasks")).otherwise(0).alias("k")).dropDuplicates(["sample_id"])
    return one.groupBy(F.col("metadata.teacher_model").alias("model")).agg(F.count("*").alias("samples"), _r(F.avg("metadata.total_time"), "mean_time", 4), _r(F.sum("metadata.total_time"), "time", 2), F.sum("k").alias("tasks"))


@_query("select event_type, count(*) as events, count(try_cast(json_extract_string(props, '$.k') as bigint)) as held, sum(try_cast(json_extract_string(props, '$.k') as bigint))::bigint as total from events group by event_type")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value at a path of JSON texts."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("*").alias("events"), F.count("k").alias("held"), F.sum("k").alias("total"))


@_query("select split, count(*) as images, round(avg((epoch_us(received_at) - epoch_us(captured_at)) / 1000000.0), 3) as mean_delay_s, max(epoch_us(received_at) - epoch_us(captured_at)) // 86400000000 as most_days from images where captured_at is not null and received_at is not null group by split")
def arrival_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long images took to arrive."""
    us = F.unix_micros(F.col("received_at").cast("timestamp")) - F.unix_micros(F.col("captured_at").cast("timestamp"))
    rows = table(spark, sf_dir, "images").where("captured_at is not null and received_at is not null").select("split", us.alias("us"))
    return rows.groupBy("split").agg(F.count("*").alias("images"), _r(F.avg(F.col("us") / 1_000_000), "mean_delay_s", 3), F.floor(F.max("us") / 86_400_000_000).alias("most_days"))


@_query(
    f"""with {_RECORDS}, k as (select record_id, question_type, question_category, case question_type when 'choice' then 'closed_choice' when 'yes_no' then 'closed_yesno' when 'binary' then 'closed_yesno' when 'counting' then 'closed_enumerate' when 'count' then 'closed_enumerate' when 'color' then 'closed_enumerate' else 'open_type' end as major from records)
select major, count(*) as records, count(*) filter (where question_category = 'open') as marked_open from k group by major"""
)
def major_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by the major category of their question's type."""
    rows = _records(spark, sf_dir, Q.major(F.col("question_type")).alias("major"), (F.col("question_category") == "open").alias("o"))
    return rows.groupBy("major").agg(F.count("*").alias("records"), F.count_if("o").alias("marked_open"))


@_query(
    f"""with {_RECORDS}, b as (select question_type as bucket, record_id, row_number() over (partition by question_type order by record_id) as k from records) select bucket, record_id, k from b where k <= 5"""
)
def bucket_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five records of each question type, as details of a report."""
    rows = _records(spark, sf_dir, F.col("question_type").alias("bucket"))
    return rows.withColumn("k", F.row_number().over(Window.partitionBy("bucket").orderBy("record_id"))).where("k <= 5")  # only the first ranks are shuffled
