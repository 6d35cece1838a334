"""Queries that reshape records: export, targets, pools, token types, sizes; each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumisift.functions import distributions as D
from lumisift.functions import records as C
from lumisift.functions import text as X
from lumisift.functions.json_text import repair
from lumisift.plans.reference_queries import _dists, _long, _r, _records, _tasks
from lumisift.plans.reference_sql import _DISTS, _RECORDS, _SAMPLES, _clean, _match
from lumisift.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_STEPS = " || ".join(f"case when regexp_matches(coalesce(t.cot_reasoning.structured_reasoning.{s}, ''), '\\S') then [t.cot_reasoning.structured_reasoning.{s}] else [] end" for s in ("observation", "analysis", "conclusion"))
_REASON = rf"coalesce(case when regexp_matches(t.cot_reasoning.reasoning_paragraph, '\S') then t.cot_reasoning.reasoning_paragraph end, nullif(array_to_string({_STEPS}, chr(10)), ''))"


@_query(
    f"""with {_SAMPLES} select sample_id, task, case when t.inference_mode = 'open' or t.question_type = 'open_descriptive' then 'open' else 'closed' end as category,
t.question as question, coalesce(t.hard_label.answer, t.answer) as answer, {_REASON} as reasoning from tasks
where coalesce(t.hard_label.confidence, 1.0) >= 0.3 and coalesce(t.hard_label.answer, t.answer) is not null"""
)
def export_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat training records of the tasks with an answer whose confidence is null or at least 0.3."""
    answer = F.coalesce("t.hard_label.answer", "t.answer")
    kept = _tasks(spark, sf_dir).where((F.coalesce("t.hard_label.confidence", F.lit(1.0)) >= 0.3) & answer.isNotNull())
    is_open = (F.col("t.inference_mode") == "open") | (F.col("t.question_type") == "open_descriptive")
    return kept.select("sample_id", "task", F.when(is_open, "open").otherwise("closed").alias("category"), F.col("t.question").alias("question"), answer.alias("answer"), C.reasoning_text(F.col("t.cot_reasoning")).alias("reasoning"))


@_query(
    f"""with {_RECORDS} select record_id, case when cot_reasoning.reasoning_paragraph is not null then '[Reasoning] ' || cot_reasoning.reasoning_paragraph || chr(10) else '' end || '[Answer] ' || hard_label.answer as target
from records where hard_label.answer is not null"""
)
def target_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir, C.target_text(F.col("cot_reasoning.reasoning_paragraph"), F.col("hard_label.answer")).alias("target"))
    return rows.where("target is not null")


@_query(f"with {_DISTS}, r as (select *, row_number() over (partition by record_id order by v desc, pos) as k from cells) select record_id, token, round(v, 6) as p from r where k <= 2 or v > 0.1 or token = hard")
def likely_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two best tokens, any above 0.1 and the hard label's."""
    ranked = D.ranked(F.col("d"))
    kept = F.filter(F.transform(ranked, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: (e["i"] < 2) | (e["value"] > 0.1) | F.coalesce(e["key"] == F.col("hard"), F.lit(False)))
    return _long(_dists(spark, sf_dir).withColumn("d", kept), "record_id").drop("pos")


@_query(f"with {_DISTS} select record_id, {_match('token')} as token, round(v, 6) as p from cells qualify row_number() over (partition by record_id, {_match('token')} order by pos desc) = 1")
def normalised_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in match form; of keys that become equal the last one stays."""
    rows = _long(_dists(spark, sf_dir), "record_id").withColumn("token", X.match_form(F.col("token")))
    last = rows.groupBy("record_id", "token").agg(F.max(F.struct("pos", "p")).alias("last"))
    return last.select("record_id", "token", "last.p")


@_query(
    f"""with {_SAMPLES}, d as (select sample_id, task, list_filter(map_entries(t.soft_label.answer_distribution), lambda e: e.value > 0) as d from tasks),
c as (select sample_id, task, e.key as token, e.value as v, row_number() over (partition by sample_id, task order by e.value desc, i) as k from (select sample_id, task, unnest(d) as e, unnest(range(len(d))) as i from d)),
f as (select sample_id, task, token, v, dense_rank() over (partition by sample_id order by task) as n from c where k <= 3),
p as (select a.sample_id, a.token || ' ' || b.token as text, a.v * b.v as p from f a join f b on a.sample_id = b.sample_id and a.n = 1 and b.n = 2 where a.v * b.v >= 0.05),
g as (select sample_id, text, sum(p) as p from p group by all)
select sample_id, text, round(p / sum(p) over (partition by sample_id), 6) as p from g"""
)
def joint_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joint distribution of the three best tokens of a sample's first two tasks: products of at least 0.05, summed by text, normalised."""
    rows = _tasks(spark, sf_dir).select("sample_id", "task", D.entries(F.col("t.soft_label.answer_distribution")).alias("d")).where(F.size("d") > 0)
    tasks = rows.select("sample_id", F.struct("task", F.slice(D.ranked(F.col("d")), 1, 3).alias("d")).alias("x")).groupBy("sample_id").agg(F.array_sort(F.collect_list("x")).alias("x"))  # a sample has a handful of tasks
    first, second = F.col("x")[0]["d"], F.get(F.col("x"), F.lit(1))["d"]
    product = F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.struct(F.concat_ws(" ", a["key"], b["key"]).alias("text"), (a["value"] * b["value"]).alias("p")))))
    cells = tasks.where(F.size("x") > 1).select("sample_id", F.explode(F.filter(product, lambda e: e["p"] >= 0.05)).alias("e"))
    merged = cells.groupBy("sample_id", F.col("e.text").alias("text")).agg(F.sum("e.p").alias("p"))
    return merged.select("sample_id", "text", _r(F.col("p") / F.sum("p").over(Window.partitionBy("sample_id")), "p"))


@_query(
    f"""with {_RECORDS}, p as (select record_id, hard_label.answer as answer, list_filter(coalesce(soft_label.candidate_pool, []), lambda x: x is not null) as pool, coalesce(map_keys(soft_label.answer_distribution), []) as keys from records where soft_label is not null)
select record_id, len(pool) as listed, len(list_distinct(pool)) as different, contains(pool, answer) as holds_answer,
  len(list_filter(list_distinct(keys), lambda k: not contains(pool, k))) as outside, len(list_filter(list_distinct(keys), lambda k: contains(pool, k))) as inside from p"""
)
def candidate_pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each pool its size, distinct size, whether it holds the answer, and how many tokens lie outside and inside."""
    none = F.array().cast("array<string>")
    pool, keys = F.coalesce(F.array_compact("soft_label.candidate_pool"), none), F.coalesce(F.map_keys("soft_label.answer_distribution"), none)
    rows = table(spark, sf_dir, "training_records").where("soft_label is not null")
    return rows.select(
        "record_id", F.size(pool).alias("listed"), F.size(F.array_distinct(pool)).alias("different"), F.array_contains(pool, F.col("hard_label.answer")).alias("holds_answer"),
        F.size(F.array_except(keys, pool)).alias("outside"), F.size(F.array_intersect(keys, pool)).alias("inside"),
    ).dropDuplicates(["record_id"])


_TYPES = "types as (select answer as token, category from answer_vocab union select unnest(aliases), category from answer_vocab)"


@_query(
    f"""with {_DISTS}, {_TYPES}, kinds as (select token, list(category) as kinds from types group by token),
j as (select record_id, v, k.kinds as mine, h.kinds as theirs from cells c left join kinds k on c.token = k.token left join kinds h on c.hard = h.token)
select record_id, count(*) as tokens, count(*) filter (where mine is null) as untyped, count(*) filter (where list_has_any(mine, theirs)) as agreeing, round(coalesce(sum(v) filter (where list_has_any(mine, theirs)), 0.0), 6) as kept
from j where theirs is not null group by record_id"""
)
def token_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens, and how much probability, share a type with the hard label; the types are a bounded dimension table."""
    vocabulary = table(spark, sf_dir, "answer_vocab")
    typed = vocabulary.select(F.col("answer").alias("token"), "category").union(vocabulary.select(F.explode("aliases"), "category")).distinct()
    kinds = typed.groupBy("token").agg(F.collect_list("category").alias("mine"))
    cells = _dists(spark, sf_dir).select("record_id", "hard", F.explode("d").alias("e")).select("record_id", "hard", F.col("e.key").alias("token"), F.col("e.value").alias("v"))
    joined = cells.join(kinds, "token", "left").join(kinds.select(F.col("token").alias("hard"), F.col("mine").alias("theirs")), "hard")
    same = F.coalesce(F.arrays_overlap("mine", "theirs"), F.lit(False))
    return joined.groupBy("record_id").agg(F.count("*").alias("tokens"), F.count_if(F.col("mine").isNull()).alias("untyped"), F.count_if(same).alias("agreeing"), _r(F.sum(F.when(same, F.col("v")).otherwise(0.0)), "kept"))


@_query(
    r"""with a as (select distinct lower(trim(hard_label.answer)) as word from training_records where question_category = 'closed')
select word, case when regexp_matches(word, '[^aeiou]ies$') and length(word) > 4 then regexp_replace(word, 'ies$', 'y') when regexp_matches(word, '(s|x|z|ch|sh)es$') then regexp_replace(word, 'es$', '')
  when regexp_matches(word, '[^s]s$') and length(word) > 3 then regexp_replace(word, 's$', '') else word end as singular from a where word is not null"""
)
def singular_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "training_records").where("question_category = 'closed'").select(F.lower(F.trim("hard_label.answer")).alias("word")).distinct()
    return words.where("word is not null").select("word", C.singular(F.col("word")).alias("singular"))


@_query(
    rf"""with {_RECORDS}, n as (select record_id, list_filter(list_transform(regexp_extract_all(cot_reasoning.raw_reasoning, '\b(\d{{1,3}})\b', 1), lambda x: x::int), lambda x: x <= 100) as found from records)
select record_id, found[-1] as score from n where len(found) > 0"""
)
def reply_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last number up to 100 in each reply."""
    return _records(spark, sf_dir, C.last_score(F.col("cot_reasoning.raw_reasoning")).alias("score")).where("score is not null")


@_query(
    """select id, case when width::bigint * height <= 200000 then width::bigint else floor(width * sqrt(200000.0::double / (width::double * height)))::bigint end as new_width,
case when width::bigint * height <= 200000 then height::bigint else floor(height * sqrt(200000.0::double / (width::double * height)))::bigint end as new_height from images where width > 0 and height > 0"""
)
def resized_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    width, height = C.resized(F.col("width"), F.col("height"), 200_000)
    return table(spark, sf_dir, "images").where("width > 0 and height > 0").select("id", width.alias("new_width"), height.alias("new_height"))


@_query(
    """with one as (select distinct image_id, id, category_id, bbox from instances)
select c.name as name, count(*) as boxes, count(*) filter (where bbox is null) as missing, count(*) filter (where bbox[3] <= 0 or bbox[4] <= 0) as degenerate, round(coalesce(sum(case when bbox[3] > 0 and bbox[4] > 0 then bbox[3] * bbox[4] end), 0.0), 4) as total_area
from one left join categories c on one.category_id = c.id group by c.name"""
)
def box_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per category its boxes: how many, missing, without area, and the area of the rest."""
    one = table(spark, sf_dir, "instances").select("image_id", "id", "category_id", "bbox").distinct()
    width, height = F.get("bbox", F.lit(2)), F.get("bbox", F.lit(3))
    named = one.join(table(spark, sf_dir, "categories").select(F.col("id").alias("category_id"), "name"), "category_id", "left")
    area = F.when((width > 0) & (height > 0), width * height)
    return named.groupBy("name").agg(F.count("*").alias("boxes"), F.count_if(F.col("bbox").isNull()).alias("missing"), F.count_if((width <= 0) | (height <= 0)).alias("degenerate"), _r(F.coalesce(F.sum(area), F.lit(0.0)), "total_area", 4))


@_query(
    f"""with {_RECORDS}, m as (select split = 'train' as before, avg(hard_label.confidence) as conf, avg(length(cot_reasoning.reasoning_paragraph)) as chars, count(distinct {_clean("hard_label.answer")}) / count(*) as variety from records group by 1)
select round(b.conf, 6) as confidence_before, round(a.conf, 6) as confidence_after, round(a.conf - b.conf, 6) as confidence_change, round(a.chars - b.chars, 6) as length_change, round(a.variety - b.variety, 6) as variety_change
from m b, m a where b.before and not a.before"""
)
def compare_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the training split against those of the others, as one row."""
    train = F.col("split") == "train"
    rows = _records(spark, sf_dir, train.alias("train"), F.col("hard_label.confidence").alias("conf"), F.length("cot_reasoning.reasoning_paragraph").alias("chars"), X.format_clean(F.col("hard_label.answer")).alias("a"))
    m = rows.groupBy("train").agg(F.avg("conf").alias("conf"), F.avg("chars").alias("chars"), (F.count_distinct("a") / F.count("*")).alias("variety"))
    both = m.agg(*(F.max(F.when(F.col("train") == side, F.col(c))).alias(f"{c}_{side}") for c in ("conf", "chars", "variety") for side in (True, False)))
    change = lambda c, name: _r(F.col(f"{c}_False") - F.col(f"{c}_True"), name)
    return both.select(_r("conf_True", "confidence_before"), _r("conf_False", "confidence_after"), change("conf", "confidence_change"), change("chars", "length_change"), change("variety", "variety_change"))


@_query(
    f"""with {_RECORDS}, n as (select distinct try_cast(hard_label.answer as bigint) as number from records where question_type = 'counting' and regexp_matches(hard_label.answer, '^[0-9]{{1,18}}$')),
c as (select distinct number, (number + d)::varchar as s from n, (select unnest([-100, -10, -2, -1, 0, 1, 2, 10, 100]) as d) where number + d >= 0)
select number, string_agg(s, ',' order by length(s), s) as candidates from c group by number"""
)
def number_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers that a counted answer in digits (as many as a long holds) may be confused with."""
    rows = _records(spark, sf_dir, F.col("hard_label.answer").alias("a"), "question_type").where("question_type = 'counting'").where(F.col("a").rlike(r"^[0-9]{1,18}\z"))
    return rows.select(F.col("a").cast("long").alias("number")).distinct().select("number", F.array_join(C.neighbours(F.col("number")), ",").alias("candidates"))


@_query(
    rf"""with asked as (select distinct question, hard_label.answer as label from training_records where question is not null), n as (select *, case when regexp_matches(label, '^\s*[+-]?[0-9]+\s*$') then try_cast(trim(label) as hugeint) end as number from asked)
select question, label, case when regexp_matches(lower(question), 'how many|count the|number of|total number|quantity of') then 'counting'
  when regexp_matches(lower(question), 'what is the (number|bus number|train number)|bus number|train number|license plate|plate number|phone number|what number|number written|printed number|what (year|date|time)|which (year|date|time)') then 'reading'
  when number between 0 and 20 then 'counting' when number is not null then 'reading' end as task from n"""
)
def number_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a question counts, or reads a number off."""
    asked = table(spark, sf_dir, "training_records").where("question is not null").select("question", F.col("hard_label.answer").alias("label")).distinct()
    return asked.select("question", "label", X.number_task(F.col("question"), F.col("label"))["task"].alias("task"))


_MERGED = "answer"
for _spoken in sorted(X.ENTITIES, key=lambda e: (-len(e), e)):
    _MERGED = f"regexp_replace({_MERGED}, '{_spoken}', '{X.ENTITIES[_spoken]}', 'gi')"


@_query(f"select answer, {_MERGED} as merged from (select distinct hard_label.answer as answer from training_records where question_category = 'closed') where answer is not null and {_MERGED} <> answer")
def merged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = table(spark, sf_dir, "training_records").where("question_category = 'closed'").select(F.col("hard_label.answer").alias("answer")).distinct()
    return answers.select("answer", X.merged_entities(F.col("answer")).alias("merged")).where("merged <> answer")


def repaired_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per producer, how many payloads are objects as they are and how many after repair."""
    one = table(spark, sf_dir, "raw_samples").select("sample_id", "producer", "payload").dropDuplicates(["sample_id"])
    whole = F.try_parse_json("payload").isNotNull() & (F.substring(F.ltrim(F.col("payload")), 1, 1) == "{")
    rows = one.select("producer", F.coalesce(whole, F.lit(False)).alias("whole"), repair("payload").isNotNull().alias("usable"))
    return rows.groupBy("producer").agg(F.count("*").alias("samples"), F.count_if("whole").alias("whole"), F.count_if(F.col("usable")).alias("usable"))


QUERIES["repaired_payloads"] = repaired_payloads
