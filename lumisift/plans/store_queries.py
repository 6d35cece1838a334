"""Queries on what is stored of samples and records; each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.plans.reference_queries import image_scores
from lumisift.plans.reference_sql import _SCORES
from lumisift.runtime import table
from lumisift.sources import stores as S

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


_RECORDS = "records as (select distinct on (record_id) * from training_records)"


@_query(
    f"""with {_RECORDS}, t as (select record_id, image_path, question, coalesce(hard_label.answer, cot_reasoning.answer) as short_answer, cot_reasoning.reasoning_paragraph as r, soft_label.answer_distribution as d, question_category as c from records where question <> '' and image_path <> '')
select record_id, image_path, question, case when r is not null then '[Reasoning] ' || r || chr(10) else '' end || '[Answer] ' || short_answer as target, short_answer, d is not null as is_closed, coalesce(c = 'open', false) as is_open from t where short_answer is not null"""
)
def training_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that can be trained on."""
    return S.training_samples(table(spark, sf_dir, "training_records")).drop("answer_distribution").dropDuplicates(["record_id"])


@_query(
    r"""with s as (select distinct on (sample_id) * from merged_samples where coalesce(trim(image_id), '') <> '' and cardinality(tasks) > 0), n as (select *, regexp_replace(regexp_extract(coalesce(image_path, ''), '([^/]+)$', 1), '(.)\.[^.]*$', '\1') as stem from s)
select sample_id, case when stem <> '' then stem when try_cast(image_id as bigint) is not null then 'COCO_val2014_' || lpad(try_cast(image_id as bigint)::varchar, 12, '0') else image_id end as stored_name,
  list_sum(list_transform(map_values(tasks), lambda t: (t.soft_label is not null)::int))::int as soft, list_sum(list_transform(map_values(tasks), lambda t: (t.soft_label.kl_weight is not null)::int))::int as weighted from n"""
)
def stored_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names samples are stored under, and what is left of their labels once unstored fields are gone."""
    one = table(spark, sf_dir, "merged_samples").dropDuplicates(["sample_id"])
    kept = S.pruned(one.where(S.is_storable(one)))
    held = lambda f: F.size(F.filter(F.map_values("tasks"), f))
    return kept.select("sample_id", S.stored_name(F.coalesce("image_path", F.lit("")), F.col("image_id")).alias("stored_name"), held(lambda t: t["soft_label"].isNotNull()).alias("soft"), held(lambda t: t["soft_label"]["kl_weight"].isNotNull()).alias("weighted"))


@_query(f"with {_SCORES}, kept as (select image_id from scored where score >= 0.7), q as (select distinct question_id, image_id, question from vqa_questions) select question_id, image_id, question, row_number() over (order by image_id, question_id, question) as new_id from q where image_id in (select image_id from kept)")
def question_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The questions of the images that score at least 0.7, numbered anew."""
    kept = image_scores(spark, sf_dir).where("score >= 0.7")
    return S.subset(table(spark, sf_dir, "vqa_questions").distinct(), kept, "image_id", ["image_id", "question_id", "question"])
