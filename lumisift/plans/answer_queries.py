"""Queries on answers and replies: matching, short forms, scores, scenarios; each with its oracle, whose word lists are written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.functions import answers as A
from lumisift.functions import text as X
from lumisift.plans.reference_queries import _answers, _r, _records
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
_WORD = "case {0} when '0' then 'zero' when '1' then 'one' when '2' then 'two' when '3' then 'three' when '4' then 'four' when '5' then 'five' when '6' then 'six' when '7' then 'seven' when '8' then 'eight' when '9' then 'nine' when '10' then 'ten' when '11' then 'eleven' when '12' then 'twelve' when '13' then 'thirteen' when '14' then 'fourteen' when '15' then 'fifteen' when '16' then 'sixteen' when '17' then 'seventeen' when '18' then 'eighteen' when '19' then 'nineteen' when '20' then 'twenty' else {0} end"
_DIGIT = "case {0} when 'zero' then 0 when 'one' then 1 when 'two' then 2 when 'three' then 3 when 'four' then 4 when 'five' then 5 when 'six' then 6 when 'seven' then 7 when 'eight' then 8 when 'nine' then 9 when 'ten' then 10 when 'eleven' then 11 when 'twelve' then 12 when 'thirteen' then 13 when 'fourteen' then 14 when 'fifteen' then 15 when 'sixteen' then 16 when 'seventeen' then 17 when 'eighteen' then 18 when 'nineteen' then 19 when 'twenty' then 20 end"


def _form(c: str) -> str:
    bare = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '\b(a|an|the)\b', ' ', 'g'), '[!-/:-@\[-`{{-~]', '', 'g'), '\s+', ' ', 'g'))"
    return _WORD.format(bare)


def _set(c: str) -> str:
    return f"list_distinct(list_filter(string_split({c}, ' '), lambda w: w <> ''))"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


_SHORT = "case when contains(raw, '[Answer]') then " + _strip("string_split(" + _strip("string_split(raw, '[Answer]')[-1]") + ", chr(10))[1]") + " else '' end"
_REASONING = "case when contains(raw, '[Reasoning]') then " + _strip("string_split(raw[strpos(raw, '[Reasoning]') + 11:], '[Answer]')[1]") + " when contains(raw, '[Answer]') then '' else " + _strip("raw") + " end"


@_query(
    f"""with {_RECORDS}, t as (select record_id, coalesce(cot_reasoning.raw_reasoning, '') as raw, hard_label.answer as truth, question_category = 'open' as is_open from records where hard_label.answer is not null),
n as (select record_id, is_open, {_form(_SHORT)} as given, {_form("truth")} as wanted, {_form("raw")} as body from t)
select record_id, wanted <> '' and case when given <> '' then given = wanted else coalesce(is_open, false) and len(list_filter({_set("wanted")}, lambda w: not list_contains({_set("body")}, w))) = 0 end as matched from n"""
)
def reply_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each reply gives the labelled answer."""
    truth = F.col("hard_label.answer")
    return _records(spark, sf_dir, truth.alias("truth"), A.matches(F.col("cot_reasoning.raw_reasoning"), truth, F.col("question_category") == "open").alias("matched")).where("truth is not null").drop("truth")


@_query(f"with {_RECORDS}, t as (select record_id, coalesce(cot_reasoning.raw_reasoning, '') as raw from records) select record_id, {_REASONING} as reasoning, {_SHORT} as answer from t")
def reply_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reasoning and the short answer of each reply."""
    raw = F.col("cot_reasoning.raw_reasoning")
    return _records(spark, sf_dir, A.reasoning(raw).alias("reasoning"), F.coalesce(A.short_answer(raw), F.lit("")).alias("answer"))


@_query(
    f"""with {_RECORDS}, t as (select record_id, cot_reasoning.reasoning_paragraph as text, coalesce(cot_reasoning.raw_reasoning, '') as raw from records where cot_reasoning.reasoning_paragraph is not null),
s as (select record_id, {_form("text")} as a, {_form(_REASONING)} as b from t), w as (select record_id, {_set("a")} as a, {_set("b")} as b from s)
select record_id, round(case when len(list_distinct(a || b)) = 0 then 1.0 else len(list_intersect(a, b))::double / len(list_distinct(a || b)) end, 6) as overlap from w"""
)
def reasoning_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each record's paragraph and the reasoning in its reply have the same words."""
    text = F.col("cot_reasoning.reasoning_paragraph")
    rows = _records(spark, sf_dir, text.isNotNull().alias("held"), _r(A.overlap(text, A.reasoning(F.col("cot_reasoning.raw_reasoning"))), "overlap"))
    return rows.where("held").select("record_id", "overlap")


@_query(
    f"""with {_RECORDS}, t as (select coalesce(cot_reasoning.raw_reasoning, '') as raw, hard_label.answer as truth, question_category = 'open' as is_open, case when trim(coalesce(question_type, '')) <> '' then lower(trim(question_type)) else lower(trim(coalesce(question, ''))) end as q from records where hard_label.answer is not null),
n as (select is_open, {_form(_SHORT)} as given, {_form("truth")} as wanted, {_form("raw")} as body, q from t),
m as (select case when contains(q, 'how many') then 'counting' when regexp_matches(q, 'colou?r') then 'color' when regexp_matches(q, 'none of the above|multiple choice') then 'choice' when regexp_matches(q, '^(is|are)') then 'yes_no' when regexp_matches(q, '^(what|where|who|which|why)') then 'open' else 'other' end as bucket,
  wanted <> '' and case when given <> '' then given = wanted else coalesce(is_open, false) and len(list_filter({_set("wanted")}, lambda w: not list_contains({_set("body")}, w))) = 0 end as ok from n)
select bucket, count(*) as total, count(*) filter (where ok) as matched, round(count(*) filter (where ok) / count(*), 6) as accuracy, row_number() over (order by count(*) desc, bucket) as rank from m group by bucket"""
)
def scenario_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy by scenario, the largest first."""
    from pyspark.sql.window import Window

    truth = F.col("hard_label.answer")
    rows = _records(spark, sf_dir, truth.alias("truth"), A.scenario(F.col("question_type"), F.col("question")).alias("bucket"), A.matches(F.col("cot_reasoning.raw_reasoning"), truth, F.col("question_category") == "open").alias("ok"))
    counts = rows.where("truth is not null").groupBy("bucket").agg(F.count("*").alias("total"), F.count_if("ok").alias("matched"))
    return counts.select("bucket", "total", "matched", _r(F.col("matched") / F.col("total"), "accuracy"), F.row_number().over(Window.orderBy(F.desc("total"), "bucket")).alias("rank"))  # six rows


_SIMPLE = r"regexp_replace(regexp_replace(regexp_replace(trim(lower(answer)), '^a\s+', ''), '^an\s+', ''), '^the\s+', '')"
_BARE = "t"
for _start in ("the answer is ", "the answer would be ", "answer: ", "i can see ", "i see ", "there is ", "there are ", "it is ", "this is ", "there''s "):
    _BARE = f"regexp_replace({_BARE}, '^{_start}', '')"


@_query(
    rf"""with {_ANSWERS}, s as (select answer, {_SIMPLE} as t from answers), w as (select answer, t, list_filter(string_split_regex(t, '\s+'), lambda x: x in ('zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine', 'ten'))[1] as spoken, trim(regexp_replace({_BARE}, '\.+$', '')) as bare from s)
select answer, case when contains(t, 'no sign') or contains(t, 'no visible sign') then 'no sign'
  when regexp_matches(t, '^(yes|the answer is yes|it is yes|answer: yes|there (is|are) (yes|a yes)|the answer would be yes)$') then 'yes' when regexp_matches(t, '^(no|the answer is no|it is no|answer: no|there (is|are) (no|a no)|the answer would be no)$') then 'no'
  when spoken is not null then ({_DIGIT.format("spoken")})::varchar when regexp_matches(t, '\b[0-9]+\b') then regexp_extract(t, '\b([0-9]+)\b', 1) when length(bare) < 2 then t else bare end as short from w"""
)
def short_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long answers in short."""
    return _answers(spark, sf_dir).select("answer", A.simplified(F.col("answer")).alias("short"))


_CLOSED = r"trim(regexp_replace(regexp_replace(trim(lower(coalesce({0}, ''))), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"


def _parts(c: str) -> str:
    split = f"case when contains({c}, ' and ') then string_split({c}, ' and ') when contains({c}, ' or ') then string_split({c}, ' or ') else [{c}] end"
    mapped = "case p when 'gray' then 'grey' when 'grey' then 'gray' when 'color' then 'colour' when 'one' then '1' when 'two' then '2' when 'three' then '3' when 'four' then '4' when 'five' then '5' when 'yes' then 'true' when 'no' then 'false' when 'true' then 'yes' when 'false' then 'no' else p end"
    return f"list_distinct(list_transform(list_filter(list_transform({split}, lambda p: trim(p)), lambda p: p <> ''), lambda p: {mapped}))"


@_query(f"with {_ANSWERS}, c as (select answer, {_CLOSED.format('answer')} as closed from answers) select answer, closed, array_to_string(list_sort({_parts('closed')}), '|') as parts from c")
def closed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers without punctuation, and the set of what they name."""
    a = F.col("answer")
    return _answers(spark, sf_dir).select("answer", A.closed_form(a).alias("closed"), F.array_join(F.array_sort(A.answer_set(a)), "|").alias("parts"))


@_query(
    f"""with {_RECORDS}, c as (select record_id, {_CLOSED.format("hard_label.answer")} as h, {_CLOSED.format("cot_reasoning.answer")} as t from records where hard_label.answer is not null and cot_reasoning.answer is not null),
s as (select record_id, {_parts("h")} as h, {_parts("t")} as t from c) select record_id, len(list_filter(h, lambda p: not list_contains(t, p))) = 0 as is_subset, len(list_filter(t, lambda p: not list_contains(h, p))) as extra from s"""
)
def answer_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether all that the label names is in the final answer, and how many things that names besides."""
    h, t = A.answer_set(F.col("hard_label.answer")), A.answer_set(F.col("cot_reasoning.answer"))
    held = F.col("hard_label.answer").isNotNull() & F.col("cot_reasoning.answer").isNotNull()
    return _records(spark, sf_dir, held.alias("held"), (F.size(F.array_except(h, t)) == 0).alias("is_subset"), F.size(F.array_except(t, h)).alias("extra")).where("held").drop("held")


@_query(
    rf"""with {_RECORDS}, t as (select record_id, cot_reasoning.raw_reasoning as raw from records where cot_reasoning.raw_reasoning is not null),
n as (select record_id, try_cast(regexp_extract(raw, '(?i)Score:\s*([0-9]{{1,3}}(?:\.[0-9]+)?)', 1) as double) as named, try_cast(regexp_extract(raw, '\*{{1,2}}([0-9]{{1,3}})\*{{1,2}}', 1) as double) as bold,
  list_filter(list_transform(regexp_extract_all(raw, '\b([0-9]{{1,3}})\b', 1), lambda x: x::double), lambda x: x <= 100)[-1] as last from t),
s as (select record_id, coalesce(case when named between 0 and 100 then named end, case when bold between 0 and 100 then bold end, last) as score from n) select record_id, score from s where score is not null"""
)
def judged_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score that stands in each reply."""
    return _records(spark, sf_dir, A.judge_score(F.col("cot_reasoning.raw_reasoning")).alias("score")).where("score is not null")


@_query(
    f"""with {_RECORDS} select record_id, coalesce(case when hard_label.answer <> '' then trim(hard_label.answer) end, case when cot_reasoning.answer <> '' then trim(cot_reasoning.answer) end, case when soft_label.primary_answer <> '' then trim(soft_label.primary_answer) end) as answer,
length({_strip("coalesce(cot_reasoning.reasoning_paragraph, '')")}) as reasoning_length from records"""
)
def teacher_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer a record teaches, by three fallbacks, and how long its reasoning is."""
    answer = A.teacher_answer(F.col("hard_label.answer"), F.col("cot_reasoning.answer"), F.col("soft_label.primary_answer"))
    return _records(spark, sf_dir, answer.alias("answer"), F.length(X.stripped(F.coalesce("cot_reasoning.reasoning_paragraph", F.lit("")))).alias("reasoning_length"))


_ALL = "concat_ws(' ', nullif(question, ''), nullif(hard_label.answer, ''), nullif(cot_reasoning.reasoning_paragraph, ''), nullif(cot_reasoning.answer, ''))"


@_query(
    f"""with {_RECORDS}, t as (select record_id, lower({_ALL}) as low from records),
k as (select record_id, low, list_sum(list_transform(['system', 'user', 'assistant', 'task:', 'critical rules', 'you are', 'output only', 'four non-breakable', 'rules:'], lambda w: contains(low, w)::int))::int as words from t)
select record_id, words, words >= 3 or len(string_split(low, 'your task is to')) > 2 or len(string_split(low, 'output only one')) > 2 or len(string_split(low, 'do not describe')) > 2 as echo from k"""
)
def prompt_echoes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the prompt in all texts of a record together, and whether they echo it."""
    text = A.all_text(F.col("question"), F.col("hard_label.answer"), F.col("cot_reasoning.reasoning_paragraph"), F.col("cot_reasoning.answer"))
    return _records(spark, sf_dir, A.prompt_words(text).alias("words"), A.echoes_prompt(text).alias("echo"))


@_query(
    rf"""with {_ANSWERS}, t as (select answer, lower(trim(answer)) as a from answers), n as (select answer, a, case when regexp_matches(a, '^[0-9]+$') then try_cast(a as hugeint) end as digits, {_DIGIT.format("a")} as word from t)
select answer, coalesce(digits, word, try_cast(nullif(regexp_extract(a, '\b([0-9]+)\b', 1), '') as hugeint))::bigint as number, coalesce(digits <= 50, false) as valid, coalesce(digits, word)::bigint as parsed from n"""
)
def parsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in each answer, and whether it is a valid count."""
    check = A.counting_check(F.col("answer"))
    return _answers(spark, sf_dir).select("answer", A.parsed_number(F.col("answer")).try_cast("long").alias("number"), check["valid"].alias("valid"), check["parsed"].try_cast("long").alias("parsed"))


_STOPS = "('is', 'are', 'was', 'were', 'the', 'a', 'an', 'in', 'on', 'at', 'to', 'for', 'of', 'this', 'that', 'it')"


@_query(
    rf"""with asked as (select distinct question from training_records where question is not null), p as (select question, list_transform(regexp_extract_all(lower(trim(question)), '\b([a-z]+\s+or\s+[a-z]+)\b', 1), lambda x: string_split_regex(x, '\s+or\s+')) as pairs from asked),
f as (select question, list_filter(pairs, lambda x: x[1] not in {_STOPS} and x[2] not in {_STOPS} and length(x[1]) > 2 and length(x[2]) > 2)[1] as o from p)
select question, case when o[1] = o[2] then o[1] else o[1] || '|' || o[2] end as options from f where o is not null"""
)
def loose_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two options of longer questions with an 'or'."""
    asked = table(spark, sf_dir, "training_records").where("question is not null").select("question").distinct()
    return asked.select("question", F.array_join(A.loose_options(F.col("question")), "|").alias("options")).where("options is not null")


@_query(
    rf"""with {_RECORDS}, t as (select record_id, cot_reasoning.raw_reasoning as raw from records where cot_reasoning.raw_reasoning is not null),
f as (select record_id, raw, {_strip(r"regexp_replace(" + _strip(r"regexp_extract(raw, '(?i)\*?\*?Final Answer\*?\*?\s*[:：]\s*([^\n]+)', 1)") + r", '^\*+|\*+$', '', 'g')")} as found from t)
select record_id, case when found <> '' then found else {_strip("raw")} end as answer, len(regexp_extract_all(raw, '[\p{{L}}\p{{N}}_]+')) as words from f"""
)
def final_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final answer that a reply states, else the reply; and its number of words."""
    raw = F.col("cot_reasoning.raw_reasoning")
    return _records(spark, sf_dir, A.final_answer(raw).alias("answer"), A.count_words(raw).alias("words")).where("answer is not null")


@_query(
    rf"""with {_RECORDS} select record_id, array_to_string(list_filter(string_split(cot_reasoning.raw_reasoning, chr(10)), lambda x: not starts_with(x, 'Let''s') and not starts_with(x, 'Fir')), chr(10)) as caption
from records where contains(cot_reasoning.raw_reasoning, chr(10))"""
)
def caption_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of several lines without those that only lead up to the rest."""
    raw = F.col("cot_reasoning.raw_reasoning")
    return _records(spark, sf_dir, F.when(F.contains(raw, F.lit("\n")), A.trimmed_caption(raw)).alias("caption")).where("caption is not null")
