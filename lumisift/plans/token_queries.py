"""Queries on the tokens of distributions: validity, filters, equivalents, types and levels; each with its oracle, whose word lists are written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.functions import distributions as D
from lumisift.functions import text as X
from lumisift.functions import tokens as K
from lumisift.functions.types import LEVELS, level_of, outcome
from lumisift.plans.answer_queries import _form
from lumisift.plans.reference_queries import _dists, _long, _r, _records
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
_DISTS = f"{_RECORDS}, d as (select record_id, question, hard_label.answer as hard, soft_label.primary_answer as best, list_filter(map_entries(soft_label.answer_distribution), lambda e: e.value > 0) as d from records), cells as (select record_id, question, hard, best, i - 1 as pos, d[i].key as token, d[i].value as v from (select record_id, question, hard, best, d, unnest(range(1, len(d) + 1)) as i from d where len(d) > 0))"
_REJECTED = """('<pad>', '</s>', '<unk>', '<image>', '<bos>', '<eos>', '<s>', '<|startoftext|>', '<|im_start|>', '<|im_end|>', '<|im|>', '<|>', '[cls]', '[sep]', '[pad]', '[unk]',
  '.', ',', '!', '?', ';', ':', '"', '''', '(', ')', '[', ']', '{', '}', '-', '_', '+', '=', '*', '&', '^', '%', '$', '#', '@', '~', '`', '|', '\\', '/', '<', '>', '**', '*t', '*s', '*m', '>t', '>s', '``', '''''', '@#', '$%', '^^', '***', '---', '___', '...', '!!!', '##', '==', '++', '--', '~@',
  'the', 'a', 'an', 'this', 'that', 'these', 'those', 'in', 'on', 'at', 'to', 'for', 'of', 'with', 'by', 'from', 'up', 'down', 'over', 'under', 'it', 'they', 'he', 'she', 'we', 'you', 'i', 'me', 'him', 'her', 'and', 'or', 'but', 'so', 'because', 'if', 'when', 'where', 'is', 'are', 'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had', 'do', 'does', 'did', 'will', 'would', 'can', 'could', 'should', 'may', 'might', 'must', 'not', 'very', 'too', 'also', 'just', 'only', 'even', 'there', 'here', 'what', 'how', 'why', 'which', 'who', 'whose', 'answer', 'question', 'image', 'photo', 'picture', 'maybe', 'none', 'bool', 'boolean', 'true', 'false')"""
_COUNTS = "('0', '1', '2', '3', '4', '5', '6', '7', '8', '9', '10', '11', '12', '13', '14', '15', '16', '17', '18', '19', '20')"
_COLORS = "('red', 'green', 'blue', 'yellow', 'orange', 'purple', 'pink', 'brown', 'black', 'white', 'gray', 'grey', 'cyan', 'magenta', 'turquoise', 'azure', 'silver', 'golden', 'bronze', 'maroon', 'navy', 'teal', 'olive', 'lime')"


def _valid(raw: str, low: str) -> str:
    return rf"""(not ({low} = '' or {low} in {_REJECTED} or starts_with({raw}, 'Ġ') or regexp_matches({low}, '^[_\-.(\[]|[_\-.)]$') or regexp_matches({raw}, '^[A-Z][a-z]$|^##|^@@') or (length({low}) <= 3 and regexp_matches({low}, '[*><`''"#@$%^&|\\/~]')))
  and (regexp_matches({low}, '^[0-9]+$') or {low} in {_COLORS} or {low} in ('yes', 'no') or length({low}) between 5 and 20))"""


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = table(spark, sf_dir, "training_records").select(F.explode(F.map_keys("soft_label.answer_distribution")).alias("token"))
    return held.distinct()


_TOKENS = "tokens as (select distinct unnest(map_keys(soft_label.answer_distribution)) as token from training_records)"


@_query(f"with {_TOKENS} select token, {_valid('token', 'trim(lower(token))')} as valid from tokens")
def valid_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each token of any distribution can be an answer."""
    return _tokens(spark, sf_dir).select("token", K.valid(F.col("token")).alias("valid"))


_EQUIVALENT = "case {0} " + " ".join(f"when '{w}' then '{k}'" for k, ws in {"0": "zero zeroth", "1": "one a an single ones first 1st", "2": "two double pair twos second 2nd", "3": "three triple threes third 3rd", "4": "four quadruple fours fourth 4th", "5": "five quintuple fives fifth 5th", "6": "six sixth 6th", "7": "seven seventh 7th", "8": "eight eighth 8th", "9": "nine ninth 9th", "10": "ten tenth 10th", "yes": "yeah yep sure likely possibly probably absolutely definitely correct right", "no": "nos non nah nope never incorrect wrong", "gray": "grey grays greys", "golden": "gold"}.items() for w in ws.split()) + " end"
_BARE = r"""lower(regexp_replace(regexp_replace(trim(token), '[.,!?;:"'')\]}\-]+$', ''), '^[(\[{"''\-_]+', ''))"""
_SINGLE = r"case when length(b) <= 3 then b when regexp_matches(b, 'ies$') then regexp_replace(b, 'ies$', 'y') when regexp_matches(b, 'es$') then case when length(b) >= 5 and regexp_matches(b, '(x|s|sh|ch|zz)es$') then regexp_replace(b, 'es$', '') else b end when regexp_matches(b, '[^s]s$') then regexp_replace(b, 's$', '') else b end"
_CANONICAL = f"case when b = '' then token else coalesce({_EQUIVALENT.format('b')}, {_EQUIVALENT.format('s')}, s) end"
_STEM = r"case when length(c) < 3 then c when regexp_matches(c, 'ies$') and length(c) > 4 then regexp_replace(c, 'ies$', 'y') when regexp_matches(c, '(s|x|z|ch|sh)es$') and length(c) > 3 then regexp_replace(c, 'es$', '') when regexp_matches(c, '[^s]s$') then regexp_replace(c, 's$', '') else c end"


@_query(f"with {_TOKENS}, a as (select token, {_BARE} as b from tokens), n as (select token, b, {_SINGLE} as s from a), k as (select token, {_CANONICAL} as c from n) select token, c as canonical, {_STEM} as stem from k")
def canonical_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token that stands for each token, and its stem."""
    c = K.canonical(F.col("token"))
    return _tokens(spark, sf_dir).select("token", c.alias("canonical"), K.stem(c).alias("stem"))


@_query(f"with {_DISTS}, a as (select record_id, token, v, {_BARE} as b from cells), n as (select record_id, token, v, b, {_SINGLE} as s from a), k as (select record_id, v, {_CANONICAL} as c from n), m as (select record_id, {_STEM} as token, sum(v) as v from k group by all) select record_id, token, round(v / sum(v) over (partition by record_id), 6) as p from m")
def merged_equivalents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributions whose equivalent tokens are summed, normalised."""
    from pyspark.sql.window import Window

    rows = _long(_dists(spark, sf_dir), "record_id", digits=None)
    merged = rows.groupBy("record_id", K.stem(K.canonical(F.col("token"))).alias("token")).agg(F.sum("p").alias("v"))
    return merged.select("record_id", "token", _r(F.col("v") / F.sum("v").over(Window.partitionBy("record_id")), "p"))


@_query(
    f"""with {_DISTS}, c as (select record_id, pos, trim(lower(token)) as low, lower(token) as raw, v, lower(best) as best from cells),
f as (select record_id, low as token, pos, v from c where v >= 0.001 and (coalesce(low = best, false) or {_valid("low", "low")})),
u as (select record_id, token, min(pos) as pos, max_by(v, pos) as v from f group by all),
o as (select record_id, raw as token, pos, v from c where coalesce(raw = best, false) and record_id not in (select record_id from u) qualify row_number() over (partition by record_id order by pos) = 1),
k as (select * from (select * from u union all select * from o) qualify row_number() over (partition by record_id order by v desc, pos) <= 50)
select record_id, token, round(v / sum(v) over (partition by record_id), 6) as p from k"""
)
def filtered_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributions without tokens that are no answer."""
    rows = _records(spark, sf_dir, F.lower("soft_label.primary_answer").alias("best"), D.entries(F.col("soft_label.answer_distribution")).alias("d"))
    return _long(rows.withColumn("d", K.kept(F.col("d"), F.col("best"))), "record_id").drop("pos")


_TYPE = "case when regexp_matches(q, 'how many|how much|count|number|quantity|多少|几个|数量') then 'count' when regexp_matches(q, 'what color|color is|what colour|colour is|颜色|色彩') then 'color' when regexp_matches(q, 'is there|are there|is it|are they|does|do you|can you|could you|是否|有没有') then 'binary' else 'other' end"


@_query(
    f"""with {_DISTS}, c as (select record_id, pos, token, v, trim(lower(token)) as low, trim(lower(hard)) as h, lower(coalesce(question, '')) as q from cells),
t as (select *, case when h in {_COUNTS} or regexp_matches(h, '^[0-9]+$') then 'count' when h in {_COLORS} then 'color' when h in ('yes', 'no') then 'binary' else {_TYPE} end as kind from c),
f as (select record_id, kind, case when kind = 'other' then token else low end as token, pos, v from t where kind = 'other' or coalesce(low = h, false) or (kind = 'count' and low in {_COUNTS}) or (kind = 'color' and low in {_COLORS}) or (kind = 'binary' and low in ('yes', 'no'))),
u as (select record_id, kind, token, max_by(v, pos) as v from f group by all)
select record_id, kind, token, round(case when kind = 'other' then v else v / sum(v) over (partition by record_id) end, 6) as p from u"""
)
def whitelisted_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distributions cut to the tokens that can be an answer of the question's type; those of other types as they are."""
    hard = F.col("hard_label.answer")
    rows = _records(spark, sf_dir, K.task_type(F.col("question"), hard).alias("kind"), hard.alias("hard"), D.entries(F.col("soft_label.answer_distribution")).alias("d"))
    return _long(rows.withColumn("d", K.whitelisted(F.col("d"), F.col("kind"), F.col("hard"))), "record_id", "kind").drop("pos")


_TYPES = "types as (select lower(answer) as token, category from answer_vocab union select lower(unnest(aliases)), category from answer_vocab), kinds as (select token, list(category) as kinds from types where category is not null group by token)"
_LEVEL = "case x when 'animal' then 1 when 'vehicle' then 1 when 'person' then 1 when 'yesno' then 2 when 'number' then 2 when 'count' then 2 when 'place' then 3 when 'location' then 3 else 4 end"


@_query(
    f"""with {_DISTS}, {_TYPES}, c as (select record_id, trim(lower(token)) as low, trim(lower(hard)) as h, v from cells where hard is not null),
j as (select c.*, coalesce(k.kinds, []) as mine, coalesce(g.kinds, []) as theirs from c left join kinds k on c.low = k.token left join kinds g on c.h = g.token),
m as (select *, case when len(theirs) = 0 then not list_has_any(mine, ['number', 'count', 'color', 'place', 'location', 'yesno']) else list_has_any(mine, theirs) end as ok, least(4, coalesce(list_min(list_transform(list_filter(mine, lambda x: not list_contains(theirs, x)), lambda x: {_LEVEL})), 4)) as level from j),
g as (select record_id, count(*) as tokens, count(*) filter (where ok) as kept, count(*) filter (where not ok and len(theirs) > 0 and level = 1) as level_1, count(*) filter (where not ok and len(theirs) > 0 and level = 2) as level_2, count(*) filter (where not ok and len(theirs) > 0 and level = 3) as level_3, count(*) filter (where not ok and len(theirs) > 0 and level = 4) as level_4, count(*) filter (where ok and low = h) = 0 as fallback from m group by record_id)
select *, case when level_1 > 0 then 0.0 when level_2 > 0 then 0.1 when level_3 > 0 then 0.3 when level_4 > 0 then 0.0 else 1.0 end::double as kl_weight from g"""
)
def type_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each distribution how many tokens share a type with the label, how severe the others' types are, whether the label must be added, and the weight that follows; the types are a bounded dimension table."""
    vocabulary = table(spark, sf_dir, "answer_vocab")
    typed = vocabulary.select(F.lower("answer").alias("token"), "category").union(vocabulary.select(F.explode("aliases").alias("token"), "category").select(F.lower("token"), "category")).distinct()
    kinds = typed.where("category is not null").groupBy("token").agg(F.collect_list("category").alias("kinds"))
    cells = _dists(spark, sf_dir).where("hard is not null").select("record_id", F.trim(F.lower("hard")).alias("h"), F.explode("d").alias("e")).select("record_id", "h", F.trim(F.lower("e.key")).alias("low"))
    none = F.array().cast("array<string>")
    joined = cells.join(kinds.select(F.col("token").alias("low"), F.col("kinds").alias("mine")), "low", "left").join(kinds.select(F.col("token").alias("h"), F.col("kinds").alias("theirs")), "h", "left")
    held = joined.select("record_id", "h", "low", F.coalesce("mine", none).alias("mine"), F.coalesce("theirs", none).alias("theirs"))
    judged = held.select("record_id", (F.col("low") == F.col("h")).alias("label"), *outcome(F.col("mine"), F.col("theirs"), LEVELS))
    return level_of(judged)


@_query(
    f"""with {_DISTS}, c as (select record_id, question_category, best_token, short, tokens, one_word from (select record_id, max_by(token, struct_pack(v := v, p := -pos)) as best_token, any_value(hard) as short, count(*) as tokens, count(*) filter (where contains(trim(token), ' ')) = 0 as one_word from cells group by record_id) join records using (record_id))
select record_id, tokens, coalesce(trim(short) <> '' and one_word and {_form("best_token")} = {_form("short")}, false) as eligible from c"""
)
def divergence_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a distribution can be compared token by token: a label, only single words, and the likeliest of them the label."""
    d, hard = F.col("d"), F.col("hard")
    best = F.get(D.ranked(d), F.lit(0))["key"]
    single = F.size(F.filter(d, lambda e: F.contains(F.trim(e["key"]), F.lit(" ")))) == 0
    ok = (F.trim(hard) != "") & single & (X.match_form(best) == X.match_form(hard))
    return _dists(spark, sf_dir).select("record_id", F.size(d).alias("tokens"), F.coalesce(ok, F.lit(False)).alias("eligible"))


@_query(
    f"""with {_DISTS}, g as (select record_id, any_value(hard) as hard, sum(v) as s from cells group by record_id having any_value(hard) is not null),
k as (select g.record_id, sum((v / s) * ln((v / s) / case when token = g.hard then 1.0 else 1e-10 end)) as kl from g join cells using (record_id) group by g.record_id)
select count(*) as records, round(avg(kl), 5) as mean, round(quantile_cont(kl, 0.5), 5) as median, round(stddev_pop(kl), 5) as std, count(*) filter (where kl > 1) as high from k"""
)
def divergence_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the distributions are from their labels alone: mean, median, deviation, and how many are far."""
    p = D.renormalised(F.col("d"))
    each = F.transform(p, lambda e: e["value"] * F.ln(e["value"] / F.when(e["key"] == F.col("hard"), 1.0).otherwise(1e-10)))
    rows = _dists(spark, sf_dir).where("hard is not null").select(F.aggregate(each, F.lit(0.0), lambda a, x: a + x).alias("kl"))
    return rows.agg(F.count("*").alias("records"), _r(F.avg("kl"), "mean", 5), _r(F.percentile("kl", 0.5), "median", 5), _r(F.stddev_pop("kl"), "std", 5), F.count_if(F.col("kl") > 1).alias("high"))


@_query(f"with {_DISTS}, r as (select *, row_number() over (partition by record_id order by v desc, pos) as k from cells) select record_id, token, round(v, 6) as p from r where k <= 20 or v > 0.01 or token = hard")
def stored_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty likeliest tokens, any above 0.01 and the label."""
    ranked = D.ranked(F.col("d"))
    kept = F.filter(F.transform(ranked, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("i"))), lambda e: (e["i"] < 20) | (e["value"] > 0.01) | F.coalesce(e["key"] == F.col("hard"), F.lit(False)))
    return _long(_dists(spark, sf_dir).withColumn("d", kept), "record_id").drop("pos")
