"""Queries of the text operators and their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumisift.llm import broken_pairs, canonical_map, cross_split, leakage, lookalikes, mixture, repetition, term_frequency, truncation
from lumisift.runtime import table


def _closed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = table(spark, sf_dir, "training_records").where("question_category = 'closed'")
    fields = {f: term_frequency.scalar_terms(F.col(f)) for f in ("hard_label.answer", "soft_label.primary_answer")}
    return term_frequency.term_frequencies(closed, "record_id", fields)


def p1_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_terms(spark, sf_dir)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closed_terms(spark, sf_dir).where("band is not null").select("field", "term", "band")


COT_FIELDS = ["cot_reasoning.reasoning_paragraph", "cot_reasoning.raw_reasoning"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = broken_pairs.defects(
        table(spark, sf_dir, "training_records"), "record_id", "question", "hard_label.answer", COT_FIELDS[1], COT_FIELDS[0], "cot_reasoning.answer", "question_category = 'closed'"
    )
    return rows.withColumnRenamed("id", "record_id")


def _truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(table(spark, sf_dir, "training_records"), "record_id", *COT_FIELDS, "cot_reasoning.answer", "question", "hard_label.answer")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncated(spark, sf_dir).withColumnRenamed("id", "record_id")


def p5_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.rates(table(spark, sf_dir, "training_records"), _truncated(spark, sf_dir), "record_id", "source", COT_FIELDS)


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, vocabulary = table(spark, sf_dir, "training_records"), table(spark, sf_dir, "answer_vocab")
    names = table(spark, sf_dir, "categories").select(F.col("name").alias("text")).union(vocabulary.select("answer")).union(vocabulary.select(F.explode("aliases")))
    return cross_split.overlaps(records, texts=records.select(F.col(COT_FIELDS[0]).alias("text")), names=names)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _overlaps(spark, sf_dir)
    return pairs.select(F.least("train_id", "eval_id").alias("record_id_a"), F.greatest("train_id", "eval_id").alias("record_id_b"))


def p4_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "training_records")
    return cross_split.totals(records, _overlaps(spark, sf_dir))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = table(spark, sf_dir, "training_records").where("question_category = 'closed'")
    fields = {"hard_label.answer": F.array("hard_label.answer"), "soft_label.answer_distribution": F.map_keys("soft_label.answer_distribution")}
    return canonical_map.map_typed(closed, "record_id", fields, table(spark, sf_dir, "answer_vocab"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(spark, sf_dir).withColumnRenamed("id", "record_id")


def p6_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _typed(spark, sf_dir).where(F.col("answer_id") == canonical_map.UNMATCHED)
    return rows.groupBy("field", "typed").agg(F.count("*").alias("records"))


def p7_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = repetition.measured_once(table(spark, sf_dir, "training_records"), "record_id", COT_FIELDS)
    return repetition.banded(measured, repetition.bands_of(measured)).withColumnRenamed("id", "record_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repetition.measures(table(spark, sf_dir, "training_records"), "record_id", COT_FIELDS, cases_only=True)
    return rows.select(F.col("id").alias("record_id"), "field").distinct()


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scores = lookalikes.fitted(documents, "doc_id", "text")
    return leakage.leaks(leakage.index(documents, scores=scores), documents, table(spark, sf_dir, "heldout_items"), scores)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir)


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(table(spark, sf_dir, "heldout_items"), _leaks(spark, sf_dir))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mixture_targets"))[0]


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mixture_targets"))[1]


def p10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.consistent_texts(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "text")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookalikes.consistent_texts(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), F.explode("kinds").alias("kind")).distinct()


QUERIES = {"p1_terms": p1_terms, "p1_found": p1_found, "p3_found": p3_found, "p5_found": p5_found, "p5_rates": p5_rates, "p4_found": p4_found, "p4_totals": p4_totals, "p6_found": p6_found, "p6_unmatched": p6_unmatched, "p7_measures": p7_measures, "p7_found": p7_found, "p8_found": p8_found, "p8_items": p8_items, "p9_mixture": p9_mixture, "p9_report": p9_report, "p10_texts": p10_texts, "p10_found": p10_found}

_P1 = r"""
with records as (
  select distinct record_id, hard_label.answer as h, soft_label.primary_answer as p
  from training_records where question_category = 'closed'
), held as (
  select 'hard_label.answer' as field, record_id, h as raw from records
  union all select 'soft_label.primary_answer', record_id, p from records
), terms as (
  select field, record_id, trim(regexp_replace(lower(raw), '[\s\v\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]+', ' ', 'g')) as term from held
), counted as (
  select field, term, count(*) as occurrences, count(distinct record_id) as records from terms where term <> '' group by field, term
), totals as (
  select field, count(distinct record_id) as total from terms where term <> '' group by field
), banded as (
  select field, term, occurrences, records,
    case when records <= 2 then 'rare' when records >= 0.02 * total then 'common' end as band
  from counted join totals using (field)
)
"""
_P7 = r"""
with records as (select distinct record_id, cot_reasoning.reasoning_paragraph as p, cot_reasoning.raw_reasoning as r from training_records),
texts as (select record_id, 'cot_reasoning.reasoning_paragraph' as field, p as text from records union all select record_id, 'cot_reasoning.raw_reasoning', r from records),
words as (select record_id, field, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from texts where text is not null),
runs as (select record_id, field, len(w) as n, i, array_to_string(w[i:i + 4], ' ') as run from (select record_id, field, w, unnest(range(1, len(w) - 3)) as i from words where len(w) > 5)),
again as (select record_id, field, n, i from runs qualify row_number() over (partition by record_id, field, run order by i) > 1),
covered as (select distinct record_id, field, n, i + k as at from again, (select unnest(range(5)) as k))
select record_id, field from covered group by record_id, field, n having count(*) >= 0.3 * n
"""
_P10 = r"""
with d as (select doc_id, text, regexp_replace(text, '[\x{ad}\x{200b}-\x{200f}\x{2060}-\x{2064}\x{feff}]', '', 'g') as bare from documents where text is not null),
found as (
  select doc_id, 'form' as kind from d where regexp_matches(text, '[\x{ff10}-\x{ff19}\x{ff21}-\x{ff3a}\x{ff41}-\x{ff5a}\x{fb00}-\x{fb06}\x{1d400}-\x{1d7ff}\x{2460}-\x{2473}\x{24b6}-\x{24ea}\x{2102}\x{210a}-\x{2113}\x{2115}\x{2119}-\x{211d}\x{2124}\x{212f}-\x{2134}]')
  union all select doc_id, 'accent' from d where regexp_matches(bare, '[A-Za-z\x{c0}-\x{24f}\x{370}-\x{52f}\x{1e00}-\x{1fff}][\x{300}-\x{36f}]')
  union all select doc_id, 'invisible' from d where regexp_matches(text, '[\x{ad}\x{200b}\x{200c}\x{200e}\x{200f}\x{2060}-\x{2064}\x{feff}]') or regexp_matches(text, '[^\x{2190}-\x{2bff}\x{fe0f}\x{1f000}-\x{1faff}]\x{200d}|\x{200d}[^\x{2190}-\x{2bff}\x{fe0f}\x{1f000}-\x{1faff}]')
  union all select doc_id, 'space' from d where regexp_matches(text, '[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]')
  union all select doc_id, 'lookalike' from d where regexp_matches(bare, '[A-Za-z\x{c0}-\x{24f}][\x{370}-\x{3ff}\x{400}-\x{52f}]|[\x{370}-\x{3ff}\x{400}-\x{52f}][A-Za-z\x{c0}-\x{24f}]')
) select distinct doc_id, kind from found
"""
SQL = {
    "p7_found": _P7,
    "p10_found": _P10,
    "p1_terms": _P1 + "select field, term, occurrences, records, band from banded",
    "p1_found": _P1 + "select field, term, band from banded where band is not null",
}
