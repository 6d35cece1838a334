"""DuckDB SQL equivalents of the queries in :mod:`lumisift.plans.reference_queries`."""

from lumisift.functions import text as X
from lumisift.operators import images as I


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _set(words) -> str:
    return "(" + ", ".join(f"'{w}'" if isinstance(w, str) else str(w) for w in words) + ")"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


_NUMBERS = "case {} " + " ".join(f"when '{w}' then '{i}'" for i, w in enumerate(X.NUMBER_WORDS)) + " end"

_SPOKEN = "case {} " + " ".join(f"when '{i}' then '{w}'" for i, w in enumerate(X.NUMBER_WORDS)) + " end"


def _clean(c: str) -> str:
    return rf"regexp_replace(trim(regexp_replace(lower(trim(coalesce({c}, ''))), '\s+', ' ', 'g')), '[.!?]+$', '')"


def _match(c: str) -> str:
    bare = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(coalesce({c}, ''))), '\b(a|an|the)\b', ' ', 'g'), '[!-/:-@\[-`{{-~]', '', 'g'), '\s+', ' ', 'g'))"
    return f"coalesce({_SPOKEN.format(bare)}, {bare})"


def _words(c: str) -> str:
    return f"list_distinct(list_filter(string_split(lower(coalesce({c}, '')), ' '), lambda w: w <> ''))"


_ANSWERS = "answers as (select distinct hard_label.answer as answer from training_records where question_category = 'closed' and hard_label.answer is not null)"
_RECORDS = "records as (select distinct on (record_id) * from training_records)"
_SAMPLES = "samples as (select distinct on (sample_id) * from merged_samples), tasks as (select sample_id, e.key as task, e.value as t from (select sample_id, unnest(map_entries(tasks)) as e from samples))"
_DISTS = f"{_RECORDS}, d as (select record_id, hard_label.answer as hard, list_filter(map_entries(soft_label.answer_distribution), lambda e: e.value > 0) as d from records), cells as (select record_id, hard, i - 1 as pos, d[i].key as token, d[i].value as v from (select record_id, hard, d, unnest(range(1, len(d) + 1)) as i from d where len(d) > 0))"
_VOTE = """cleaned as (
  select distinct on (question_id) question_id, lower(trim(coalesce(multiple_choice_answer, ''))) as fallback,
    list_transform(list_filter(coalesce(answers, []), lambda x: coalesce(x.answer_confidence, 'yes') <> 'no' and coalesce(lower(trim(x.answer)), '') <> ''), lambda x: lower(trim(x.answer))) as valid
  from vqa_annotations
), votes as (
  select question_id, answer, count(*) as n, min(i) as first from (select question_id, unnest(valid) as answer, unnest(range(len(valid))) as i from cleaned) group by question_id, answer
), best as (
  select question_id, first(answer order by n desc, first) as answer, max(n) as n, count(*) as distinct_answers from votes group by question_id
), voted as (
  select question_id, coalesce(b.answer, fallback) as answer, round(coalesce(b.n / len(valid), 1.0), 4) as consistency, coalesce(b.distinct_answers, 1) as distinct_answers, len(valid) as votes
  from cleaned left join best b using (question_id)
)"""


def _choice(question: str) -> str:
    text = f"lower(trim({question}))"
    tries = []
    for pattern in (r"^(?:are|is|was|were)\s+(.+?)\s+or\s+(.+?)\??$", r"^(?:is|was)\s+it\s+(.+?)\s+or\s+(.+?)\??$", r"^choose\s+(.+?)\s+or\s+(.+?)\??$", r"^which\s+one[,\s]+(.+?)\s+or\s+(.+?)\??$", r"^(.+?)\s+or\s+(.+?)\?$"):
        a, b = (f"trim(regexp_extract({text}, '{pattern}', {i}))" for i in (1, 2))
        fits = rf"{a} <> '' and {b} <> '' and len(string_split_regex({a}, '\s+')) <= 3 and len(string_split_regex({b}, '\s+')) <= 3"
        tries.append(f"when {fits} then case when {a} = {b} then [{a}] else [{a}, {b}] end")
    return "case " + " ".join(tries) + " end"


def _type(question: str) -> str:
    text = f"lower(trim({question}))"
    has = lambda words: f"regexp_matches({text}, '{'|'.join(words)}')"
    return f"""case when {_choice(question)} is not null then 'choice'
      when regexp_matches({text}, '^(?:{"|".join(X.YES_NO_STARTS)})') then 'yes_no'
      when {has(X.COLOR_WORDS)} or (regexp_matches({text}, 'colou?r') and not {has(X.COLOR_EXCEPT)}) then 'color'
      when {has(X.COUNT_WORDS)} then 'counting' when {has(X.PLACE_WORDS)} then 'location' when {has(X.OPEN_WORDS)} then 'open' end"""


_TIER = "case when hard_label.confidence < 0.4 then 'low' when hard_label.confidence <= 0.95 then 'middle' when hard_label.confidence <= 0.98 then 'high' when hard_label.confidence is not null then 'ultra' else 'none' end"
_PLAIN = "cot_reasoning.raw_reasoning"
for _pattern, _to in ((r"(?m)^#{1,6}\s*", ""), (r"\*\*([^*]+)\*\*", r"\1"), (r"\*([^*]+)\*", r"\1"), (r"(?m)^\s*[-0-9]+\.\s*", ""), (r"\s+", " ")):
    _PLAIN = f"regexp_replace({_PLAIN}, '{_pattern}', '{_to}', 'g')"
_UNQUOTED = "cot_reasoning.reasoning_paragraph"
for _l, _rr in ('""', "''", "“”", "‘’", "「」", "『』"):
    _pattern = f"{_l}([^{_rr}\n]+){_rr}".replace("'", "''")
    _UNQUOTED = f"regexp_replace({_UNQUOTED}, '{_pattern}', '\\1', 'g')"
_WEIGHT = "case category_id " + " ".join(f"when {k} then {v}" for k, v in I.WEIGHTS.items()) + " else 1.0 end"
_MATCHED = rf"regexp_matches(lower(question), '\b(?:{'|'.join(I.KEYWORDS)})s?\b') and not regexp_matches(lower(question), '\b(?:{'|'.join(I.NEGATIVE)})s?\b')"
_SCORES = f"""one as (select distinct image_id, id, category_id from instances),
objects as (select image_id, count(*) as objects, sum(case when category_id in {_set(I.FACILITIES + I.VEHICLES)} then {_WEIGHT} when category_id in {_set(I.AUXILIARY)} then 0.3 * {_WEIGHT} else 0.0 end) as weight,
  coalesce(bool_or(category_id in {_set(I.FACILITIES + I.VEHICLES)}), false) as strong from one group by image_id),
texts as (select image_id, coalesce(bool_or({_MATCHED}), false) as matched from vqa_questions group by image_id),
parts as (select i.id as image_id, coalesce(objects, 0) as objects,
  case when coalesce(strong, false) then 0.5 + least(0.5, coalesce(weight, 0.0) / 15) when coalesce(weight, 0.0) > 0 then least(0.3, weight / 20) else 0.0 end as c,
  case when coalesce(matched, false) then 0.5 else 0.0 end as t,
  least(1.0, 0.5 + case when width > 0 and height > 0 and width / height between 1.5 and 2.5 then 0.3 when width > 0 and height > 0 and width / height > 2.5 and width / height <= 3 then 0.2 else 0.0 end
    + case when coalesce(objects, 0) between 5 and 20 then 0.2 when coalesce(objects, 0) > 20 and coalesce(objects, 0) <= 50 then 0.1 else 0.0 end)::double as s
  from images i left join objects o on i.id = o.image_id left join texts q on i.id = q.image_id),
scored as (select image_id, objects, round(c::double, 6) as category_score, round(t::double, 6) as text_score, round(s, 6) as scene_score, round(least(1.0, 0.4::double * c::double + 0.35::double * t::double + 0.25::double * s), 6) as score from parts)"""
_SCENES = """one as (select distinct image_id, id, category_id from instances),
counts as (select image_id, supercategory, count(*) as n from one left join categories c on one.category_id = c.id group by all),
known as (select image_id, max(n) as top from counts where supercategory is not null group by image_id),
scenes as (select image_id, case when count(*) filter (where supercategory is not null and n = top) = 1 then max(case when n = top then supercategory end) else 'mixed' end as scene, sum(n)::bigint as objects
  from counts left join known using (image_id) group by image_id)"""
_WEIGHTED = """given as (select lower(trim(a.answer)) as answer, coalesce(a.answer_confidence, 'yes') as c from (select unnest(answers) as a from (select distinct on (question_id) question_id, answers from vqa_annotations))),
weighted as (select answer, sum(case c when 'yes' then 1.0 when 'maybe' then 0.5 else 0.1 end)::double as weight, count(*) as given from given where answer <> '' group by answer)"""
_COUNT_OK = f"{_match('t.hard_label.answer')} = {_match('t.ground_truth')}"

SQL = {
    "normalise_answers": f"with {_ANSWERS} select answer, {_clean('answer')} as clean, case when contains({_clean('answer')}, 'yes') then 'yes' when contains({_clean('answer')}, 'no') then 'no' end as yes_no, {_match('answer')} as match_form from answers",
    "normalise_counts": f"""with {_ANSWERS}, t as (select answer, lower(trim(answer)) as a from answers)
select answer, case when regexp_matches(a, '^[0-9]+$') then a else {_NUMBERS.format("a")} end as number,
  (case when regexp_matches(a, '^[0-9]+$') then case when try_cast(a as hugeint) <= 50 then 1.0 else 0.5 end when {_NUMBERS.format("a")} is not null then 1.0 else 0.3 end)::double as confidence from t""",
    "normalise_colors_places": f"""with {_ANSWERS}, t as (select answer, {_clean("answer")} as c, list_filter(string_split({_clean("answer")}, ' '), lambda w: w <> '' and w not in {_set(X.COLOR_MODIFIERS)}) as words from answers)
select answer, case when len(words) = 1 then words[1] else coalesce(list_filter(words, lambda w: w in {_set(X.COLORS)})[1], words[1]) end as color,
  case when c in {_set(X.PLACES)} then c else list_filter({_list(X.PLACES)}, lambda p: contains(c, p))[1] end as place from t""",
    "plain_replies": f"with {_RECORDS} select record_id, trim({_PLAIN}) as plain, {_UNQUOTED} as unquoted from records where cot_reasoning.raw_reasoning is not null",
    "reply_signals": rf"""with {_RECORDS}, t as (select *, cot_reasoning.reasoning_paragraph as text, {_words("question")} as q, {_words("cot_reasoning.reasoning_paragraph")} as w, {_match("hard_label.answer")} as h, {_match("cot_reasoning.answer")} as c from records)
select record_id, length(text) as chars, len(string_split(text, ' ')) as pieces,
  round(case when len(list_distinct(q || w)) = 0 then 1.0 else len(list_intersect(q, w))::double / len(list_distinct(q || w)) end, 6) as overlap,
  round(case when length(text) > 0 then (length(text) - length(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')))::double / length(text) else 0.0 end, 6) as control_share,
  h = c or coalesce(case h {" ".join(f"when '{a}' then '{b}'" for a, b in X.SYNONYMS.items())} end = c, false) as same_answer
from t where text is not null""",
    "classify_questions": f"with asked as (select distinct question from vqa_questions where question is not null) select question, {_type('question')} as type, array_to_string({_choice('question')}, '|') as options from asked",
    "question_type_counts": f"with {_RECORDS} select question_type, {_type('question')} as by_rule, count(*) as records from records group by all",
    "vote_ground_truth": f"with {_VOTE} select question_id, answer, consistency, distinct_answers, votes from voted",
    "join_ground_truth": f"with {_VOTE} select question_id, image_id, trim(question) as question, answer, consistency from (select distinct * from vqa_questions) left join voted using (question_id)",
    "questions_without_answers": "select distinct question_id, image_id, question from vqa_questions where question_id not in (select question_id from vqa_annotations where question_id is not null)",
    "first_question_of_image": "select image_id, question_id, question from (select distinct * from vqa_questions) qualify row_number() over (partition by image_id order by question_id, question) = 1",
    "renormalise": f"with {_DISTS} select record_id, pos, token, round(v / sum(v) over (partition by record_id), 6) as p from cells",
    "soften": f"with {_DISTS}, e as (select *, exp(ln(v) / 3 - max(ln(v) / 3) over (partition by record_id)) as x from cells) select record_id, pos, token, round(x / sum(x) over (partition by record_id), 6) as p from e",
    "nucleus": f"""with {_DISTS}, n as (select record_id, token, pos, v / sum(v) over (partition by record_id) as p from cells),
r as (select *, row_number() over w as k, sum(p) over (w rows unbounded preceding) as upto from n window w as (partition by record_id order by p desc, pos)),
kept as (select * from r qualify k <= least(count(*) filter (where upto <= 0.9) over (partition by record_id) + 1, 20))
select record_id, k - 1 as pos, token, round(p / sum(p) over (partition by record_id), 6) as p from kept""",
    "top_tokens": f"with {_DISTS}, r as (select *, row_number() over (partition by record_id order by v desc, pos) as k from cells) select record_id, k - 1 as pos, token, round(v, 6) as p from r where k <= 2",
    "merge_equal_tokens": f"with {_DISTS}, n as (select record_id, {_match('token')} as token, v / sum(v) over (partition by record_id) as p from cells) select record_id, token, round(sum(p), 6) as p from n group by all",
    "merge_logits": f"""with {_DISTS}, e as (select record_id, {_match("token")} as token, exp(ln(v) / 3 - max(ln(v) / 3) over (partition by record_id)) as e from cells),
m as (select record_id, token, sum(e) as e from e group by all) select record_id, token, round(e / sum(e) over (partition by record_id), 6) as p from m""",
    "distribution_metrics": f"""with {_DISTS}, n as (select *, v / sum(v) over (partition by record_id) as p, row_number() over (partition by record_id order by v desc, pos) as k from cells)
select record_id, round(sum(v), 6) as raw_sum, count(*) as tokens, max(token) filter (where k = 1) as primary, round(-sum(p * log2(p)), 6) as entropy,
  round(max(p) filter (where k = 1) - coalesce(max(p) filter (where k = 2), 0.0), 6) as gap,
  round(case when any_value(hard) is not null then -ln(greatest(coalesce(max(p) filter (where token = hard), 0.0), 1e-10)) end, 6) as cross_entropy
from n group by record_id""",
    "compare_distributions": f"""with {_SAMPLES}, h as (select sample_id, task, list_filter(map_entries(t.gt_dist), lambda e: e.value > 0) as p, list_filter(map_entries(t.soft_label.answer_distribution), lambda e: e.value > 0) as q from tasks),
ok as (select * from h where len(p) > 0 and len(q) > 0),
pc as (select sample_id, task, e.key as k, e.value as v, i, p0 from (select sample_id, task, unnest(p) as e, unnest(range(len(p))) as i, list_sum(list_transform(p, lambda x: x.value)) as p0 from ok)),
qc as (select sample_id, task, e.key as k, e.value as v, i, q0 from (select sample_id, task, unnest(q) as e, unnest(range(len(q))) as i, list_sum(list_transform(q, lambda x: x.value)) as q0 from ok)),
j as (select pc.sample_id, pc.task, pc.v / p0 as p, coalesce(qc.v / q0, 0.0) as q from pc left join qc on pc.sample_id = qc.sample_id and pc.task = qc.task and pc.k = qc.k),
a as (select sample_id, task, sum(p * (ln(p) - ln(greatest(q, 1e-10)))) as kl, sum(p * q) as dot, sqrt(sum(p * p)) as np from j group by all),
b as (select sample_id, task, sqrt(sum((v / q0) * (v / q0))) as nq, first(k order by v desc, i) as top from qc group by all),
c as (select sample_id, task, first(k order by v desc, i) as top from pc group by all)
select sample_id, task, round(kl, 5) as kl, round(dot / (np * nq), 5) as cosine, b.top = c.top as same_top from a join b using (sample_id, task) join c using (sample_id, task)""",
    "confidence_profile": f"""with {_RECORDS}, v as (select hard_label.confidence as v, row_number() over (order by hard_label.confidence) - 1 as i, count(*) over () as n from records where hard_label.confidence is not null)
select count(*) as n, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as std, round(min(v), 6) as least, round(max(v), 6) as greatest,
  round(max(v) filter (where i = n // 4), 6) as q1, round(max(v) filter (where i = n // 2), 6) as q2, round(max(v) filter (where i = 3 * n // 4), 6) as q3 from v""",
    "confidence_tiers": f"with {_RECORDS}, t as (select question_category, {_TIER} as tier from records) select question_category, tier, count(*) as records, grouping_id(question_category, tier) as level from t group by rollup (question_category, tier)",
    "cap_confident": f"""with {_RECORDS}, t as (select record_id, {_TIER} as tier from records),
r as (select *, count(*) over () as n, count(*) over (partition by tier) as k, row_number() over (partition by tier order by md5('42:' || record_id), record_id) as i, case tier when 'middle' then 0.35::double when 'ultra' then 0.01::double end as cap from t)
select record_id, tier from r where cap is null or k <= n * cap or i <= floor(n * cap)""",
    "calibration_error": f"""with {_SAMPLES}, v as (select t.hard_label.confidence as c, case when {_COUNT_OK} then 1.0 else 0.0 end as ok from tasks where t.hard_label.confidence is not null and t.ground_truth is not null and t.hard_label.answer is not null),
b as (select floor(c * 10) as half, least(floor(c * 10), 9) as closed, c, ok from v),
x as (select 'closed' as bins, count(*) as k, abs(avg(ok) - avg(c)) as g from b group by closed union all select 'half_open', count(*), case when half < 10 then abs(avg(ok) - avg(c)) else 0 end from b group by half)
select bins, sum(k)::bigint as n, round(sum(k * g) / sum(k), 6) as ece from x group by bins""",
    "answer_concentration": f"""with {_RECORDS}, f as (select {_clean("hard_label.answer")} as a, count(*) as n from records group by all)
select sum(n)::bigint as n, count(*) as distinct_values, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 6) as entropy, round(max(n) / sum(n), 6) as top_share, round(1 - count(*) / sum(n), 6) as repetition from f""",
    "top_answers": f"with {_RECORDS} select {_clean('hard_label.answer')} as value, count(*) as n from records group by all order by n desc, value limit 20",
    "repeated_paragraphs": f"with {_RECORDS} select cot_reasoning.reasoning_paragraph as value, count(*) as n from records where cot_reasoning.reasoning_paragraph is not null group by all order by n desc, value limit 5",
    "reasoning_lengths": f"with {_RECORDS}, t as (select source, length(cot_reasoning.reasoning_paragraph) as n from records) select source, count(*) as texts, round(avg(n), 6) as mean, min(n) as least, max(n) as greatest, count(*) filter (where n < 20) as short, count(*) filter (where n > 500) as long from t where n is not null group by source",
    "task_confidence": f"with {_SAMPLES} select task, count(*) as tasks, round(avg(t.hard_label.confidence), 6) as mean, round(avg(coalesce(len(list_filter(map_entries(t.soft_label.answer_distribution), lambda e: e.value > 0)), 0)), 6) as tokens from tasks group by task",
    "sample_completeness": f"with {_SAMPLES} " + " union all ".join(f"select '{f}' as field, count(*) as rows, count(t.{f}) as held, round(count(t.{f}) / count(*), 6) as share from tasks" for f in ("question", "ground_truth", "hard_label.answer", "hard_label.confidence", "soft_label.answer_distribution", "cot_reasoning.reasoning_paragraph", "candidate_pool")),
    "quality_buckets": f"with {_SAMPLES} select case when quality_score.final_score is null then 'unscored' when quality_score.final_score >= 70 then 'high' when quality_score.final_score >= 40 then 'middle' else 'low' end as bucket, count(*) as samples, round(avg(quality_score.final_score), 6) as mean, sum(coalesce(len(quality_score.issues), 0))::bigint as issues from samples group by 1",
    "issue_counts": f"with {_SAMPLES} select issue, count(*) as samples from (select unnest(quality_score.issues) as issue from samples) group by issue",
    "evaluate_buckets": f"with {_RECORDS} select question_type, count(*) as records, round(avg(({_match('hard_label.answer')} = {_match('soft_label.primary_answer')})::int), 6) as soft_match, round(avg(({_match('hard_label.answer')} = {_match('cot_reasoning.answer')})::int), 6) as reasoning_match from records group by question_type",
    "category_alignment": f"""with {_RECORDS}, one as (select distinct image_id, id, category_id from instances), l as (select category_id, count(*) as seen from one group by 1), s as (select {_clean("hard_label.answer")} as name, count(*) as said from records group by 1),
j as (select coalesce(seen, 0) as seen, coalesce(said, 0) as said from categories c left join l on c.id = l.category_id left join s using (name))
select count(*) as categories, sum(seen)::bigint as seen, sum(said)::bigint as said, round(corr(seen, said), 6) as correlation from j""",
    "latest_rows": "select sample_id, epoch_us(max(received_at)) as received_us, count(*) as copies from merged_samples group by sample_id",
    "image_scores": f"with {_SCORES} select image_id, objects, category_score, text_score, scene_score, score from scored",
    "image_subset": f"with {_SCORES}, kept as (select image_id from scored where score >= 0.7) select image_id, id, category_id, row_number() over (order by image_id, id, category_id nulls first) as new_id from one where image_id in (select image_id from kept)",
    "image_sizes": "select case when width * height < 250000 then 'small' when width * height < 1000000 then 'medium' else 'large' end as size, count(*) as images, sum(width * height)::bigint as pixels from images where width > 0 and height > 0 group by 1",
    "image_scenes": f"with {_SCENES} select image_id, scene, objects from scenes",
    "scene_candidates": f"""with {_VOTE}, {_SCENES}, c as (select scene, answer, sum(votes)::bigint as votes from (select distinct * from vqa_questions) join voted using (question_id) join scenes using (image_id) where answer <> '' group by all)
select scene, answer, votes, row_number() over (partition by scene order by votes desc, answer) as rank from c qualify rank <= 20""",
    "answer_weights": f"with {_WEIGHTED} select answer, round(weight, 4) as weight, given from weighted where given >= 2",
    "vocabulary_coverage": f"with {_WEIGHTED}, k as (select sum(given) as covered from (select given from weighted order by weight desc, answer limit 100)) select count(*) as answers, sum(given)::bigint as given, any_value(covered)::bigint as covered, round(any_value(covered) / sum(given), 6) as coverage from weighted, k",
    "unseen_objects": f"""with {_RECORDS}, seen as (select distinct image_id, name from instances i join categories c on i.category_id = c.id),
said as (select source, try_cast(regexp_extract(image_id, '(\\d+)[^0-9]*$', 1) as bigint) as image_id, {_clean("hard_label.answer")} as name from records)
select source, count(*) as named, count(*) filter (where s.name is null) as unseen from said left join seen s using (image_id, name) where said.name in (select name from categories) group by source""",
    "images_of_all_tasks": "select image_id from (select image_id from vqa_questions union select image_id from instances) intersect select id from images",
    "sample_images": "select id, split from images order by md5('42:' || id), id limit 100",
    "sample_images_balanced": "select id, split from images qualify row_number() over (partition by split order by md5('42:' || id), id) <= 25",
    "sample_images_stratified": "select id, split from images qualify row_number() over (partition by split order by md5('42:' || id), id) <= floor(100 * count(*) over (partition by split) / count(*) over ())",
    "batch_statistics": "with r as (select *, (row_number() over (order by event_id) - 1) // 1000 as batch from events) select batch, count(*) as events, round(avg(value), 4) as mean, count(*) filter (where event_type = 'click') as clicks from r group by batch",
    "stream_daily_events": "select epoch_us(date_trunc('day', ts)) as day_us, event_type, count(*) as n, round(sum(value), 3) as total from events group by all",
    "label_similarity": """with cells as (select vec_id, label, unnest(embedding)::double as x, unnest(range(len(embedding))) as pos from embeddings), means as (select label, pos, avg(x) as m from cells group by all)
select vec_id, label, round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 5) as cosine from cells join means using (label, pos) group by vec_id, label""",
}
