"""Problem 3: question and answer pairs whose answer doesn't properly reply.

The text apart from tags, headings and roles is its core. In this order a field is

* ``empty_answer``: null (answers only), blank, or nothing but placeholders and tags;
* ``refusal``: every sentence of the core refuses or is polite filler (refusal patterns
  of five languages);
* ``copies_question``: reasoning and answer each are empty or compress to almost nothing
  when the question is the zstandard dictionary, and their words are the question's,
  given once or more often;
* ``truncated_answer``: the text was cut (:mod:`lumisift.llm.truncation`);
* ``other_language``: at least half of the core's sentences are in another language than
  the question (a word-frequency model of five languages), short final answers aside.

The first three exclude each other and the rest; the last two can both hold. Short
answers (closed records) are never truncated or in another language. With a null
question only emptiness, refusal and truncation can be told. Repeated rows of a record
count once; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm import truncation
from lumisift.llm.languages import Languages
from lumisift.llm.replies import BULLET, LABEL, Reply, sentences
from lumisift.runtime import bounded_sample, cut_lineage, spread

EMPTY, REFUSAL, COPY, TRUNCATED, LANGUAGE = "empty_answer", "refusal", "copies_question", "truncated_answer", "other_language"
FIT_RECORDS = 8_000
COPY_COST = 0.3
#: Texts that stand for no answer.
PLACEHOLDERS = frozenset("n/a na nan none null nil empty <empty> unknown undefined tbd todo - -- . .. ... … ? ?? _".split()) | {"no answer", "not available"}
#: Patterns of sentences that decline to answer, by language.
REFUSALS = (
    r"\b(?:i|we)(?:'m| am| are)? (?:very )?(?:sorry|afraid)\b.*\b(?:can't|cannot|can not|unable|not able|won't|couldn't)\b",
    r"\b(?:i|we) (?:can't|cannot|can not|could not|couldn't|won't|will not|must decline|decline|refuse|am unable|am not able|'m unable|'m not able|prefer not|would rather not|do not have access|don't have access|have to (?:pass|decline))\b",
    r"\b(?:i'm|i am) (?:unable|not able|not allowed|not permitted)\b",
    r"^sorry\b.*\b(?:can't|cannot|can not|unable|won't)\b",
    r"\bas an ai\b",
    r"^(?:hmm\W+)?cannot (?:comply|answer|help|assist)\b",
    r"\bno (?:answer|reply) can be (?:given|provided)\b",
    r"\bagainst my (?:guidelines|rules|policy|policies)\b",
    r"\bnot possible for me to\b",
    r"\bmy apologies\b",
    r"\bich (?:darf|kann|möchte|muss)\b.*\b(?:keine|nicht|ablehnen)\b",
    r"\bkann ich\b.*\bnicht\b",
    r"\b(?:es )?tut mir leid\b",
    r"\bje (?:suis désolé|refuse|regrette)\b",
    r"\bje ne (?:peux|puis|veux|souhaite) pas\b",
    r"\b(?:lo siento|debo rechazar|no puedo (?:ayudar|responder|contestar|describir|ver))\b",
    r"抱歉|对不起|(?:无法|不能)(?:回答|提供|帮助|描述)|我拒绝",
)
#: Sentences that may go along with a refusal.
POLITE = (r"^hmm\b", r"^please ask\b", r"^unfortunately\W*$", r"^sorry\W*$")
#: One of these is in every text that a refusal pattern fits.
_TRIGGERS = ("can't", "cannot", "can not", "could not", "couldn't", "won't", "will not", "unable", "not able", "declin", "refus", "not to answer", "rather not", "access", "have to pass", "not allowed", "not permitted", "as an ai", "no answer", "no reply", "guidelines", "rules", "policy", "policies", "not possible", "apologies", "keine", "nicht", "ablehnen", "leid", "désolé", "regrette", "peux pas", "puis pas", "veux pas", "souhaite pas", "lo siento", "rechazar", "no puedo", "抱歉", "对不起", "无法", "不能", "拒绝")
_REFUSES = re.compile("|".join(f"(?:{p})" for p in REFUSALS), re.I)
_POLITE = re.compile("|".join(f"(?:{p})" for p in POLITE), re.I)
_QUESTION_LABEL = re.compile(r"\b(?:question|q|frage|pregunta)\s*[:：]", re.I)
#: So many characters of a text tell most texts from a question without reading on.
_HEAD = 120
_LABEL_WORDS = frozenset(("question", "q", "frage", "pregunta"))
_WORDS = re.compile(r"[^\W_]+")
#: More letters than any placeholder has; bullets hold none.
_WORDED = re.compile(r"[^\W\d_](?:[\W\d_]*[^\W\d_]){20}")
_FOUND = "id long, field string, verdict string, running string, answer string"


def core_of(text: str) -> str:
    """A text without roles, tags, headings, bullets and JSON around it."""
    return Reply(text).core() if len(text) > 1 else text


def is_empty(text: str | None) -> bool:
    """Whether nothing is left of a text once placeholders, tags and headings are gone."""
    if text is None or not text.strip():
        return True
    if text.strip().lower() in PLACEHOLDERS:
        return True
    if len(text) > 64 and not text.lstrip().startswith("{") and _WORDED.search(LABEL.sub(" ", text[:200])):
        return False
    core = core_of(text)
    return core.strip().lower() in PLACEHOLDERS or not any(map(str.isalnum, core))


def is_refusal(core: str) -> bool:
    """Whether all sentences of a core decline to answer or are polite filler, and one declines."""
    if not may_refuse(core):
        return False
    declines = False
    for sentence in sentences(core):
        held = sentence.replace("’", "'")
        if _REFUSES.search(held):
            declines = True
        elif not _POLITE.search(held):
            return False
    return declines


def may_refuse(text: str) -> bool:
    """Whether a text holds a word that is in every refusal."""
    low = text.lower().replace("’", "'")
    return any(t in low for t in _TRIGGERS)


class Copies:
    """Tells copies of a question by what a text costs once the question is the compressor's dictionary."""

    def __init__(self) -> None:
        import zstandard

        self.zstd = zstandard
        params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.params = params
        self.memo: dict[str, tuple[list[str], frozenset[str]]] = {}
        self.frame = len(zstandard.ZstdCompressor(compression_params=params).compress(b""))

    def cost(self, text: str, question: str) -> float:
        """Compressed bytes per byte of a text, given the question."""
        held = self.zstd.ZstdCompressionDict(question.encode("utf-8", "replace"), dict_type=self.zstd.DICT_TYPE_RAWCONTENT)
        data = text.encode("utf-8", "replace")
        return (len(self.zstd.ZstdCompressor(compression_params=self.params, dict_data=held).compress(data)) - self.frame) / max(1, len(data))

    def asked(self, question: str) -> tuple[list[str], frozenset[str]]:
        """The words of a question, and they and the labels' as a set."""
        if question not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            words = _question_words(question)
            self.memo[question] = words, _LABEL_WORDS.union(words)
        return self.memo[question]

    def foreign(self, text: str, question: str) -> bool:
        """Whether the beginning of a text alone has too many words that aren't the question's.

        0.8 of all words in common leaves at most a quarter of the question's for others, in any stretch of a copy.
        """
        b, known = self.asked(question)
        return 4 * sum(not w.isdigit() for w in set(_WORDS.findall(text[:_HEAD].lower())[:-1]) - known) > len(set(b))

    def __call__(self, text: str, question: str) -> bool:
        """Whether a text is the question, given once or more often."""
        b, known = self.asked(question)
        if not b or len(text) + 1 < 1.6 * (len(known) - len(_LABEL_WORDS)) or self.foreign(text, question):
            return False  # so few letters can't be 0.8 of the question's words
        a = _question_words(BULLET.sub("", text))
        if a and a == b * (len(a) // len(b)):
            return True  # also where too short for a compressor to tell
        x, y = set(a), set(b)
        if not a or len(x & y) < 0.8 * len(x | y):
            return False
        copy, asked = " ".join(a), " ".join(b)
        return len(copy) >= 0.7 * len(asked) and self.cost(copy, asked) <= COPY_COST

    def whole(self, reply: Reply, question: str) -> bool:
        """Whether reasoning and answer of a text, where not empty, are copies each, or make up the question together."""
        if len(reply.reasoning) > 64 and self.foreign(reply.reasoning, question):
            return False
        parts = [p for p in (reply.reasoning, reply.answer) if p and not is_empty(p)]
        if not parts:
            return False
        return all(self(p, question) for p in parts) or len(parts) == 2 and not self.foreign(parts[0], question) and _question_words(reply.core()) == self.asked(question)[0]


def _question_words(text: str) -> list[str]:
    """The words of a text in lower case, without question labels."""
    return _WORDS.findall(_QUESTION_LABEL.sub(" ", text).lower())


def in_other_language(texts: list[str], question_language: str | None, languages: Languages) -> bool:
    """Whether at least half of the sentences are surely in another language than the question's."""
    if question_language is None:
        return False
    held = [languages.surely_other(s, question_language) for t in texts for s in sentences(t)]
    return bool(held) and 2 * sum(held) >= len(held)


def answered(answer: str | None) -> tuple[str | None, Reply | None]:
    """EMPTY or REFUSAL, or None and the answer taken apart."""
    if is_empty(answer):
        return EMPTY, None
    reply = Reply(answer)
    return (REFUSAL, None) if is_refusal(reply.core() if len(answer) > 1 else answer) else (None, reply)


def _defects(answer_field: str, raw_field: str, packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = pickle.loads(packed)  # noqa: S301 - made by defects()
        copies, asked_memo, answer_memo = Copies(), {}, {}
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])

            def put(rid: int | None, field: str, verdict: str, running: str | None = None, end: str | None = None, columns: tuple[list, ...] = columns) -> None:
                for column, value in zip(columns, (rid, field, verdict, running, end)):
                    column.append(value)

            for rid, question, answer, raw, paragraph, sibling, closed in zip(*(c.to_pylist() for c in batch.columns)):
                if question not in asked_memo:
                    if len(asked_memo) > 100_000:
                        asked_memo.clear()
                    asked_memo[question] = languages.of(question)
                asked = asked_memo[question]
                if answer not in answer_memo:
                    if len(answer_memo) > 100_000:
                        answer_memo.clear()
                    answer_memo[answer] = answered(answer)
                defect, taken = answer_memo[answer]
                if defect:
                    put(rid, answer_field, defect)
                else:
                    if question and copies.whole(taken, question):
                        put(rid, answer_field, COPY)
                    elif not closed:
                        if in_other_language([answer], asked, languages):
                            put(rid, answer_field, LANGUAGE)
                        verdict = truncation.judge(answer, sibling) if answer != sibling else truncation.WHOLE
                        if verdict == truncation.CUT:
                            put(rid, answer_field, TRUNCATED)
                        elif verdict == truncation.UNKNOWN:
                            put(rid, answer_field, verdict, truncation.without_ellipsis(answer)[0])
                if raw is None:
                    continue
                if len(raw) <= 64 and is_empty(raw):
                    put(rid, raw_field, EMPTY)
                    continue
                reply = Reply(raw)
                if reply.layout == "json" or not _WORDED.search(reply.reasoning):
                    core = reply.core()
                    if not any(map(str.isalnum, core)) or core.lower() in PLACEHOLDERS:
                        put(rid, raw_field, EMPTY)
                        continue
                if may_refuse(f"{reply.reasoning}\n{reply.answer or ''}") and is_refusal(reply.core()):
                    put(rid, raw_field, REFUSAL)
                    continue
                if question and copies.whole(reply, question):
                    put(rid, raw_field, COPY)
                    continue
                running = [reply.reasoning]
                if reply.answer and len(reply.answer) > 24 and not closed:
                    running.append(reply.answer)
                if in_other_language(running, asked, languages):
                    put(rid, raw_field, LANGUAGE)
                verdict, undecided = truncation.judge_reply(raw, paragraph, sibling, question, reply)
                if verdict == truncation.CUT:
                    put(rid, raw_field, TRUNCATED)
                elif verdict == truncation.UNKNOWN:
                    put(rid, raw_field, verdict, undecided, sibling or answer)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i else pa.int64()) for i, c in enumerate(columns)], names=["id", "field", "verdict", "running", "answer"])

    return run


def defects(df: DataFrame, id_col: str, question: str, answer: str, raw: str, paragraph: str, final_answer: str, closed: str) -> DataFrame:
    """(id, field, defect) of every defective answer and reply; ``closed`` is a SQL condition for records with short answers."""
    named = {"question": question, "label": answer, "raw": raw, "paragraph": paragraph, "sibling": final_answer}
    rows = spread(df.select(F.col(id_col).cast("long").alias("id"), *(F.col(c).alias(n) for n, c in named.items()), F.coalesce(F.expr(closed), F.lit(False)).alias("closed")))
    sample = bounded_sample(rows.select("id", "question", "raw"), "id", FIT_RECORDS, 5).collect()
    languages = Languages().fit([(r["question"], f"{r['question']} {BULLET.sub('', Reply(r['raw']).core())}") for r in sample if r["question"] and r["raw"]])
    found = cut_lineage(rows.mapInArrow(_defects(answer, raw, pickle.dumps(languages)), _FOUND).distinct())
    cut = truncation.settled(found.where(F.col("verdict") == truncation.UNKNOWN), truncation.texts_of(rows))
    known = found.where(F.col("verdict") != truncation.UNKNOWN).select("id", "field", F.col("verdict").alias("defect"))
    return known.unionByName(cut.select("id", "field", F.lit(TRUNCATED).alias("defect"))).distinct()
