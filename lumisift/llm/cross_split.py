"""Problem 4: records of the evaluation splits that also occur, exactly or almost, in train.

Questions become vectors of idf-weighted content words (labels, fillers and function
words removed, misspelled words corrected). A word is known if it is in a small share of
all questions, in ``REAL_LEAST`` of the other texts of the records, or a listed name;
only words that aren't known are taken for misspelled ones, and only known words
correct them, so that of two rare words one letter apart neither becomes the other.
Questions of one image with the same content words form a class; one vector stands for all of it.
Classes of train and of evaluation are joined by weighted cosine: of each vector only
its heaviest terms are put into the inverted lists, up to the place from where both
the maximum-weight bound and the residual norm keep any dot product below the
threshold. Lists are keyed by (image, term), so a heavily annotated image is split by
its rarest terms, and a list that is still long by salts. Each candidate pair is seen once, at its first common term, gets its
exact dot product, and must name the same things in the same order.

Defined results: a null image number, a null question, a question without content
words, a null id or a null split matches nothing; repeated rows of a record count
once; ``train`` is the training split and every other value an evaluation split; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm.joins import salted_join
from lumisift.llm.key_map import KeyMap
from lumisift.llm.spelling import Corrector, one_edit
from lumisift.runtime import cut_lineage

THRESHOLD = 0.8
LEXICON_SHARE = 1e-4
LEXICON_LEAST = 5
#: Other texts in which a word stands that is no misspelling: their share, and their least number.
REAL_SHARE = 1e-6
REAL_LEAST = 2
#: Words that carry no content, by kind.
LABELS = frozenset("q question frage pregunta".split())
FILLERS = frozenset("please so just actually exactly well now okay ok kindly really hey hmm then".split())
FUNCTION_WORDS = frozenset("a an the any some is are s do does der die das den dem ein eine einen le la les l un une el los las una".split())
VARIANTS = {"colour": "color", "colours": "colors", "grey": "gray", "centre": "center", "kerb": "curb", "tyre": "tire"}
_DROPPED = LABELS | FILLERS | FUNCTION_WORDS
_TOKEN = re.compile(r"\d+(?:-\d+)+|[^\W_]+")
_NUMBERED = re.compile(r"^\W*\d{1,2}[).]\s")
_COUNTED = "term string, n long"
_CLASSED = "id long, image long, train boolean, key string"
_POSTED = "image long, term string, train boolean, key string"
_PAIRED = "image long, key_train string, key_eval string, cosine double"


def image_number(value: Column) -> Column:
    """The number of an image in any of its spellings: the last run of digits before an extension."""
    return F.regexp_extract(value.cast("string"), r"(\d+)[^0-9]*$", 1).try_cast("long")


def tokens(question: str) -> list[str]:
    """All words of a question, lower case, leading list numbers removed."""
    return [VARIANTS.get(t, t) for t in _TOKEN.findall(_NUMBERED.sub(" ", question.lower()))]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter(t for q in batch.column(0).to_pylist() for t in set(tokens(q)))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])


def lexicon(counts: DataFrame, total: int, share: float = LEXICON_SHARE, least: int = LEXICON_LEAST) -> dict[str, int]:
    """The questions of each term (term, n) that is in at least ``share`` of ``total`` (and ``least``).

    At most 1 / share times the words of a mean question reach the driver, whatever the corpus.
    """
    return {r["term"]: r["n"] for r in counts.where(F.col("n") >= max(least, share * total)).collect()}


def _words_in(known: KeyMap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                counts.update(_TOKEN.findall(text.lower()))
            words = list(counts)
            hashes = np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "replace"), 42) for w in words], np.uint64)
            kept = np.flatnonzero(known(hashes)) if words else []
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in kept], pa.string()), pa.array([counts[words[i]] for i in kept], pa.int64())], names=["term", "n"])

    return run


def real_words(counts: DataFrame, texts: DataFrame | None, names: DataFrame | None) -> dict[str, int]:
    """The terms of ``counts`` that are in at least ``REAL_SHARE`` of ``texts``, and ``REAL_LEAST`` times, or in ``names``, with their counts in questions.

    At most 1 / share times the words of a mean text reach the driver, and words of names that are in questions.
    """
    asked = counts.where(F.col("term").rlike(r"^\p{L}+$"))
    known = KeyMap.of(asked.select(F.xxhash64("term").alias("h")))
    seen = []
    if texts is not None:
        held = texts.where("text is not null")
        found = held.mapInArrow(_words_in(known), _COUNTED).groupBy("term").agg(F.sum("n").alias("k"))
        seen.append(found.where(F.col("k") >= max(REAL_LEAST, REAL_SHARE * held.count())).select("term"))
    if names is not None:
        seen.append(names.where("text is not null").mapInArrow(_words_in(known), _COUNTED).select("term"))
    return {r["term"]: r["n"] for s in seen for r in asked.join(s.distinct(), "term").collect()}


def _classes(words: dict[str, int]):
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corrected, memo = Corrector(words, _DROPPED), {}
        for batch in batches:
            keys = []
            for q in batch.column(3).to_pylist():
                if q not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    memo[q] = " ".join(t for t in map(corrected, tokens(q)) if t not in _DROPPED) or None
                keys.append(memo[q])
            out = pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(keys, pa.string())], names=["id", "image", "train", "key"])
            yield out.filter(pa.array([k is not None for k in keys]))

    return classes


class Weights:
    """Unit vectors of content words by idf, and the order in which terms are indexed."""

    def __init__(self, total: int, words: dict[str, int], most: dict[str, float] | None = None) -> None:
        self.total, self.words, self.most = max(total, 1), words, most or {}

    def idf(self, term: str) -> float:
        return math.log1p(self.total / self.words.get(term, 1))

    def vector(self, key: str) -> list[tuple[str, float]]:
        """(term, weight) of the unit vector, heaviest idf first; ties by term."""
        counts = Counter(key.split(" "))
        raw = sorted(((self.idf(t), t, n) for t, n in counts.items()), key=lambda x: (-x[0], x[1]))
        norm = math.sqrt(sum((w * n) ** 2 for w, _, n in raw)) or 1.0
        return [(t, w * n / norm) for w, t, n in raw]

    def indexed(self, key: str, threshold: float) -> list[str]:
        """The terms to index: as long as the rest could still reach the threshold."""
        vector = self.vector(key)
        residual = sum(w * w for _, w in vector)
        bound = sum(w * self.most.get(t, 1.0) for t, w in vector)
        out = []
        for t, w in vector:
            if min(math.sqrt(max(residual, 0.0)), bound) < threshold - 1e-9:
                break
            out.append(t)
            residual -= w * w
            bound -= w * self.most.get(t, 1.0)
        return out


def _heaviest(weights: Weights):
    def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[str, float] = {}
        for batch in batches:
            for key in batch.column(0).to_pylist():
                for t, w in weights.vector(key):
                    if t in weights.words and w > most.get(t, 0.0):
                        most[t] = w
        yield pa.RecordBatch.from_arrays([pa.array(list(most), pa.string()), pa.array(list(most.values()), pa.float64())], names=["term", "w"])

    return heaviest


def _postings(weights: Weights, threshold: float):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for image, key, train in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for term in weights.indexed(key, threshold):
                    for column, value in zip(columns, (image, term, train, key)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.bool_(), pa.string()))], names=["image", "term", "train", "key"])

    return postings


def same_request(a: str, b: str, words: dict[str, int]) -> bool:
    """Whether two keys name the same things in the same order; a word may differ from another by one edit if either isn't known and neither holds digits."""
    x, y = a.split(" "), b.split(" ")
    return len(x) == len(y) and all(
        s == t or ((s not in words or t not in words) and min(len(s), len(t)) > 3 and s.isalpha() and t.isalpha() and one_edit(s, t)) for s, t in zip(x, y)
    )


def _verify(weights: Weights, threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [])
            for image, term, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = weights.vector(a), dict(weights.vector(b))
                if next(t for t, _ in x if t in y) != term:
                    continue  # the pair is seen at its first common term
                cosine = sum(w * y.get(t, 0.0) for t, w in x)
                if cosine >= threshold - 1e-9 and same_request(a, b, weights.words):
                    for column, value in zip(columns, (image, a, b, min(cosine, 1.0))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.float64()))], names=["image", "key_train", "key_eval", "cosine"])

    return verify


def overlaps(df: DataFrame, id_col: str = "record_id", image_col: str = "image_id", question_col: str = "question", split_col: str = "split", threshold: float = THRESHOLD, texts: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """(train_id, eval_id, image, cosine): every pair of a train and an evaluation record of one image with (almost) the same question.

    ``texts`` and ``names`` have one column, text: other texts of the records, and names of things asked about.
    """
    image = image_number(F.col(image_col))
    rows = df.select(F.col(id_col).cast("long").alias("id"), image.alias("image"), (F.col(split_col) == "train").alias("train"), F.col(question_col).alias("question")).dropna()
    counts = cut_lineage(rows.select("question").mapInArrow(_count_terms, _COUNTED).groupBy("term").agg(F.sum("n").alias("n")))
    total = rows.count()
    frequent = lexicon(counts, total)
    words = frequent | real_words(counts, texts, names)
    members = cut_lineage(rows.mapInArrow(_classes(words), _CLASSED).distinct())
    classes = members.groupBy("image", "key").agg(F.bool_or("train").alias("t"), F.bool_or(~F.col("train")).alias("e"))
    plain = Weights(total, words)
    found = members.select("key").mapInArrow(_heaviest(plain), "term string, w double").groupBy("term").agg(F.max("w").alias("w"))  # known terms only
    weights = Weights(total, words, {r["term"]: r["w"] for r in found.collect()})
    sides = classes.select("image", "key", F.explode(F.array_compact(F.array(F.when(F.col("t"), True), F.when(F.col("e"), False)))).alias("train"))
    posted = cut_lineage(sides.mapInArrow(_postings(weights, threshold), _POSTED))
    left = posted.where("train").select("image", "term", F.col("key").alias("key_train"))
    right = posted.where("not train").select("image", "term", F.col("key").alias("key_eval"))
    candidates = salted_join(right, left, ["image", "term"], "key_train").select("image", "term", "key_train", "key_eval")
    pairs = candidates.mapInArrow(_verify(weights, threshold), _PAIRED)
    of_train = members.where("train").select("image", F.col("key").alias("key_train"), F.col("id").alias("train_id"))
    of_eval = members.where("not train").select("image", F.col("key").alias("key_eval"), F.col("id").alias("eval_id"))
    joined = pairs.join(of_eval, ["image", "key_eval"]).join(of_train, ["image", "key_train"])
    return joined.where("train_id <> eval_id").select("train_id", "eval_id", "image", "cosine")


def totals(df: DataFrame, pairs: DataFrame, id_col: str = "record_id", split_col: str = "split", source_col: str = "source") -> DataFrame:
    """(split, source, records, overlapping, pairs) of the evaluation records: how many there are, how many overlap with train and in how many pairs."""
    held = df.where(F.col(split_col) != "train").select(F.col(id_col).alias("eval_id"), F.col(split_col).alias("split"), F.col(source_col).alias("source")).dropDuplicates(["eval_id"])
    per_record = pairs.groupBy("eval_id").agg(F.count("*").alias("n"))
    joined = held.join(per_record, "eval_id", "left")
    return joined.groupBy("split", "source").agg(F.count("*").alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
