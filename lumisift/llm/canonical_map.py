"""Problem 6: freely typed values to the entries of a reference list.

Each distinct typed value is brought to a plain form (case, punctuation, white space,
number form, plural, articles and hedging words removed) and looked up among the plain
forms of all entries and aliases; the rest is searched in a BK-tree under the
unrestricted Damerau-Levenshtein distance, which is a metric, so the triangle
inequality leaves out subtrees without losing an entry. Up to ``broadcast_max`` forms
the tree is built once and broadcast; of a longer list the forms, each with its entry, are
split into shards with a tree each, and the shards' winner of the lowest rank is kept.

Defined results: null and blank values give no row; a value equal to an entry gives no
row with ``inexact_only``; of several entries equally near the one that shares most
letters in place wins, then the lowest id; values with no entry get -1; an entry without
aliases, null aliases and an empty list are allowed.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm.spelling import BKTree
from lumisift.runtime import cut_lineage

UNMATCHED = -1
BROADCAST_MAX = 50_000
#: Values that meet a shard's tree in one group.
VALUES_HELD = 50_000
#: Words and phrases that only hedge or introduce an answer.
HEDGES = ("i think", "i guess", "i believe", "in total", "of them", "it is", "it s", "its", "this is", "that is", "there are", "there is", "looks like", "kind of", "sort of", "more or less")
HEDGE_WORDS = frozenset("maybe perhaps probably possibly likely about exactly roughly approximately around nearly almost partly mostly just only circa ca approx a an the answer final label".split())
PLACEHOLDERS = frozenset("nan null none na nil empty unknown undefined tbd todo".split())
IRREGULAR = {"children": "child", "policemen": "policeman", "people": "person", "persons": "person", "men": "man", "women": "woman", "leaves": "leaf"}
_HEDGES = re.compile(r"\b(?:" + "|".join(HEDGES) + r")\b")
_NUMBER = re.compile(r"^x?0*(\d+)(?: ?0+)?x?$")
_MAPPED = "id long, field string, typed string, answer_id long"


def plain_forms(value: str) -> list[list[str]]:
    """The words of a value without case and punctuation, first without hedges and articles, then with them."""
    text = unicodedata.normalize("NFKC", value).lower().replace("’", "'")
    text = re.sub(r"(?<=\d)[.,]0+\b", "", text)
    words = re.sub(r"[\W_]+", " ", text).strip()
    kept = [w for w in _HEDGES.sub(" ", words).split() if w not in HEDGE_WORDS]
    forms = [kept, words.split()]
    return [f for i, f in enumerate(forms) if f and f not in forms[:i]]


def _singulars(word: str) -> Iterator[str]:
    if word in IRREGULAR:
        yield IRREGULAR[word]
    if word.endswith("ies") and len(word) > 4:
        yield word[:-3] + "y"
    if word.endswith("es") and len(word) > 3:
        yield word[:-2]
    if word.endswith("s") and len(word) > 2:
        yield word[:-1]


def allowed_distance(form: str) -> int:
    """Edits allowed for a form: none up to two letters or with digits, one up to eleven letters, then two."""
    if len(form) < 3 or any(c.isdigit() for c in form):
        return 0
    return 1 if len(form) < 12 else 2


class Entries:
    """The plain forms of a reference list and their BK-tree."""

    def __init__(self, rows: list[tuple[int, str, list[str] | None]]) -> None:
        self.forms: dict[str, int] = {}
        for names in ((lambda a, _: [a]), (lambda _, b: b or [])):  # an entry's own name goes before aliases
            for entry_id, answer, aliases in sorted(rows, key=lambda r: r[0]):
                for name in names(answer, aliases):
                    for form in plain_forms(name or ""):
                        self.forms.setdefault("".join(form), entry_id)
        self.tree = BKTree(self.forms)
        self.memo: dict[str, tuple[int, int]] = {}

    @classmethod
    def of_forms(cls, forms: dict[str, int]) -> Entries:
        """The entries of plain forms whose owners are known."""
        made = cls([])
        made.forms, made.tree = forms, BKTree(forms)
        return made

    def _exact(self, tokens: list[str]) -> tuple[int, int] | None:
        """(rank of the lookup, entry id)."""
        joined = "".join(tokens)
        if joined in self.forms:
            return 0, self.forms[joined]
        if number := _NUMBER.match(" ".join(tokens)):
            return (1, self.forms[number[1]]) if number[1] in self.forms else None
        return next(((2 + i, self.forms[f]) for i, s in enumerate(_singulars(tokens[-1])) if (f := "".join(tokens[:-1]) + s) in self.forms), None)

    def _nearest(self, tokens: list[str]) -> tuple[float, int, int]:
        """(distance, letters in place as a negative number, entry id)."""
        best = (99, 0, UNMATCHED)
        joined = "".join(tokens)
        for form in (joined, *("".join(tokens[:-1]) + s for s in _singulars(tokens[-1]))):
            for d, found in self.tree.within(form, allowed_distance(form)):
                if d <= allowed_distance(found):
                    same = sum(x == y for x, y in zip(form, found))
                    best = min(best, (d + (form != joined) * 0.5, -same - (len(form) == len(found)), self.forms[found]))
        return best

    def match(self, value: str) -> tuple[float, float, int, int, int]:
        """(0 for a lookup or 1 for a search, its rank in three numbers, entry id), id -1 if the value as a whole is no entry; the lowest is the best."""
        if value not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[value] = self._match(plain_forms(value))
        return self.memo[value]

    def _match(self, forms: list[list[str]]) -> tuple[float, float, int, int, int]:
        for i, tokens in enumerate(forms):
            if tokens and (exact := self._exact(tokens)) is not None:
                return 0, i, exact[0], 0, exact[1]
        longest = max(map(len, self.forms), default=0) + 8
        near = [(1, d, i, same, found) for i, t in enumerate(forms) if len("".join(t)) <= longest and "".join(t) not in PLACEHOLDERS for d, same, found in [self._nearest(t)]]
        return min(near, default=(1, 99, 0, 0, UNMATCHED))


def _forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [("".join(form), kind, i) for i, answer, aliases in zip(*(c.to_pylist() for c in batch.columns)) for kind, names in enumerate(([answer], aliases or [])) for name in names for form in plain_forms(name or "")]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["form", "kind", "entry_id"])


def _mapper(held: Broadcast):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: Entries = held.value
        for batch in batches:
            ids = [entries.match(v)[-1] for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64())], names=["id", "field", "typed", "answer_id"])

    return mapped


def _sharded(typed: DataFrame, listed: DataFrame, shards: int) -> DataFrame:
    """The same over a list too long to send out: values meet each shard's tree in salted groups, then the nearest winner stays."""
    values = cut_lineage(typed.select("typed").distinct())
    salts = -(-max(1, values.count()) // VALUES_HELD)  # so that a group holds about so many values at most
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = values.withColumn("shard", upto(shards)).withColumn("salt", F.pmod(F.xxhash64("typed"), F.lit(salts)))
    owned = listed.mapInArrow(_forms_of, "form string, kind int, entry_id long").groupBy("form").agg(F.min(F.struct("kind", "entry_id"))["entry_id"].alias("entry_id"))
    right = owned.withColumn("shard", F.pmod(F.xxhash64("form"), F.lit(shards))).withColumn("salt", upto(salts))

    def winners(v: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        entries = Entries.of_forms(dict(zip(e["form"], e["entry_id"])))
        found = [entries.match(x) for x in v["typed"]]
        return pd.DataFrame({"typed": v["typed"], **{f"r{k}": [float(f[k]) for f in found] for k in range(4)}, "answer_id": [f[4] for f in found]})

    won = left.groupBy("shard", "salt").cogroup(right.groupBy("shard", "salt")).applyInPandas(winners, "typed string, r0 double, r1 double, r2 double, r3 double, answer_id long")
    best = won.where("answer_id >= 0").groupBy("typed").agg(F.min(F.struct("r0", "r1", "r2", "r3", "answer_id")).alias("best"))
    return typed.join(best, "typed", "left").select("id", "field", "typed", F.coalesce("best.answer_id", F.lit(UNMATCHED).cast("long")).alias("answer_id"))


def _held(name: str, values: Column) -> Column:
    return F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.struct(F.lit(name).alias("field"), v.alias("typed")))


def typed_values(df: DataFrame, id_col: str, fields: dict[str, Column], known: list[str] | None = None) -> DataFrame:
    """(id, field, typed) of every non-blank value; ``fields`` maps names to array<string> columns. Values in the list ``known`` are left out before they are spread."""
    held = [_held(name, values) for name, values in fields.items()]
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.explode(F.concat(*held)).alias("x")).select("id", "x.field", "x.typed")
    rows = rows.where(F.col("typed").rlike(r"(?U)\S"))
    if known:
        rows = rows.where(~F.col("typed").isin(known))
    return rows


def map_typed(df: DataFrame, id_col: str, fields: dict[str, Column], reference: DataFrame, inexact_only: bool = True, broadcast_max: int = BROADCAST_MAX) -> DataFrame:
    """(id, field, typed, answer_id) of every typed value; ``reference`` has answer_id, answer and aliases. With ``inexact_only`` values equal to an entry are left out."""
    listed = reference.select(F.col("answer_id").cast("long").alias("entry_id"), "answer", "aliases").where("entry_id is not null")
    size = listed.agg(F.sum(1 + F.coalesce(F.size("aliases"), F.lit(0))).alias("n")).first()["n"] or 0
    if size <= broadcast_max:
        rows = [tuple(r) for r in listed.collect()]
        typed = typed_values(df, id_col, fields, [r[1] for r in rows if r[1] is not None] if inexact_only else None)
        return typed.mapInArrow(_mapper(df.sparkSession.sparkContext.broadcast(Entries(rows))), _MAPPED).distinct()
    typed = typed_values(df, id_col, fields).distinct()
    if inexact_only:
        typed = typed.join(listed.select(F.col("answer").alias("typed")), "typed", "left_anti").select("id", "field", "typed")
    return _sharded(typed, listed, -(-size // broadcast_max))
