"""Problem 10: one consistent form for texts that look the same.

Ignorable characters are deleted, spaces become plain blanks, compatibility forms of
Latin letters and digits become plain ones and combining marks are composed. Then each
word with Cyrillic or Greek letters is a lattice, every letter standing for itself or for
the Latin letter it looks like, and the Viterbi path under character-pair scores of the
scripts, with a price for changing script within a word, gives its letters. The pair
scores are fitted on the words of all texts: tasks count pairs of characters, their sums
(as many as there are pairs of letters of one script) come to the driver.

Kinds found in a text: 'form', 'accent', 'invisible', 'space', 'lookalike'. Composed
letters, Chinese punctuation, whole words in another script, raised digits, typographic
quotes, dots, emoji (with their joiners) and line breaks are left as they are.

Defined results: a null text stays null without kinds; an empty text stays empty; whole
texts are read; rows are kept as they are, repeated ones included.
"""

from __future__ import annotations

import math
import pickle
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm.words import pieces
from lumisift.runtime import spread

#: Different words a task holds before their pairs are counted.
HELD_WORDS = 200_000
SWITCH = -9.0
KINDS = ("form", "accent", "invisible", "space", "lookalike")
#: Letters of other scripts and the Latin letters they look like.
CYRILLIC = dict(zip("аеорсухѕіјһԁԛԝӏкАВЕКМНОРСТУХЅІЈҮ", "aeopcyxsijhdqwlkABEKMHOPCTYXSIJY"))
GREEK = dict(zip("αγειικνορτυωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ayeiikvoptuwABEZHIKMNOPTYX"))
LOOKALIKE = CYRILLIC | GREEK
_FORM_TAGS = ("<wide>", "<font>", "<circle>", "<narrow>")


def _classes() -> tuple[dict[int, str], str, str]:
    forms, marks, ignorable = {}, [], []
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        category = unicodedata.category(c)
        if category in ("Cn", "Co", "Cs"):
            continue
        if category == "Mn" and not 0xFE00 <= code <= 0xFE0F and not 0xE0100 <= code <= 0xE01EF:
            marks.append(c)
        elif category == "Cf" and not 0xE0000 <= code <= 0xE007F and not 0x600 <= code <= 0x6FF:
            ignorable.append(c)
        elif unicodedata.decomposition(c).startswith(_FORM_TAGS) or 0xFB00 <= code <= 0xFB06:
            plain = unicodedata.normalize("NFKC", c)
            if plain.isascii() and plain.isalnum():
                forms[code] = plain
    return forms, "".join(marks), "".join(ignorable)


FORMS, _MARKS, _IGNORABLE = _classes()
_FORMED = frozenset(map(chr, FORMS))
_MARKED = frozenset(_MARKS)
_IGNORED = frozenset(_IGNORABLE)
_JOINER = "\u200d"
_EMOJI = "\u2190-\u2bff\ufe0f\U0001f000-\U0001faff"
#: A joiner that doesn't join emoji.
_LOOSE_JOINER = re.compile(f"(?<![{_EMOJI}]){_JOINER}|{_JOINER}(?![{_EMOJI}])")
_DELETED = {ord(c): None for c in _IGNORABLE if c != _JOINER}
_SPACES = {c: " " for c in (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)}
_SPACED = frozenset(map(chr, _SPACES))
#: A mark on a letter of a script whose letters have composed forms; vowel signs of other scripts are spelling.
_ACCENTED = re.compile(f"[A-Za-z\u00c0-\u024f\u0370-\u052f\u1e00-\u1fff][{_MARKS}]")
_OTHER = re.compile("[Ͱ-ϿЀ-ԯ]")
_WORD = re.compile(r"[^\W\d_]*[Ͱ-ϿЀ-ԯ][^\W\d_]*")
_LETTERS = re.compile(r"[^\W\d_]+")


def script_of(c: str) -> str:
    if "Ͱ" <= c <= "Ͽ":
        return "greek"
    if "Ѐ" <= c <= "ԯ":
        return "cyrillic"
    return "latin" if c < "ɐ" or "Ḁ" <= c <= "ỿ" else "other"


class PairScores:
    """Log-probabilities of a letter after another, by script; word edges count as a letter."""

    def __init__(self) -> None:
        self.pairs: Counter[str] = Counter()
        self.firsts: Counter[str] = Counter()

    def fit(self, texts: list[str]) -> PairScores:
        return self.add(Counter(w for t in texts for w in _LETTERS.findall(t)))

    def add(self, words: Counter[str]) -> PairScores:
        for word, n in words.items():
            if word.isascii() or (len({script_of(c) for c in word}) == 1 and script_of(word[0]) != "other"):
                edged = f"^{word}$"
                for a, b in zip(edged, edged[1:]):
                    self.pairs[a + b] += n
                    self.firsts[a] += n
        return self

    def score(self, a: str, b: str) -> float:
        price = SWITCH if a != "^" and b != "$" and script_of(a) != script_of(b) else 0.0
        return math.log((self.pairs[a + b] + 0.1) / (self.firsts[a] + 8.0)) + price

    def best(self, word: str) -> str:
        """The Viterbi path through a word's lattice of letters."""
        paths = {"^": (0.0, "")}
        for c in word:
            options = (c, LOOKALIKE[c]) if c in LOOKALIKE else (c,)
            paths = {o: max((s + self.score(last, o), p + o) for last, (s, p) in paths.items()) for o in options}
        return max((s + self.score(last, "$"), p) for last, (s, p) in paths.items())[1]


class Consistent:
    """Brings texts to their consistent form and names what was found; words decided once are remembered, up to a bound."""

    def __init__(self, scores: PairScores) -> None:
        self.scores, self.memo = scores, {}

    def _word(self, word: str) -> str:
        if word not in self.memo:
            if len(self.memo) > 100_000:
                self.memo.clear()
            mixed = any(script_of(c) == "latin" for c in word)
            self.memo[word] = self.scores.best(word) if mixed or all(c in LOOKALIKE for c in word) else word
        return self.memo[word]

    def __call__(self, text: str) -> tuple[str, list[str]]:
        if text.isascii():
            return text, []
        kinds = []
        signs, out = set(text), text
        if not signs.isdisjoint(_IGNORED):
            out = out.translate(_DELETED)
            if _JOINER in signs:
                out = _LOOSE_JOINER.sub("", out)
            if out != text:
                kinds.append("invisible")
        if not signs.isdisjoint(_SPACED):
            kinds.append("space")
            out = out.translate(_SPACES)
        if not signs.isdisjoint(_FORMED):
            kinds.append("form")
            out = out.translate(FORMS)
        if not signs.isdisjoint(_MARKED):
            composed = unicodedata.normalize("NFC", out)
            if composed != out or _ACCENTED.search(out):
                kinds.append("accent")
            out = composed
        if _OTHER.search(out):
            before = out
            out = _WORD.sub(lambda m: self._word(m[0]), before)
            if out != before and any(a != b and any(script_of(c) == "latin" for c in a) for a, b in zip(_LETTERS.findall(before), _LETTERS.findall(out))):
                kinds.append("lookalike")
        return out, kinds


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of the words of all texts of a task."""
    counts, words = PairScores(), Counter()
    for big in batches:
        for batch in pieces(big, [0]):
            for text in batch.column(0).to_pylist():
                words.update(_LETTERS.findall(text))
            if len(words) > HELD_WORDS:
                counts.add(words)
                words.clear()
    pairs = counts.add(words).pairs
    yield pa.RecordBatch.from_arrays([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])


def fitted(df: DataFrame, id_col: str, text_col: str) -> PairScores:
    """Pair scores of all texts, those of repeated rows and of null ids included (``id_col`` takes no part)."""
    texts = spread(df.select(F.col(text_col).alias("text"))).where("text <> ''")
    scores = PairScores()
    for pair, n in texts.mapInArrow(_counted, "pair string, n long").groupBy("pair").agg(F.sum("n")).collect():  # bounded by the letters of a script
        scores.pairs[pair] = n
        scores.firsts[pair[0]] += n
    return scores


_FOUND = pa.schema([("id", pa.int64()), ("text", pa.string()), ("kinds", pa.list_(pa.string()))])


def _normalised(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        consistent = Consistent(pickle.loads(packed))  # noqa: S301 - made by consistent_texts()
        for batch in batches:
            done = [(None, []) if t is None else consistent(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.list_(pa.string()))], schema=_FOUND)

    return run


def consistent_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scores: PairScores | None = None) -> DataFrame:
    """(id, text, kinds): every text in its consistent form, and what was found in it."""
    packed = pickle.dumps(scores or fitted(df, id_col, text_col))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return spread(rows).mapInArrow(_normalised(packed), "id long, text string, kinds array<string>")
