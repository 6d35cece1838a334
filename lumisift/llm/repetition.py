"""Problem 7: repetition within a single text, by tokeniser fertility.

The words of every text are tokenised with two public vocabularies (words are coded once
a batch, so each distinct word is tokenised once), which gives characters per token, the
share of byte-fallback tokens and the entropy of the token distribution. Rejection bands of
these measures are fitted per script on all texts, by exact percentiles: what lies outside
the central share of them is marked.

For the defect searched a band is known exactly, under each vocabulary and in each script:
of w words a share r is repeated, all their tokens occurred before, so of n tokens at most
n - ceil(r * w) are different ones, and the entropy of order zero (the logarithm of that
number), which no entropy exceeds, lies below its logarithm. A text above that under either
vocabulary can't be a case. Texts within get the exact share of repeated words by word
windows: fertility can't tell five equal words in a row from equal words apart.

Defined results: a null, blank or word-less text has no measures (nulls, share 0); a
text with fewer than ``window`` + 1 words has share 0; letter case is ignored; whole
texts are read, however long. Repeated rows of a record count once.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumisift.llm.words import Coded, mix, pieces, windows
from lumisift.runtime import spread, stored

TOKENIZER_DIR = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"
WINDOW = 5
SHARE = 0.3
RANKS = "byte_bpe_multi_50k.tiktoken"
#: The share of texts outside a band at either end.
OUTSIDE = 0.01
#: Slices of one that values are counted by before those near a percentile are ranked.
SLICES = 4096
_MEMO_MAX = 200_000
_MEASURES = "id long, field string, script string, words long, repeated_share double, tokens long, chars_per_token double, byte_share double, entropy double, within boolean"
_ARROW = pa.schema(
    [("id", pa.int64()), ("field", pa.string()), ("script", pa.string()), ("words", pa.int64()), ("repeated_share", pa.float64()), ("tokens", pa.int64()), ("chars_per_token", pa.float64()), ("byte_share", pa.float64()), ("entropy", pa.float64()), ("within", pa.bool_())]
)


class Fertility:
    """Token ids of words under one public vocabulary, with a bounded memory of words seen; ``is_byte`` tells fallback tokens."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], is_byte: np.ndarray) -> None:
        self.encode, self.is_byte = encode, is_byte
        self.memo: dict[str, list[int]] = {}

    @classmethod
    def of_pieces(cls, path: str) -> Fertility:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls(lambda words: model.encode(words, num_threads=1), np.array([model.is_byte(i) for i in range(model.get_piece_size())]))

    @classmethod
    def of_ranks(cls, path: str) -> Fertility:
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        return cls(lambda words: encoding.encode_ordinary_batch(words, num_threads=1), np.zeros(max(ranks.values()) + 1, bool))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in order, and where each word's tokens start."""
        if len(self.memo) > _MEMO_MAX:
            self.memo.clear()
        new = [w for w in words if w not in self.memo]
        self.memo.update(zip(new, self.encode(new) if new else []))
        held = [self.memo[w] for w in words]
        start = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(h) for h in held], out=start[1:])
        return np.fromiter((t for h in held for t in h), np.int64, int(start[-1])), start


def _sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, n)


def entropies(tokens: np.ndarray, owner: np.ndarray, n: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the entropy in bits of its token distribution and its number of distinct tokens."""
    key = np.sort(owner * vocabulary + tokens)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    counts = np.diff(np.r_[first, len(key)])
    text = key[first] // vocabulary
    total = np.bincount(owner, minlength=n)
    p = counts / total[text]
    return _sums(-p * np.log2(p), text, n), np.bincount(text, minlength=n)


def repeated_words(coded: Coded, which: np.ndarray, window: int) -> np.ndarray:
    """Of each text the number of words in a window that also starts earlier in it; only texts with ``which`` are searched."""
    n = len(coded.start) - 1
    h, at = windows(coded.codes, coded.start, window)
    owner = coded.owner
    keep = which[owner[at]] if len(at) else np.empty(0, bool)
    h, at = h[keep], at[keep]
    if not len(at):
        return np.zeros(n)
    again = at[pd.Series(h ^ mix(owner[at] + 7)).duplicated().to_numpy()]
    edge = np.zeros(len(coded.codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return _sums(np.cumsum(edge[:-1]) > 0, owner, n)


def _script(text: str | None) -> str | None:
    if not text:
        return None
    if text.isascii():
        return "latin"
    han = sum("㐀" <= c <= "鿿" for c in text)
    latin = sum(c < "ɐ" and c.isalpha() for c in text)
    return "han" if han > latin else "latin" if latin * 2 >= sum(c.isalpha() for c in text) else "other"


class Counted:
    """The tokens of many texts under one vocabulary: how many, how many different ones, their entropy."""

    def __init__(self, coded: Coded, fertility: Fertility) -> None:
        n = len(coded.start) - 1
        word_tokens, word_start = fertility.of(coded.words)
        lengths = np.diff(word_start)[coded.codes]
        ends = np.cumsum(lengths)
        self.tokens = word_tokens[np.arange(int(lengths.sum())) - np.repeat(ends - lengths, lengths) + np.repeat(word_start[coded.codes], lengths)]
        self.owner = np.repeat(coded.owner, lengths)
        self.n = np.bincount(self.owner, minlength=n)
        self.entropy, self.different = entropies(self.tokens, self.owner, n, len(fertility.is_byte))


def _measure(tokenizer_dir: str, fields: list[str], window: int, share: float, exact_all: bool, cases_only: bool):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Fertility] = []
        for big in batches:
            for batch in pieces(big, list(range(1, big.num_columns))):
                held = held or [Fertility.of_pieces(os.path.join(tokenizer_dir, PIECES)), Fertility.of_ranks(os.path.join(tokenizer_dir, RANKS))]
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                texts = [t for column in batch.columns[1:] for t in column.to_pylist()]
                n = len(texts)
                coded = Coded(texts)
                counted = [Counted(coded, fertility) for fertility in held]
                n_words = np.diff(coded.start)
                least = np.ceil(share * n_words - 1e-9)
                band = (n_words > window) & np.all([c.different <= c.n - least for c in counted], axis=0)
                repeated = repeated_words(coded, (n_words > 0) if exact_all else band, window)
                first = counted[0]
                with np.errstate(invalid="ignore", divide="ignore"):
                    shares = np.where(n_words > 0, repeated / np.maximum(n_words, 1), 0.0)
                    byte_share = _sums(held[0].is_byte[first.tokens], first.owner, n) / first.n
                    chars = _sums(np.array([len(w) for w in coded.words], np.int64)[coded.codes], coded.owner, n) / first.n
                keep = (shares >= share - 1e-12) & band if cases_only else np.ones(n, bool)
                empty = first.n == 0
                field = np.repeat(fields, len(batch))
                script = [_script(t) if k else None for t, k in zip(texts, keep)]
                arrays = [np.tile(ids, len(fields)), field, script, n_words, shares, first.n, chars, byte_share, first.entropy, band]
                columns = [pa.array(a, f.type, mask=(empty if f.name in ("chars_per_token", "byte_share", "entropy") else None), from_pandas=True) for a, f in zip(arrays, _ARROW)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW).filter(pa.array(keep))

    return measure


def measures(
    df: DataFrame, id_col: str, fields: list[str], tokenizer_dir: str = TOKENIZER_DIR, window: int = WINDOW, share: float = SHARE, cases_only: bool = False
) -> DataFrame:
    """One row a text (id, field) with its fertility measures, exact share of repeated words and whether it lies ``within`` the band of the defect; with ``cases_only`` the rows within whose share reaches ``share``."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), *(F.col(f).alias(f"text_{i}") for i, f in enumerate(fields)))
    return spread(rows).mapInArrow(_measure(tokenizer_dir, fields, window, share, not cases_only, cases_only), _MEASURES)


def measured_once(df: DataFrame, id_col: str, fields: list[str], tokenizer_dir: str = TOKENIZER_DIR) -> DataFrame:
    """:func:`measures` of all texts, those of repeated rows once, stored for fitting and marking."""
    return stored(measures(df, id_col, fields, tokenizer_dir).distinct(), "fertility")


def fitted_bands(df: DataFrame, id_col: str, fields: list[str], tokenizer_dir: str = TOKENIZER_DIR, outside: float = OUTSIDE) -> DataFrame:
    """:func:`bands_of` all texts of a table."""
    return bands_of(measured_once(df, id_col, fields, tokenizer_dir), outside)


def bands_of(measured: DataFrame, outside: float = OUTSIDE) -> DataFrame:
    """(script, chars_low, chars_high, byte_high, flat_low): of each script the bands that hold all but ``outside`` of the texts of more than one token at either end; one row a script."""
    low, high = outside, 1 - outside
    values = measured.where("tokens > 1").withColumn("flat", _flatness())
    return percentiles(values, "script", {"chars_low": ("chars_per_token", low), "chars_high": ("chars_per_token", high), "byte_high": ("byte_share", high), "flat_low": ("flat", low)})


def percentiles(df: DataFrame, by: str, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """Exact percentiles (as ``percentile``, which would hold all different values of a group in one task) of non-negative columns: name to column and share; one row a group.

    Values are counted by slices of their range first. Only those in the slices that hold a
    rank asked for are then ranked.
    """
    columns = sorted({c for c, _ in wanted.values()})
    values = df.select(F.col(by).alias("owner"), F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in columns))).alias("v"))
    values = values.select("owner", "v.*").withColumn("slice", F.floor(F.col("value") * SLICES))
    group = Window.partitionBy("owner", "measure")
    counts = values.groupBy("owner", "measure", "slice").agg(F.count("value").alias("n"))  # of nulls 0
    upto = counts.withColumn("upto", F.sum("n").over(group.orderBy("slice"))).withColumn("total", F.sum("n").over(group))
    named = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(c).alias("of"), F.lit(float(p)).alias("p")) for name, (c, p) in wanted.items()))
    asked = upto.withColumn("w", F.explode(named)).where("w.of = measure").withColumn("place", F.col("w.p") * F.greatest(F.col("total") - 1, F.lit(0)))
    asked = asked.where("total = 0 or n > 0 and floor(place) < upto and ceil(place) >= upto - n")
    asked = asked.select(F.col("owner").alias("g"), F.col("measure").alias("of"), F.col("slice").alias("s"), "w.name", "place", (F.col("upto") - F.col("n")).alias("before"))
    same = F.col("owner").eqNullSafe(F.col("g")) & (F.col("measure") == F.col("of")) & F.col("slice").eqNullSafe(F.col("s"))
    near = values.join(F.broadcast(asked), same)  # one or two slices a group and name
    held = near.groupBy("g", "name", "s", "before", "place", "value").agg(F.count("value").alias("n"))
    ranked = held.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy("g", "name", "s").orderBy("value")))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("upto")) & (rank >= F.col("upto") - F.col("n")), F.col("value")))

    found = ranked.groupBy("g", "name").agg(F.max("place").alias("place"), at(F.floor("place")).alias("low"), at(F.ceil("place")).alias("high"))
    between = (F.ceil("place") - F.col("place")) * F.col("low") + (F.col("place") - F.floor("place")) * F.col("high")
    exact = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between)
    return found.groupBy(F.col("g").alias(by)).agg(*(F.max(F.when(F.col("name") == name, exact)).alias(name) for name in wanted))


def _flatness() -> Column:
    """The entropy as a share of the greatest that so many tokens can have."""
    return F.when(F.col("tokens") > 1, F.col("entropy") / F.log2("tokens"))


def banded(measured: DataFrame, bands: DataFrame) -> DataFrame:
    """Adds ``outside``: whether characters per token, byte share or entropy leave the bands of the text's script; null without tokens or bands."""
    joined = measured.join(F.broadcast(bands), "script", "left")  # one row a script
    out = ~F.col("chars_per_token").between(F.col("chars_low"), F.col("chars_high")) | (F.col("byte_share") > F.col("byte_high")) | F.coalesce(_flatness() < F.col("flat_low"), F.lit(False))
    return joined.withColumn("outside", out).select(*measured.columns, "outside")
