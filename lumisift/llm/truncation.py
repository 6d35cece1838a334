"""Problem 5: text values that were cut off, and how often each source cuts.

A text that doesn't end a sentence is a suspect: it was cut or only lacks its last
punctuation mark. It is decided by

1. the other text of its record, in which a cut paragraph or reply goes on;
2. near-copies in other records. A cut text is the beginning of its copy, so min-hash
   signatures (runs of five words, five bands of three) are made of the beginnings of all
   texts, at lengths that grow by half, and a suspect's is compared with those of its
   own length. A copy must hold at least 0.8 of the suspect's runs. The suspect's closing
   words are aligned with the copy: if the copy goes on within a word or sentence, the
   suspect was cut; if the copy ends the sentence there, it is whole;
3. without such a copy, by how often its closing words end a sentence: counts of up to
   four closing words, with back-off, over all texts. A closing word hardly ever seen
   within a text is a piece of one.

Bands and closing words of all texts come from one pass. It keeps only what a suspect asks
for, by a bit map of fixed size over the suspects' hashes; joins by the hashes then make it
exact. A text that ends in a broken character, or in the middle of a label or of JSON, was
cut.

Defined results: null, blank and word-less texts (an ellipsis alone) are no cases; whole
texts are read; repeated rows of a record count once (in the counts of closing words they
weigh twice); a null id is kept as null. Equal texts are one class; each class of suspects
is aligned with every class that shares a band with it, and of the copies that hold most of
it and least else the majority decides (cut if they are even). A copy that stops where the
suspect does shows nothing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm.joins import salted_join, small
from lumisift.llm.key_map import KeyMap
from lumisift.llm.replies import CLOSERS, LABEL, ROLE, TERMINAL, Reply, partial_label
from lumisift.llm.words import mix, pieces, windows
from lumisift.runtime import cut_lineage, spread, stored

LONGEST = 4
#: Shares of all words from which a word is known, a run of words is taken into account, and a word is common.
KNOWN, SEEN, COMMON = 4e-7, 1e-6, 0.004
#: The same as counts, for small corpora.
KNOWN_LEAST, SEEN_LEAST, COMMON_LEAST = 1, 3, 100
#: Most places within a text don't end a sentence, so even a low share of endings speaks for a whole text without its last mark.
END_LEAST = 0.05
BANDS, ROWS, SHINGLE, SIMILARITY = 5, 3, 5, 0.8
#: From so many runs on a copy at the similarity may lack one.
WHOLE_RUNS = 5
#: Runs of words held by a task.
HELD_RUNS = 500_000
WHOLE, CUT, UNKNOWN = "whole", "cut", "unknown"
#: A word, an ideograph, or the end of a sentence (with closing quotes before or after it).
_TOKEN = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+(?:['’-][^\W_㐀-鿿]+)*|[.!?。！？](?!\d)|[,;:，；：]")
#: The words among the tokens.
_SHINGLED = re.compile(r"[㐀-鿿]|[^\W_㐀-鿿]+(?:['’-][^\W_㐀-鿿]+)*")
_ENDS = frozenset(TERMINAL)
_PAUSES = frozenset(",;:，；：")


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def ends_sentence(text: str) -> bool:
    """Whether a text's last visible sign, closing quotes aside, ends a sentence."""
    t = text.rstrip()
    return bool(t) and (t[-1] in _ENDS or t.rstrip(CLOSERS + " ")[-1:] in _ENDS or t[-1] in "}")


def hash_word(word: str) -> int:
    """A hash of a word that is the same in every process."""
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))


def gram_hashes(h: np.ndarray, longest: int = LONGEST) -> list[np.ndarray]:
    """Of each place the hashes of the runs of one, two, ... words that end there; runs that start before the first word hash to anything."""
    out = [mix(h)]
    for k in range(1, longest):
        before = np.r_[h[:1].repeat(min(k, len(h))), h[:-k]] if len(h) else h
        with np.errstate(over="ignore"):
            out.append(mix(out[-1] * np.uint64(31) + before))
    return out


def context_hash(pair: np.ndarray) -> np.ndarray:
    """The hash of "anything after these two words"."""
    return mix(pair ^ np.uint64(0x5851F42D4C957F2D))


class Asked:
    """The hashes that tell whether a text's closing words end a sentence, and how; 0 where there is no such run."""

    def __init__(self, text: str, answer: str | None) -> None:
        held = tokens(text)
        self.held = held
        self.piece = len(held) > 1 and len(held[-1]) == 1 and held[-1].isascii() and held[-1].isalpha()
        last = np.array([hash_word(w) for w in held[-LONGEST:]], np.uint64)
        grams = [int(g[-1]) for g in gram_hashes(last)][: len(last)] if len(last) else []
        for k, token in enumerate(reversed(held[-LONGEST:])):
            if token in _ENDS:
                grams = grams[:k]
                break
        self.grams = grams
        self.before = int(mix(last[-2:-1])[0]) if len(held) > 1 else 0
        said = tokens(answer or "")
        self.context = 0
        if said and held[-len(said) :] == said and len(held) >= len(said) + 2:
            pair = np.array([hash_word(w) for w in held[-len(said) - 2 : -len(said)]], np.uint64)
            self.context = int(context_hash(gram_hashes(pair, 2)[1][-1:])[0])

    def keys(self) -> list[int]:
        return [k for k in (*self.grams, self.before, self.context) if k]

    def unfinished(self, counts: dict[int, tuple[int, int]], words: int) -> bool:
        """Whether the closing words rarely end a sentence; ``counts`` has (total, ends) of hashes, ``words`` is the number of all words."""
        known, seen, common = (max(least, share * words) for least, share in ((KNOWN_LEAST, KNOWN), (SEEN_LEAST, SEEN), (COMMON_LEAST, COMMON)))
        total, ends = counts.get(self.context, (0, 0)) if self.context else (0, 0)
        if total >= seen and ends > 0.25 * total:
            return False  # ends with the whole answer, where a sentence can end after an answer
        if not self.held or self.held[-1] in _PAUSES:
            return True
        pair = counts.get(self.grams[1], (0, 0))[0] if len(self.grams) > 1 else 0
        if len(self.held) > 1 and pair < seen and (counts.get(self.before, (0, 0))[0] >= common or self.piece):
            return True  # after so common a word all whole words are known, and so are words of one letter
        best = 0.0
        for k, gram in enumerate(self.grams):
            total, ends = counts.get(gram, (0, 0))
            if total < (seen if k else known):
                break
            best = (ends + 0.1) / (total + 2)
        return best < END_LEAST


def aligned(text: str, other: str) -> str:
    """WHOLE if ``other`` ends a sentence where ``text`` stops, CUT if it goes on there, else UNKNOWN."""
    mine, theirs = tokens(text), tokens(other)
    if not mine:
        return UNKNOWN
    last, context = mine[-1], mine[-7:-1]
    if last in _PAUSES:
        return CUT
    n, verdict, gap = len(context), UNKNOWN, 1 << 60
    least = min(2, n)
    while n >= least:
        for i in range(len(theirs) - n):
            if theirs[i : i + n] != context[len(context) - n :]:
                continue
            at = theirs[i + n]
            if at == last:
                after = theirs[i + n + 1] if i + n + 1 < len(theirs) else None
                found = UNKNOWN if after is None else WHOLE if after in _ENDS else CUT
            elif at.startswith(last) or last.startswith(at) and "'" in last:
                found = CUT
            else:
                continue
            away = abs(i + n - len(mine) + 1)
            if found != UNKNOWN and away < gap:
                verdict, gap = found, away
        if verdict != UNKNOWN or n == len(mine) - 1:
            return verdict
        n -= 2
    return verdict


def without_ellipsis(text: str) -> tuple[str, bool]:
    core = text.rstrip().rstrip("\"”")
    bare = core.removesuffix("…").removesuffix("...").removesuffix("..")
    return (bare.rstrip(), True) if bare != core else (text.rstrip(), False)


def opened(text: str) -> str:
    """A text without the role and the label in front of it."""
    bare = text.lstrip()
    if bare[:1] in "aAuUsS":
        bare = ROLE.sub("", bare, count=1).lstrip()
    label = LABEL.match(bare)
    return bare[label.end() :] if label else bare


def judge(text: str | None, sibling: str | None = None, sibling_ends: bool = False) -> str:
    """The verdict on running text from itself and its sibling; with ``sibling_ends`` the sibling's end is known to be the end of a sentence."""
    if not text or not text.strip():
        return WHOLE
    t, _ = without_ellipsis(text)
    if not any(c.isalnum() for c in t):
        return WHOLE
    if t.endswith("�"):
        return CUT
    if ends_sentence(t):
        return WHOLE
    return aligned(t, sibling + " ." if sibling_ends else sibling) if sibling else UNKNOWN


_BLANKS = re.compile(r"[\W_]+")


def _plain(text: str) -> str:
    return _BLANKS.sub(" ", text.lower()).strip()


def judge_reply(raw: str | None, paragraph: str | None, answer: str | None, question: str | None, reply: Reply | None = None) -> tuple[str, str]:
    """(verdict, the running text it depends on) of a whole reply, given the record's paragraph, final answer and question, and the reply taken apart, if it is."""
    if not raw or not raw.strip() or not any(c.isalnum() for c in raw):
        return WHOLE, ""
    reply = reply or Reply(raw)
    t, dotted = without_ellipsis(raw)
    if reply.broken or t.endswith("�"):
        return CUT, ""
    if reply.layout == "json":
        return WHOLE, ""
    if reply.answer is None:
        if not ends_sentence(t) and partial_label(t):
            return CUT, ""
        running = without_ellipsis(Reply(t).reasoning)[0]
        if question and _plain(running) == _plain(question):
            return WHOLE, ""
        return judge(running, paragraph), running
    said, _ = without_ellipsis(reply.answer)
    if not said:
        return (CUT if dotted else WHOLE), ""
    expected, got = _plain(answer or ""), _plain(said)
    if expected and expected != got and expected.startswith(got):
        return WHOLE if " " in got and ends_sentence(said) else CUT, said
    if not expected or expected == got or len(got.split()) < 5 and got.isascii():
        return (CUT if dotted and expected != got else WHOLE), said
    return judge(reply.answer, answer, True), said


def reply_text(raw: str | None) -> str | None:
    """The running reasoning of a reply, as the sibling of its paragraph: ended where its label or closing brace ends it."""
    if not raw:
        return None
    reply = Reply(raw)
    if reply.broken or reply.answer is None:
        return reply.reasoning
    return reply.reasoning.rstrip() + " ."


_JUDGED = "id long, field string, verdict string, running string, answer string"
_NAMES = ("id", "field", "verdict", "running", "answer")


def _judged(paragraph_field: str, raw_field: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for rid, paragraph, raw, answer, question, label in zip(*(batch.column(i).to_pylist() for i in range(6))):
                found = []
                if paragraph and not ends_sentence(paragraph) or paragraph and paragraph.rstrip().endswith(".."):
                    found.append((paragraph_field, judge(paragraph, reply_text(raw)), without_ellipsis(paragraph)[0]))
                if raw:
                    found.append((raw_field, *judge_reply(raw, paragraph, answer, question)))
                for field, verdict, running in found:
                    if verdict != WHOLE:
                        known = verdict != UNKNOWN
                        for column, value in zip(columns, (rid, field, verdict, None if known else running, None if known else answer or label)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 0 else pa.string()) for i, c in enumerate(columns)], names=_NAMES)

    return run


def grid(n: int) -> list[int]:
    """The lengths, in runs of words, at which beginnings are signed: up to ``n``, growing by half."""
    out, k = [], 1
    while k <= n:
        out.append(k)
        k = max(k + 1, k * 3 // 2)
    return out


def _coded(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(tokens, their codes, starts) of texts; a text that holds the one before it as it is, as replies hold their paragraphs, is read only around that."""
    book: dict[str, int] = defaultdict()
    book.default_factory = book.__len__
    code = book.__getitem__
    codes: list[int] = []
    start = np.zeros(len(texts) + 1, np.int64)
    before, held = "", 0
    for i, text in enumerate(texts):
        at = text.find(before) if text and len(before) > 40 else -1
        end = at + len(before)
        if at >= 0 and (at == 0 or text[at - 1].isspace()) and (end == len(text) or text[end].isspace()):
            known = codes[held:]
            held = len(codes)
            codes += map(code, tokens(text[:at]))
            codes += known
            codes += map(code, tokens(text[end:]))
        else:
            held = len(codes)
            if text:
                codes += map(code, tokens(text))
        start[i + 1] = len(codes)
        before = text or ""
    return list(book), np.array(codes, np.int64), start


class Words:
    """The tokens of many texts as hashes, with what their runs need."""

    def __init__(self, texts: list[str | None]) -> None:
        words, codes, self.start = _coded(texts)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.start))
        book = np.array([hash_word(w) for w in words], np.uint64)
        ends, pauses = (np.array([w in kind for w in words], bool) for kind in (_ENDS, _PAUSES))
        self.hash, self.end = book[codes] if len(book) else book, ends[codes] if len(book) else ends
        self.word = ~(ends | pauses)[codes] if len(book) else ends

    def bands(self, every: bool) -> tuple[np.ndarray, np.ndarray]:
        """(text, band key) of the beginnings of all grid lengths, or of each text's longest only."""
        kept = self.hash[self.word]
        start = np.r_[0, np.cumsum(np.bincount(self.owner[self.word], minlength=len(self.start) - 1))]
        h, at = windows(kept, start, SHINGLE)
        owner = np.repeat(np.arange(len(start) - 1), np.diff(start))[at]
        if not len(h):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        n = np.bincount(owner, minlength=len(start) - 1)
        steps = np.array(grid(int(n.max())))
        levels = np.searchsorted(steps, n, "right")  # how many grid lengths each text reaches
        within = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        h = h[within < np.r_[0, steps][levels][owner]]  # what lies beyond the last of them
        text = np.repeat(np.arange(len(n)), levels)
        level = np.arange(len(text)) - np.repeat(np.cumsum(levels) - levels, levels)
        reach = np.r_[0, steps][levels]
        cuts = (np.cumsum(reach) - reach)[text] + np.r_[0, steps][level]  # where the piece up to each grid length begins
        odd = np.array([0xA24BAED4963EE407 * (2 * k + 1) % 2**64 for k in range(ROWS * BANDS)], np.uint64)
        salt = (np.arange(BANDS) + BANDS * steps[level][:, None]).astype(np.uint64)
        keys = np.zeros((len(text), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            least = np.stack([np.minimum.reduceat(h * a, cuts) for a in odd], axis=1)
            for k in range(1, int(levels.max())):  # a beginning holds the shorter ones
                here = np.flatnonzero(level == k)
                least[here] = np.minimum(least[here], least[here - 1])
            for row in range(ROWS):
                keys = mix(keys * np.uint64(31) + least[:, row * BANDS : (row + 1) * BANDS] + salt)
            whole = mix(least.sum(axis=1, dtype=np.uint64) + salt[:, 0])
        few = steps[level] < WHOLE_RUNS  # copies of so few runs have all of them: one key for all signatures
        keys[few] = whole[few, None]
        chosen = np.ones((len(text), BANDS), bool) if every else np.repeat((level == levels[text] - 1)[:, None], BANDS, 1)
        chosen[few, 1:] = False
        return np.repeat(text, BANDS).reshape(-1, BANDS)[chosen], keys.view(np.int64)[chosen]

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, ended) of all runs of words that end before a text's last token, and of the contexts of single words."""
        h, end = self.hash, self.end
        if len(h) < 2:
            return np.empty(0, np.uint64), np.empty(0, bool)
        inside = np.r_[self.owner[1:] == self.owner[:-1], False]
        place = np.arange(len(h)) - self.start[self.owner]
        ended = np.r_[end[1:], False]
        hashes, flags = [], []
        every, ok = gram_hashes(h), inside & self.word
        for k, g in enumerate(every):
            hashes.append(g[ok])
            flags.append(ended[ok])
            if k + 1 < LONGEST:
                ok = ok & (place > k) & ~np.r_[np.ones(k + 1, bool), end[: -k - 1]][: len(h)]
        after_two = inside & self.word & (place > 1) & ~np.r_[True, end[:-1]]
        hashes.append(context_hash(np.r_[h[:1], every[1][:-1]])[after_two])
        flags.append(ended[after_two])
        return np.concatenate(hashes), np.concatenate(flags)


_SIGNED = "h long, key binary, total long, ends long"


def _signed(every: bool, known: KeyMap | None):
    """Rows (h, key) of the bands of texts (key, text), and, with ``known``, (h, total, ends) of their closing words; only of hashes in ``known``. Hash 0 counts all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in pieces(big, [1], 10_000):
                words = Words([t and opened(without_ellipsis(t)[0]) for t in batch.column(1).to_pylist()])
                text, keys = words.bands(every)
                total = np.empty(0, np.int64)
                h, ends = total, total
                if known:
                    fits = known(keys)
                    text, keys = text[fits], keys[fits]
                    found, ended = words.grams()
                    fits = known(found)
                    h, back = np.unique(found[fits].view(np.int64), return_inverse=True)
                    total, ends = np.bincount(back, minlength=len(h)), np.bincount(back, ended[fits], len(h)).astype(np.int64)
                    h, total, ends = np.r_[h, 0], np.r_[total, np.count_nonzero(words.word)], np.r_[ends, 0]
                none = pa.nulls(len(h), pa.binary())
                columns = [
                    pa.array(np.r_[keys, h], pa.int64()), pa.chunked_array([batch.column(0).take(pa.array(text)), none], pa.binary()).combine_chunks(),
                    pa.array(np.r_[np.zeros(len(keys), np.int64), total]), pa.array(np.r_[np.zeros(len(keys), np.int64), ends]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "key", "total", "ends"])

    return run


def runs_of(text: str) -> frozenset[int]:
    """The runs of five words of a text, as hashes."""
    words = _SHINGLED.findall(text.lower())
    return frozenset(hash(tuple(words[i : i + SHINGLE])) for i in range(len(words) - SHINGLE + 1))


def holds(x: frozenset[int], y: frozenset[int]) -> float:
    """The share of the runs ``x`` that are in ``y``."""
    return len(x & y) / max(1, len(x))


def _from_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo: dict[bytes, frozenset[int]] = {}
    held = 0
    for batch in batches:
        columns: tuple[list, ...] = ([], [], [])
        for key, running, other_key, other in zip(*(batch.column(i).to_pylist() for i in range(4))):
            for k, text in ((key, running), (other_key, other)):
                if k not in memo:
                    if held > HELD_RUNS:
                        memo.clear()
                        held = 0
                    memo[k] = runs_of(text)
                    held += len(memo[k])
            x, y = memo.get(key) or runs_of(running), memo[other_key]
            if (near := holds(x, y)) < SIMILARITY:
                continue
            bare = LABEL.sub(" ", without_ellipsis(other)[0])
            if tokens(bare)[-7:] == tokens(running)[-7:] or (verdict := aligned(running, bare)) == UNKNOWN:
                continue
            for column, value in zip(columns, (key, near + len(x) / max(1, len(x | y)), 1 if verdict == CUT else -1)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.float64(), pa.int32()))], names=["key", "near", "cut"])


def _sharing(asked: DataFrame, held: DataFrame) -> DataFrame:
    """Distinct (key, copy_key) of the rows (key, band) that share a band; a band of many copies is spread by their keys."""
    return salted_join(asked, held.select("band", F.col("key").alias("copy_key")), ["band"], "copy_key").where("key <> copy_key").select("key", "copy_key").distinct()


def _kept(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose ``name`` is among ``keys``, which are broadcast if few."""
    return df.join(small(keys), name, "left_semi")


_GRAMMED = "key string, h array<long>"


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.array(Asked(t, a).keys(), np.uint64).view(np.int64).tolist() for t, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["key", "h"])


def _unfinished(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for text, answer, held in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                counts = {c["h"] % 2**64: (c["total"], c["ends"]) for c in held or ()}
                cut.append(Asked(text, answer).unfinished(counts, words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.bool_())], names=["asked", "cut"])

    return run


def copy_verdicts(classes: DataFrame, asked: DataFrame, held: DataFrame, keyed: DataFrame) -> DataFrame:
    """(key, cut) of classes (key, running) decided by near-copies; ``asked`` and ``held`` are the bands (key, band) of classes and of texts, ``keyed`` the texts (copy_key, other)."""
    candidates = cut_lineage(_sharing(asked, held))
    copies = _kept(keyed, candidates.select("copy_key").distinct(), "copy_key").dropDuplicates(["copy_key"])
    pairs = candidates.join(classes, "key").join(copies, "copy_key").select("key", "running", "copy_key", "other")
    found = pairs.mapInArrow(_from_copies, "key binary, near double, cut int")
    votes = found.groupBy("key", "near").agg(F.sum("cut").alias("cut"))
    return votes.groupBy("key").agg(F.max(F.struct("near", "cut")).alias("best")).select("key", (F.col("best.cut") >= 0).alias("cut"))


def settled(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, field) of the suspects (id, field, running, answer) that were cut, by the near-copies and closing words of ``texts`` (one column, text)."""
    keyed = texts.where("text is not null").select(F.unhex(F.md5("text")).alias("copy_key"), F.col("text").alias("other"))
    suspects = cut_lineage(suspects.select("id", "field", F.unhex(F.md5("running")).alias("key"), F.md5(F.concat_ws("\n", "running", "answer")).alias("asked"), "running", "answer"))
    classes = suspects.select("key", "running").dropDuplicates(["key"])
    bands = cut_lineage(classes.mapInArrow(_signed(False, None), _SIGNED).select("key", F.col("h").alias("band")))
    endings = suspects.select("asked", "running", "answer").dropDuplicates(["asked"])
    grams = cut_lineage(endings.mapInArrow(_asked, _GRAMMED).select("key", F.explode("h").alias("h")))
    known = KeyMap.of(bands.select(F.col("band").alias("h")).union(grams.select("h")).distinct())
    signed = stored(keyed.mapInArrow(_signed(True, known), _SIGNED), "signed-texts")
    counts = cut_lineage(signed.where("key is null").groupBy("h").agg(F.sum("total").alias("total"), F.sum("ends").alias("ends")))
    words = (counts.where("h = 0").first() or {"total": 0})["total"]
    held = signed.where("key is not null").select("key", F.col("h").alias("band")).join(bands.select("band").distinct(), "band", "left_semi").distinct()
    copied = copy_verdicts(classes, bands, cut_lineage(held), keyed)
    known_grams = grams.join(counts, "h").groupBy("key").agg(F.collect_list(F.struct("h", "total", "ends")).alias("counts"))  # a handful of runs
    modelled = endings.join(known_grams, endings["asked"] == known_grams["key"], "left").select("asked", "running", "answer", "counts").mapInArrow(_unfinished(words), "asked string, cut boolean")
    decided = suspects.select("id", "field", "key", "asked").join(copied, "key", "left").join(modelled.withColumnRenamed("cut", "modelled"), "asked")
    return decided.where(F.coalesce("cut", "modelled")).select("id", "field").distinct()


def truncated(df: DataFrame, id_col: str, paragraph: str, raw: str, answer: str, question: str, label: str) -> DataFrame:
    """(id, field) of every cut text of the columns ``paragraph`` and ``raw``; ``answer`` is the record's final answer, as written in its replies, ``label`` the answer it is labelled with."""
    named = {"paragraph": paragraph, "raw": raw, "answer": answer, "question": question, "label": label}
    rows = spread(df.select(F.col(id_col).cast("long").alias("id"), *(F.col(c).alias(name) for name, c in named.items())))
    judged = cut_lineage(rows.mapInArrow(_judged(paragraph, raw), _JUDGED).distinct())
    cut = settled(judged.where(F.col("verdict") == UNKNOWN), texts_of(rows))
    return judged.where(F.col("verdict") == CUT).select("id", "field").unionByName(cut)


def texts_of(rows: DataFrame) -> DataFrame:
    """(text) of the paragraphs, replies and labels of records."""
    return rows.select(F.explode(F.array("paragraph", "raw", "label")).alias("text"))


def rates(df: DataFrame, cases: DataFrame, id_col: str, source_col: str, fields: list[str]) -> DataFrame:
    """(source, field, texts, cut, share): of each source how many of its texts are cut; ``cases`` has id and field."""
    held = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).isNotNull().alias("held")) for f in fields))
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.explode(held).alias("x")).where("x.held").select("id", "source", "x.field").distinct()
    joined = rows.join(cases.withColumn("is_cut", F.lit(1)), ["id", "field"], "left")
    out = joined.groupBy("source", "field").agg(F.count("*").alias("texts"), F.count("is_cut").alias("cut"))
    return out.withColumn("share", F.col("cut") / F.col("texts"))
