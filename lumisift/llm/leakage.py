"""Problem 8: passages of held-out items within the documents of a corpus.

The corpus becomes a stored positional inverted index in segments of documents. A row of
it is the list of one term of one segment: the term's documents and positions. A term is
two neighbouring words in the consistent form of :mod:`lumisift.llm.lookalikes` (whose pair
scores are fitted on all documents), so that an intersection already of two lists fixes
three or four words of a phrase. The rows of a segment are sorted by term.

A passage covers a run of at least ``share`` of an item's words, of which at most the share
``OFF`` may be changed, misspelled, missing or have words put in between. Each such word
breaks two terms at most, so a run of L words with m of them off keeps at least L - 1 - 2m
terms in place. Of each run of that length the rarest 2m + h terms are looked up, h being
``KEPT`` of those that stay, so at least h of them are found at (nearly) the same shift.
The lists of all terms of all items are looked up at once; the lists found are brought
together by segment, shifted by the terms' places in the item and intersected there: at
least h different places of one item and document within one cell of shifts. The width of a
cell is the item's length (twice ``DRIFT_LEAST`` at least); a second grid, moved by half of that, keeps hits near an edge
together.

Each candidate is then aligned word by word around its cell: a chain of words in the item's
order, wrong words costing as much as right ones gain, where a misspelled word counts as
half a hit for finding a stretch and fully for its size. A leak has at least ``share`` of
the item's words in one such stretch.

Defined results: null and blank texts and items, and null ids, give no rows; items with
fewer than ``LEAST_WORDS`` words are sought as exact phrases; equal items are reported
each; every document is indexed and whole texts are read; repeated rows give repeated hits
once. Neither items nor candidates come to the driver.
"""

from __future__ import annotations

import math
import pickle
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm.joins import small
from lumisift.llm.lookalikes import Consistent, PairScores, fitted
from lumisift.llm.spelling import one_edit
from lumisift.llm.words import WORD, pieces
from lumisift.runtime import cut_lineage, spread, stored_once

SHARE = 0.5
OFF = 1 / 3
KEPT = 0.8
LEAST_WORDS = 4
DRIFT_LEAST = 12
#: Documents, and bytes of their texts, of a segment.
SEGMENT_DOCS, SEGMENT_SIZE = 10_000, 8_000_000
#: Postings, and pairs of an item and a document, intersected at once.
HELD_POSTINGS, HELD_PAIRS = 2_000_000, 4_000_000
_INDEX = pa.schema([("segment", pa.int64()), ("first", pa.string()), ("next", pa.string()), ("n", pa.int32()), ("docs", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])
_PLACED = "key long, size int, place int, first string, next string"
_CHOSEN = "key long, size int, place int, first string, next string, hits int"
_CANDIDATES = "doc_id long, key long, shift int"


def words_of(text: str | None, consistent: Consistent) -> list[str]:
    return WORD.findall(consistent(text)[0].lower()) if text else []


def _segments(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        consistent = Consistent(pickle.loads(packed))  # noqa: S301 - made by index()
        number = TaskContext.get().partitionId() << 32
        for big in batches:
            for batch in pieces(big, [1], SEGMENT_DOCS, SEGMENT_SIZE):
                book: dict[str, int] = defaultdict()
                book.default_factory = book.__len__
                end = book[""]  # follows a text's last word
                codes, lengths = [], []
                for text in batch.column(1).to_pylist():
                    found = [*map(book.__getitem__, words_of(text, consistent))]
                    lengths.append(len(found))
                    codes += found
                lengths, first = np.array(lengths, np.int64), np.array(codes, np.int64)
                starts = np.cumsum(lengths) - lengths
                after = np.r_[first[1:], end] if len(first) else first
                after[(starts + lengths - 1)[lengths > 0]] = end
                names = np.array(list(book), object)
                rank = np.empty(len(names), np.int64)
                rank[np.argsort(names)] = np.arange(len(names))
                term = rank[first] * len(names) + rank[after]
                order = np.argsort(term, kind="stable")
                begin = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0]) if len(order) else order
                offsets = pa.array(np.r_[begin, len(order)], pa.int32())
                docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)[order]
                at = (np.arange(len(first)) - np.repeat(starts, lengths))[order]
                lead = order[begin]
                columns = [
                    np.full(len(begin), number), names[first[lead]], names[after[lead]], np.diff(np.r_[begin, len(order)]),
                    pa.ListArray.from_arrays(offsets, pa.array(docs, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _INDEX)], schema=_INDEX)
                number += 1

    return run


def index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scores: PairScores | None = None) -> DataFrame:
    """The stored positional index of a corpus: (segment, first, next, n, docs, at), one row a term of a segment."""
    scores = scores or fitted(df, id_col, text_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null and id is not null")
    schema = "segment long, first string, next string, n int, docs array<long>, at array<int>"
    return stored_once(spread(rows).mapInArrow(_segments(pickle.dumps(scores)), schema), "positional-index", df)


def _placed(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        consistent = Consistent(pickle.loads(packed))  # noqa: S301 - made by leaks()
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = words_of(text, consistent)
                if len(held) == 1:
                    rows.append((key, 1, 0, held[0], None))
                rows += [(key, len(held), i, a, b) for i, (a, b) in enumerate(zip(held, held[1:]))]
            types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["key", "size", "place", "first", "next"])

    return run


def needed(n: int, share: float = SHARE) -> int:
    """The right words that make a leak of an item of ``n`` words."""
    return math.ceil(share * n - 1e-9) if n >= LEAST_WORDS else n


def rarest(n: int, freq: list[int], share: float = SHARE) -> tuple[list[int], int]:
    """The places of the terms to look up of an item of ``n`` words whose terms are so frequent, and how many of them any passage hits."""
    run = max(2, needed(n, share))
    off = min(int(OFF * run), (run - 2) // 2) if n >= LEAST_WORDS else 0
    hits = max(1, math.ceil(KEPT * (run - 1 - 2 * off)))
    chosen: set[int] = set()
    for start in range(max(1, n - run + 1)):
        chosen.update(sorted(range(start, min(start + run - 1, n - 1)), key=lambda k: (freq[k], k))[: 2 * off + hits])
    return sorted(chosen), hits


def _choose(share: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        n = table.column("size")[0].as_py()
        keep, hits = ([0], 1) if n == 1 else rarest(n, table.column("freq").to_pylist(), share)
        kept = table.take(keep).select(["key", "size", "place", "first", "next"])
        return kept.append_column("hits", pa.array([hits] * len(keep), pa.int32()))

    return run


def _cells(owner: np.ndarray, local: np.ndarray, shift: np.ndarray, place: np.ndarray, half: np.ndarray, least: np.ndarray, docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(item, document, middle shift) of the cells of both grids that hold ``least`` different places of their item."""
    pair = owner * docs + local
    full = np.bincount(pair, minlength=len(half) * docs) >= np.repeat(least, docs)
    kept = full[pair]
    owner, pair, shift, place = owner[kept], pair[kept], shift[kept], place[kept]
    if not len(pair):
        return
    n_places = int(place.max()) + 1
    for moved in (0, 1):
        cell = (shift + moved * half[owner]) // (2 * half[owner])
        low = int(cell.min())
        n_cells = int(cell.max()) - low + 1
        hit = np.sort((pair * n_cells + (cell - low)) * n_places + place)
        group = hit[np.r_[True, hit[1:] != hit[:-1]]] // n_places  # of one place and cell one hit counts
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        distinct = np.diff(np.r_[first, len(group)])
        group = group[first]
        item, doc = np.divmod(group // n_cells, docs)
        ok = distinct >= least[item]
        yield item[ok], doc[ok], (2 * (group[ok] % n_cells + low) + 1 - moved) * half[item[ok]]


def _intersect(table: pa.Table) -> pa.Table:
    """The candidates of one segment: the lists found in it, shifted and grouped by item, document and cell; some items at a time."""
    lists, at, asked = (table.column(c).combine_chunks() for c in ("docs", "at", "asked"))
    owners = asked.flatten()
    keys, places, sizes, hits = (owners.field(f).to_numpy(zero_copy_only=False) for f in ("key", "place", "size", "hits"))
    item_keys, item = np.unique(keys, return_inverse=True)
    half, least = np.zeros((2, len(item_keys)), np.int64)
    half[item], least[item] = np.maximum(DRIFT_LEAST, (sizes + 1) // 2), hits
    local, doc_ids = pd.factorize(lists.flatten().to_numpy())
    at = at.flatten().to_numpy()
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    order = np.argsort(item, kind="stable")  # lookups by item
    owner, place, held = item[order], places[order], np.repeat(np.arange(len(table)), np.diff(asked.offsets.to_numpy()))[order]
    counts = np.diff(offsets)[held]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
    upto, found, start = np.r_[0, np.cumsum(counts)], [], 0
    while start < len(first):
        fits = np.searchsorted(upto[first], upto[first[start]] + HELD_POSTINGS, "right") - 1
        end = max(start + 1, min(int(fits), start + HELD_PAIRS // max(1, len(doc_ids))))
        of = slice(first[start], first[end] if end < len(first) else len(owner))
        n = counts[of]
        lookup = np.repeat(np.arange(len(n)), n)
        posting = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + offsets[held[of]][lookup]
        block = slice(start, end)
        for which, doc, shift in _cells(owner[of][lookup] - start, local[posting], at[posting] - place[of][lookup], place[of][lookup].astype(np.int64), half[block], least[block], len(doc_ids)):
            found.append((doc_ids[doc], item_keys[which + start], shift))
        start = end
    merged = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(3)]
    return pa.table([pa.array(m, t) for m, t in zip(merged, (pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "key", "shift"])


def _near(a: str, b: str) -> bool:
    return a == b or len(a) > 3 and len(b) > 3 and abs(len(a) - len(b)) < 2 and not (a.isdigit() or b.isdigit()) and one_edit(a, b)


class Item:
    """An item's words, where each stands, and how many must be right."""

    def __init__(self, words: list[str], share: float = SHARE) -> None:
        self.words = words
        self.where: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            self.where[w].append(i)
        n = len(words)
        self.need, self.drift = needed(n, share), max(DRIFT_LEAST, (n + 1) // 2)
        self.exact = max(1, self.need - int(OFF * self.need)) if n >= LEAST_WORDS else n


def in_order(hits: list[tuple[int, int]]) -> int:
    """The most hits (place in the text, place in the item) whose places rise in both; ``hits`` are in order."""
    ends: list[int] = []
    row, at = [], -1
    for j, i in [*hits, (-1, -1)]:
        if j != at:
            for k in reversed(row):  # of one word of the text at most one counts
                x = bisect_left(ends, k)
                ends[x : x + 1] = [k]
            row, at = [], j
        row.append(i)
    return len(ends)


def stretch(item: Item, words: list[str], shift: int | None = None) -> int:
    """The most words of the item, in its order, in one stretch of a document in which wrong words don't outweigh right ones.

    With ``shift`` only words whose place differs by about so much from that in the item are
    looked at. Both ends of the stretch lie on right words; words between two neighbouring right ones
    that correspond in place and differ by one edit count as right. Where too few of the
    item's words occur exactly for a leak, it is 0.
    """
    if shift is None:
        begin, end, low, high = 0, len(words), -math.inf, math.inf
    else:
        low, high = shift - 2 * item.drift, shift + 2 * item.drift
        begin, end = max(0, low), max(0, min(len(words), high + len(item.words)))
    where = item.where
    hits = [(j, i) for j in range(begin, end) if words[j] in where for i in where[words[j]] if low <= j - i <= high]
    if len(hits) < item.exact or in_order(hits) < item.exact:
        return 0
    gap_most = 2 * item.drift
    score, right, best, first = [1.0] * len(hits), [1] * len(hits), 0, 0
    diagonal: dict[int, int] = {}
    for k, (at, of) in enumerate(hits):
        while hits[first][0] < at - gap_most:
            first += 1
        top, gained = 0.0, 0
        q = diagonal.get(at - of, -1)  # the neighbour between which and this hit words correspond in place
        if q >= first:
            at_q, of_q = hits[q]
            near = sum(map(_near, words[at_q + 1 : at], item.words[of_q + 1 : of]))
            if (gain := score[q] - (at - at_q) + 1 + 1.5 * near) > 0:
                top, gained = gain, right[q] + near
        if q < first or at - hits[q][0] > 1:  # nothing beats the neighbour of a run
            for q in range(k - 1, first - 1, -1):
                at_q, of_q = hits[q]
                if at_q < at and of_q < of and (gain := score[q] - max(at - at_q, of - of_q) + 1) > top:
                    top, gained = gain, right[q]
        diagonal[at - of] = k
        score[k] += top
        right[k] += gained
        best = max(best, right[k])
        if best >= item.need:
            return best
    return best


def apart(shifts: list[int], drift: int) -> list[int]:
    """Shifts around which every cell is looked at: one within ``drift`` of another lies in what is aligned around that."""
    kept: list[int] = []
    for s in sorted(shifts):
        if not kept or s - kept[-1] > drift:
            kept.append(s)
    return kept


def _aligned(packed: bytes, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        consistent = Consistent(pickle.loads(packed))  # noqa: S301 - made by leaks()
        items: dict[str, Item] = {}
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for doc, text, asked in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = words_of(text, consistent)
                for a in asked:
                    if a["text"] not in items:
                        if len(items) > 20_000:
                            items.clear()
                        items[a["text"]] = Item(words_of(a["text"], consistent), share)
                    item = items[a["text"]]
                    if any(stretch(item, words, s) >= item.need for s in apart(a["shifts"], item.drift)):
                        out[0].append(doc)
                        out[1].append(a["item_id"])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "item_id"])

    return run


def leaks(indexed: DataFrame, documents: DataFrame, items: DataFrame, scores: PairScores, share: float = SHARE, id_col: str = "doc_id", doc_text: str = "text", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id) of every document with a passage of an item; ``indexed`` is the index of ``documents``."""
    packed = pickle.dumps(scores)
    listed = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("item_id is not null and text is not null").distinct()
    listed = listed.withColumn("key", F.xxhash64("item_id", "text"))
    placed = cut_lineage(listed.select("key", "text").mapInArrow(_placed(packed), _PLACED))
    terms = placed.where("next is not null").select("first", "next").distinct()
    freq = indexed.select("first", "next", "n").join(small(terms), ["first", "next"], "left_semi").groupBy("first", "next").agg(F.sum("n").alias("freq"))
    weighed = placed.join(freq, ["first", "next"], "left").select("key", "size", "place", "first", "next", F.coalesce("freq", F.lit(0)).alias("freq"))
    chosen = weighed.groupBy("key").applyInArrow(_choose(share), _CHOSEN)  # a group is one item
    lookups = cut_lineage(chosen.groupBy("first", "next").agg(F.collect_list(F.struct("key", "place", "size", "hits")).alias("asked")))
    held = ("segment", "docs", "at", "asked")
    lists = indexed.join(small(lookups.where("next is not null")), ["first", "next"]).select(*held)
    single = lookups.where("next is null").select("first", "asked")
    if not single.isEmpty():  # items of one word
        lists = lists.unionByName(indexed.join(small(single), "first").select(*held))
    cells = cut_lineage(lists.groupBy("segment").applyInArrow(_intersect, _CANDIDATES))  # a group is the lists found in one segment
    per_item = cells.groupBy("doc_id", "key").agg(F.collect_set("shift").alias("shifts"))
    asked = per_item.join(small(listed), "key").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "text", "shifts")).alias("asked"))  # bounded by the document's own words
    texts = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(doc_text).alias("body"))
    texts = texts.join(small(cells.select("doc_id").distinct()), "doc_id", "left_semi")
    pairs = texts.join(asked, "doc_id").select("doc_id", "body", "asked")
    return pairs.mapInArrow(_aligned(packed, share), "doc_id long, item_id long").distinct()


def leaked_items(items: DataFrame, found: DataFrame, item_col: str = "item_id", split_col: str = "split") -> DataFrame:
    """(item_id, split, documents) of the items that leaked."""
    counts = found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))
    return items.select(F.col(item_col).alias("item_id"), F.col(split_col).alias("split")).distinct().join(counts, "item_id")
