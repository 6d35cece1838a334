"""Problem 1: how often every distinct term occurs and in how many records.

Heavy-light aggregation. A bounded sketch over the whole input names the terms
that may be heavy (at most ``heavy_max`` a field); they are broadcast, and every
task counts them exactly in local counter arrays, so of a heavy term only one row
a task is shuffled, however many records hold it. All other terms are shuffled,
and both count tables are united. The sketch decides only where a term is counted,
never its count.

Repeated rows of a record would be counted twice by that. A shuffle of the ids alone finds
the repeated ids; a bit map of fixed size over their hashes goes to the tasks, and only rows
whose id may be in it (and those without an id) are sent on with their terms to be merged.

Defined results: null terms are left out, as are terms that are empty after
normalisation; rows with equal id and equal terms count once, so repeated rows of
a record do; all rows with a null id are one record, in which a term occurs as often as in
the row that holds it most; an empty table gives an empty result. A term in a record's array
field counts once a position for ``occurrences`` and once for ``records``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumisift.llm.key_map import KeyMap
from lumisift.runtime import cut_lineage

HEAVY_MAX = 64
HEAVY_SHARE = 0.001
RARE_MAX = 2
COMMON_SHARE = 0.02
_COUNTED = "id long, field string, term string, occurrences long, records long, holders long"
_ARROW = pa.schema([("id", pa.int64()), ("field", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64()), ("holders", pa.int64())])


def normalised_term(value: Column) -> Column:
    """Lower case, outer white space removed, inner runs of white space made one blank."""
    spaced = F.regexp_replace(F.lower(value), r"(?U)[\s\x1c-\x1f]+", " ")
    return F.trim(spaced)


def _occurrences(df: DataFrame, id_col: str, fields: dict[str, Column]) -> DataFrame:
    """(id, field, term, occ, holder): one row per record, field and distinct term; holder is 1 for one row of each record and field."""

    def held(name: str, terms: Column) -> Column:
        def entry(term: Column, position: Column) -> Column:
            occ = F.size(F.filter(terms, lambda x: x == term)).cast("long")
            return F.struct(F.lit(name).alias("field"), term.alias("term"), occ.alias("occ"), F.when(position == 0, 1).otherwise(0).cast("long").alias("holder"))

        return F.transform(F.array_distinct(terms), entry)

    rows = df.select(F.col(id_col).alias("id"), F.explode(F.concat(*(held(*x) for x in fields.items()))).alias("x"))
    return rows.select("id", "x.field", "x.term", "x.occ", "x.holder")


def _heavy_terms(rows: DataFrame, heavy_max: int, share: float) -> list[tuple[str, str]]:
    """The terms that may be heavy: at most ``heavy_max`` a field come to the driver."""
    found = rows.groupBy("field").agg(F.count("*").alias("n"), F.expr(f"approx_top_k(term, {heavy_max}, {heavy_max * 16})").alias("top")).collect()
    return [(r["field"], t["item"]) for r in found for t in r["top"] if t["count"] >= share * r["n"]]


def repeated_ids(df: DataFrame, id_col: str) -> KeyMap:
    """The map of all ids that more than one row has."""
    counts = df.select(F.col(id_col).cast("long").alias("id")).where("id is not null").groupBy("id").count()
    return KeyMap.of(counts.where("count > 1").select(F.xxhash64("id").alias("h")))


def _local_counts(heavy: list[tuple[str, str]], repeated: KeyMap):
    keys = [f"{field}\x00{term}" for field, term in heavy]

    def counted(table: pa.Table) -> pa.Table:
        grouped = table.group_by(["field", "term"]).aggregate([("occ", "sum"), ("occ", "count"), ("holder", "sum")])
        grouped = grouped.select(["field", "term", "occ_sum", "occ_count", "holder_sum"])
        return pa.table([pa.nulls(len(grouped), pa.int64()), *grouped.columns], names=_ARROW.names).cast(_ARROW)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(keys, pa.string())
        counters = np.zeros((3, len(keys)), np.int64)
        for batch in batches:
            again = repeated(batch.column("h").to_numpy()) | batch.column("id").is_null().to_numpy(zero_copy_only=False)
            if again.any():  # on to be merged, as they are
                held = batch.filter(pa.array(again))
                once = pa.array(np.ones(len(held), np.int64))
                yield pa.RecordBatch.from_arrays([held.column("h"), held.column("field"), held.column("term"), held.column("occ"), once, pa.nulls(len(held), pa.int64())], schema=_ARROW)
                batch = batch.filter(pa.array(~again))
            _, _, field, term, occ, holder = batch.columns
            at = pc.index_in(pc.binary_join_element_wise(field, term, "\x00"), value_set=known) if keys else pa.nulls(len(batch), pa.int32())
            is_heavy = pc.is_valid(at)
            place = at.drop_null().to_numpy(zero_copy_only=False)
            if len(place):
                for row, values in enumerate((occ, None, holder)):
                    weight = None if values is None else values.filter(is_heavy).to_numpy(zero_copy_only=False)
                    counters[row] += np.bincount(place, weight, len(keys)).astype(np.int64)
            light = pa.Table.from_batches([batch]).filter(pc.invert(is_heavy))
            if light.num_rows:
                yield from counted(light).to_batches()
        used = np.flatnonzero(counters[1])
        if len(used):
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array([heavy[i][0] for i in used]), pa.array([heavy[i][1] for i in used]), *(pa.array(counters[k][used]) for k in range(3))], schema=_ARROW)

    return count


def _local(rows: DataFrame, heavy: list[tuple[str, str]], repeated: KeyMap) -> DataFrame:
    """What the tasks send: counts (id null), and the terms of possibly repeated records as they are (id is its hash)."""
    hashed = rows.select(F.xxhash64("id").alias("h"), F.col("id").cast("long").alias("id"), "field", "term", "occ", "holder")
    return hashed.mapInArrow(_local_counts(heavy, repeated), _COUNTED)


def _counts(df: DataFrame, id_col: str, fields: dict[str, Column], heavy_max: int, heavy_share: float) -> DataFrame:
    """As :func:`term_counts`, with further ``holders`` in a row without a term."""
    rows = _occurrences(df, id_col, fields)
    heavy = _heavy_terms(rows, heavy_max, heavy_share)
    sent = cut_lineage(_local(rows, heavy, repeated_ids(df, id_col)))
    single = sent.where("id is not null").groupBy("id", "field", "term").agg(F.max("occurrences").alias("occurrences"))
    merged = single.select("field", "term", "occurrences", F.lit(1).cast("long").alias("records"), F.lit(0).cast("long").alias("holders"))
    holders = single.select("id", "field").distinct().select("field", F.lit(None).cast("string").alias("term"), *(F.lit(n).cast("long").alias(c) for c, n in (("occurrences", 0), ("records", 0), ("holders", 1))))
    united = sent.where("id is null").drop("id").unionByName(merged).unionByName(holders)
    return united.groupBy("field", "term").agg(*(F.sum(c).alias(c) for c in ("occurrences", "records", "holders")))


def term_counts(df: DataFrame, id_col: str, fields: dict[str, Column], heavy_max: int = HEAVY_MAX, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """(field, term, occurrences, records) of every distinct term; ``fields`` maps a field's name to an array<string> of normalised terms without nulls."""
    return _counts(df, id_col, fields, heavy_max, heavy_share).where("term is not null").drop("holders")


def term_frequencies(df: DataFrame, id_col: str, fields: dict[str, Column], rare_max: int = RARE_MAX, common_share: float = COMMON_SHARE) -> DataFrame:
    """(field, term, occurrences, records, band): band is 'rare' (in at most ``rare_max`` records), 'common' (in at least ``common_share`` of the field's records) or null."""
    counts = cut_lineage(_counts(df, id_col, fields, HEAVY_MAX, HEAVY_SHARE))
    totals = counts.groupBy("field").agg(F.sum("holders").alias("total"))
    banded = counts.where("term is not null").join(F.broadcast(totals), "field")  # one row a field
    band = F.when(F.col("records") <= rare_max, "rare").when(F.col("records") >= common_share * F.col("total"), "common")
    return banded.select("field", "term", "occurrences", "records", band.alias("band"))


def scalar_terms(value: Column) -> Column:
    """The array of the one normalised term of a scalar column; empty for null and blank values."""
    term = normalised_term(value)
    return F.when(F.coalesce(F.length(term), F.lit(0)) > 0, F.array(term)).otherwise(F.array().cast("array<string>"))
