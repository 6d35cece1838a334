"""What a number read off an image may be confused with; all inside the JVM."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisift.functions.answers import literal_map
from lumisift.functions.text import NUMBER_WORDS

#: Letters that digits are misread as, and how far neighbours are away.
CONFUSED = {"0": "Oo", "1": "lIi", "2": "Zz", "5": "Ss", "8": "B"}
DELTAS = (-100, -10, -2, -1, 0, 1, 2, 10, 100)
MOST = 50
PERMUTED_UPTO, PERMUTED_MOST = 4, 10


def first_number(value: Column) -> Column:
    """The first run of digits of a text; null without one."""
    return F.nullif(F.regexp_extract(value, r"([0-9]+)", 1), F.lit(""))


def near(number: Column) -> Column:
    """The numbers at the deltas from a number in digits that aren't negative."""
    n = number.try_cast("decimal(38,0)")
    return F.transform(F.filter(F.array(*(n + d for d in DELTAS)), lambda x: x >= 0), lambda x: x.cast("string"))


def misread(number: Column) -> Column:
    """A number with one digit read as a letter, or with a blank within."""
    n = F.length(number)
    cut = lambda i: (F.substring(number, F.lit(1), i - 1), F.substring(number, i, F.lit(1)), F.substring(number, i + 1, n))
    letters = literal_map(CONFUSED)

    def variants(i: Column) -> Column:
        head, digit, tail = cut(i)
        swapped = F.transform(F.filter(F.split(F.coalesce(F.element_at(letters, digit), F.lit("")), ""), lambda c: c != ""), lambda c: F.concat(head, c, tail))
        return swapped

    places = F.sequence(F.lit(1), n)
    blanks = F.transform(F.filter(places, lambda i: i > 1), lambda i: F.concat(F.substring(number, F.lit(1), i - 1), F.lit(" "), F.substring(number, i, n)))
    return F.concat(F.flatten(F.transform(places, variants)), blanks)


def reordered(number: Column) -> Column:
    """The first of the other orders of the digits of a number of up to four digits, in rising order."""
    out = F.array().cast("array<string>")
    for size in range(2, PERMUTED_UPTO + 1):
        orders = [F.concat(*(F.substring(number, k + 1, 1) for k in order)) for order in permutations(range(size))]
        out = F.when(F.length(number) == size, F.array_distinct(F.array(*orders))).otherwise(out)
    return F.slice(F.array_sort(F.filter(out, lambda x: x != number)), 1, PERMUTED_MOST)


def candidates(value: Column) -> Column:
    """What the number in an answer may be confused with: of all these at most ``MOST``, digits before letters before blanks, shorter ones first; then by length and text. The answer itself without a number."""
    number = first_number(value)
    held = F.array_distinct(F.concat(near(number), reordered(number), misread(number)))
    keyed = F.transform(held, lambda x: F.struct(F.contains(x, F.lit(" ")).alias("a"), x.rlike("[A-Za-z]").alias("b"), F.length(x).alias("c"), x.alias("x")))
    cut = F.slice(F.array_sort(keyed), 1, MOST)
    final = F.transform(F.array_sort(F.transform(cut, lambda e: F.struct(e["c"].alias("c"), e["x"].alias("x")))), lambda e: e["x"])
    return F.when(number.isNull(), F.array(value)).otherwise(final)


def spoken(value: Column) -> Column:
    """The word of the number in an answer, up to twenty; null for others."""
    return F.element_at(literal_map({str(i): w for i, w in enumerate(NUMBER_WORDS)}), first_number(value).try_cast("int").cast("string"))
