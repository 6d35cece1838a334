"""Column functions that check answers and reasonings before they are used; all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisift.functions.answers import literal_map

#: Colours that a combination is made of, and words that only guess.
PAIRED_COLORS = ("red", "green", "blue", "yellow", "orange", "purple", "pink", "brown", "black", "white", "gray", "grey", "cyan", "magenta")
SPECULATIVE = ("appear", "seem", "seems", "appeared", "seemed", "probably", "likely", "possibly", "perhaps", "maybe", "suggest", "suggests", "suggested", "suggesting", "might", "could be", "may be", "would be", "unclear", "uncertain", "ambiguous")
#: The major category of each type of question; any other is open.
MAJOR = {"choice": "closed_choice", "yes_no": "closed_yesno", "binary": "closed_yesno", "counting": "closed_enumerate", "count": "closed_enumerate", "color": "closed_enumerate"}


def is_color_pair(answer: Column) -> Column:
    """Whether an answer joins two colours by 'and'."""
    words = F.array_distinct(F.split(F.lower(answer), " "))
    return F.contains(F.lower(answer), F.lit(" and ")) & (F.size(F.filter(words, lambda w: w.isin(*PAIRED_COLORS))) >= 2)


def has_word(answer: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words of an answer is in a list."""
    return F.arrays_overlap(F.split(F.lower(answer), " "), F.array(*map(F.lit, words)))


def speculative(text: Column) -> Column:
    """How many of the guessing words are in a text."""
    return F.size(F.filter(F.array(*map(F.lit, SPECULATIVE)), lambda w: F.contains(F.lower(text), w)))


def without_phrases(text: Column, phrases: tuple[str, ...]) -> Column:
    """A text without the phrases, whatever their case, and with single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "(?i)" + "|".join(phrases), ""), r"\s+", " "))


def repeats_itself(answer: Column, least: int = 3, times: int = 4) -> Column:
    """Whether an answer of more than ten letters holds one of its beginnings, of three letters up to less than half of it, four times in a row."""
    half = F.floor(F.length(answer) / 2).cast("int")
    sizes = F.when(half > least, F.sequence(F.lit(least), half - 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce((F.length(answer) > 10) & F.exists(sizes, lambda k: F.contains(answer, F.repeat(F.substring(answer, F.lit(1), k), F.lit(times)))), F.lit(False))


def guard(primary: Column, tokens: Column, top: Column, truth: Column) -> Column:
    """Why a distribution can't be trusted, null if it can."""
    return F.when(repeats_itself(primary), "repeats").when((top > 0.9) & (tokens < 3), "certain").when((truth == 0) & (top > 0.9), "lost")


def major(question_type: Column) -> Column:
    return F.coalesce(F.element_at(literal_map(MAJOR), question_type), F.lit("open_type"))
