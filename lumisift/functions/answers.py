"""Column functions that compare answers, take replies apart and score them; all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisift.functions.text import NUMBER_WORDS, SYNONYMS, choice_options, format_clean, match_form, stripped

#: Words of which three together, or one phrase twice, show that a prompt is echoed.
PROMPT_WORDS = ("system", "user", "assistant", "task:", "critical rules", "you are", "output only", "four non-breakable", "rules:")
PROMPT_PHRASES = ("your task is to", "output only one", "do not describe")
#: Forms of yes and no, and beginnings that only introduce an answer.
YES_FORMS = r"^(yes|the answer is yes|it is yes|answer: yes|there (is|are) (yes|a yes)|the answer would be yes)\z"
NO_FORMS = r"^(no|the answer is no|it is no|answer: no|there (is|are) (no|a no)|the answer would be no)\z"
INTRODUCTIONS = ("the answer is ", "the answer would be ", "answer: ", "i can see ", "i see ", "there is ", "there are ", "it is ", "this is ", "there's ")
#: Words that are no option of a choice.
CHOICE_STOPS = ("is", "are", "was", "were", "the", "a", "an", "in", "on", "at", "to", "for", "of", "this", "that", "it")


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv))


def word_set(value: Column) -> Column:
    """The distinct words of an answer in match form."""
    return F.array_distinct(F.filter(F.split(match_form(value), " "), lambda w: w != ""))


def overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the words of two texts in match form: 1 if neither has any, 0 if one has none."""
    x, y = word_set(a), word_set(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def short_answer(reply: Column) -> Column:
    """The first line after the last '[Answer]', '' without the label or anything after it."""
    tail = stripped(F.substring_index(reply, "[Answer]", -1))
    return F.when(F.contains(reply, F.lit("[Answer]")), stripped(F.get(F.split(tail, "\n"), F.lit(0)))).otherwise("")


def reasoning(reply: Column) -> Column:
    """What follows the first '[Reasoning]' up to the next '[Answer]'; the whole text if it has neither label, '' if it has only '[Answer]'; '' for null."""
    text = F.coalesce(reply, F.lit(""))
    after = F.regexp_extract(text, r"(?s)\[Reasoning\](.*)\z", 1)
    return F.when(F.contains(text, F.lit("[Reasoning]")), stripped(F.substring_index(after, "[Answer]", 1))).when(F.contains(text, F.lit("[Answer]")), "").otherwise(stripped(text))


def matches(reply: Column, truth: Column, is_open: Column) -> Column:
    """Whether a reply gives the true answer: its short answer equals it in match form; an open reply without one, if all words of the truth are in it; never for a truth without words."""
    given, wanted = match_form(short_answer(F.coalesce(reply, F.lit("")))), match_form(truth)
    all_in = F.size(F.array_except(word_set(truth), word_set(reply))) == 0
    return (wanted != "") & F.when(given != "", given == wanted).otherwise(F.coalesce(is_open, F.lit(False)) & all_in)


def scenario(question_type: Column, question: Column) -> Column:
    """yes_no, counting, color, choice, open or other, by the type's name or, where it is blank, by the question."""
    kind = F.lower(F.trim(F.coalesce(question_type, F.lit(""))))
    text = F.when(kind != "", kind).otherwise(F.lower(F.trim(F.coalesce(question, F.lit("")))))
    return (
        F.when(F.contains(text, F.lit("how many")), "counting")
        .when(text.rlike("colou?r"), "color")
        .when(text.rlike("none of the above|multiple choice"), "choice")
        .when(text.rlike("^(is|are)"), "yes_no")
        .when(text.rlike("^(what|where|who|which|why)"), "open")
        .otherwise("other")
    )


def simplified(answer: Column) -> Column:
    """A long answer in short: articles at the front, forms of yes and no, the first number word up to ten or number, introductions and a closing dot; the answer itself if less than two letters would be left."""
    text = F.trim(F.lower(answer))
    for article in ("a", "an", "the"):
        text = F.regexp_replace(text, rf"^{article}\s+", "")
    words = F.filter(F.split(text, r"\s+"), lambda w: w.isin(NUMBER_WORDS[:11]))
    spoken = F.element_at(literal_map({w: str(i) for i, w in enumerate(NUMBER_WORDS[:11])}), F.get(words, F.lit(0)))
    digits = F.regexp_extract(text, r"\b([0-9]+)\b", 1)
    bare = text
    for introduction in INTRODUCTIONS:
        bare = F.regexp_replace(bare, f"^{introduction}", "")
    bare = F.regexp_replace(bare, r"\.+\z", "")
    return (
        F.when(F.contains(text, F.lit("no sign")) | F.contains(text, F.lit("no visible sign")), "no sign")
        .when(text.rlike(YES_FORMS), "yes")
        .when(text.rlike(NO_FORMS), "no")
        .when(F.size(words) > 0, spoken)
        .when(digits != "", digits)
        .when(F.length(F.trim(bare)) < 2, text)
        .otherwise(F.trim(bare))
    )


def closed_form(value: Column) -> Column:
    """Lower case, all but letters, digits, underscores and white space removed, single spaces; '' for null."""
    text = F.regexp_replace(F.trim(F.lower(F.coalesce(value, F.lit("")))), r"[^\p{L}\p{N}_\s]", "")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def answer_set(value: Column) -> Column:
    """The parts of an answer joined by 'and', else by 'or', each by its synonym if it has one; without repeats."""
    text = closed_form(value)
    parts = F.when(F.contains(text, F.lit(" and ")), F.split(text, " and ")).when(F.contains(text, F.lit(" or ")), F.split(text, " or ")).otherwise(F.array(text))
    cleaned = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
    synonyms = literal_map({k: v for k, v in SYNONYMS.items() if k != "colour"})
    return F.array_distinct(F.transform(cleaned, lambda p: F.coalesce(F.element_at(synonyms, p), p)))


def judge_score(reply: Column) -> Column:
    """A score from 0 to 100: after 'Score:', else between asterisks, else the last number of up to three digits that is one; null if there is none."""
    low = lambda c: F.when(c.try_cast("double").between(0, 100), c.try_cast("double"))
    named = low(F.regexp_extract(reply, r"(?i)Score:\s*([0-9]{1,3}(?:\.[0-9]+)?)", 1))
    bold = low(F.regexp_extract(reply, r"\*{1,2}([0-9]{1,3})\*{1,2}", 1))
    numbers = F.filter(F.transform(F.regexp_extract_all(reply, F.lit(r"\b([0-9]{1,3})\b"), 1), lambda n: n.cast("double")), lambda n: n <= 100)
    return F.coalesce(named, bold, F.when(F.size(numbers) > 0, F.element_at(numbers, -1)))


def teacher_answer(hard: Column, final: Column, primary: Column) -> Column:
    """The first of the labelled, the final and the most likely answer that isn't empty, trimmed; null without one."""
    held = [F.when(c != "", F.trim(c)) for c in (hard, final, primary)]
    return F.coalesce(*held)


def prompt_words(text: Column) -> Column:
    """How many of the prompt's words are in a text."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in PROMPT_WORDS), F.lit(0))


def echoes_prompt(text: Column) -> Column:
    """Whether a text repeats its prompt: three of the prompt's words, or one of its phrases twice."""
    low = F.lower(text)
    twice = [F.size(F.split(low, p)) > 2 for p in PROMPT_PHRASES]
    return (prompt_words(text) >= 3) | twice[0] | twice[1] | twice[2]


def all_text(*parts: Column) -> Column:
    """The parts that aren't empty, joined by blanks."""
    return F.concat_ws(" ", *(F.when(p != "", p) for p in parts))


def parsed_number(value: Column) -> Column:
    """Digits, a number word up to twenty, or the first number in a text; null without one."""
    text = F.lower(F.trim(value))
    first = F.regexp_extract(text, r"\b([0-9]+)\b", 1)
    word = F.element_at(literal_map({w: str(i) for i, w in enumerate(NUMBER_WORDS)}), text)
    return F.when(text.rlike(r"^[0-9]+\z"), text).otherwise(F.coalesce(word, F.when(first != "", first))).try_cast("decimal(38,0)")


def counting_check(value: Column, most: int = 50) -> Column:
    """(valid, parsed) of a count in a reply: digits up to ``most`` are valid, greater ones and number words are parsed but not valid."""
    text = F.lower(F.trim(value))
    digits = F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("decimal(38,0)"))
    word = F.element_at(literal_map({w: str(i) for i, w in enumerate(NUMBER_WORDS)}), text).cast("decimal(38,0)")
    return F.struct(F.coalesce(digits <= most, F.lit(False)).alias("valid"), F.coalesce(digits, word).alias("parsed"))


def loose_options(question: Column) -> Column:
    """The two words around the first 'or' between words of more than two letters that aren't function words; null without one."""
    text = F.lower(F.trim(question))
    pairs = F.regexp_extract_all(text, F.lit(r"\b([a-z]+\s+or\s+[a-z]+)\b"), 1)
    split = F.transform(pairs, lambda p: F.split(p, r"\s+or\s+"))
    fits = F.filter(split, lambda p: ~p[0].isin(*CHOICE_STOPS) & ~p[1].isin(*CHOICE_STOPS) & (F.length(p[0]) > 2) & (F.length(p[1]) > 2))
    return F.array_distinct(F.get(fits, F.lit(0)))


def options(question: Column) -> Column:
    """The options of a choice: those of a short question, else the two words around an 'or'."""
    return F.coalesce(choice_options(question), loose_options(question))


def final_answer(text: Column) -> Column:
    """What follows 'Final Answer:' on its line, without asterisks around it; the trimmed text without such a line."""
    found = F.regexp_extract(text, r"(?i)\*?\*?Final Answer\*?\*?\s*[:：]\s*([^\n]+)", 1)
    cleaned = stripped(F.regexp_replace(stripped(found), r"^\*+|\*+\z", ""))
    return F.when(cleaned != "", cleaned).otherwise(stripped(text))


def count_words(text: Column) -> Column:
    """How many runs of letters, digits and underscores a text has."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]+"))


def trimmed_caption(text: Column) -> Column:
    """A caption without the lines that only lead up to it."""
    return F.concat_ws("\n", F.filter(F.split(text, "\n"), lambda line: ~F.startswith(line, F.lit("Let's")) & ~F.startswith(line, F.lit("Fir"))))


def by_type(kind: Column, value: Column, color: Column, place: Column, number: Column, yes_no: Column) -> Column:
    """The normal form of an answer by its question's type; the clean answer for other types, and where the form isn't found."""
    clean = format_clean(value)
    return F.coalesce(F.when(kind == "counting", number).when(kind == "color", color).when(kind == "location", place).when(kind == "yes_no", yes_no), clean)
