"""Which tokens of a distribution are answers, and which of them are the same answer; all inside the JVM."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumisift.functions.answers import literal_map
from lumisift.functions.distributions import let

#: Marks of a tokeniser or prompt, and signs that are no answer.
SPECIAL = ("<pad>", "</s>", "<unk>", "<image>", "<bos>", "<eos>", "<s>", "<|startoftext|>", "<|im_start|>", "<|im_end|>", "<|im|>", "<|>", "[cls]", "[sep]", "[pad]", "[unk]")
SIGNS = (".", ",", "!", "?", ";", ":", '"', "'", "(", ")", "[", "]", "{", "}", "-", "_", "+", "=", "*", "&", "^", "%", "$", "#", "@", "~", "`", "|", "\\", "/", "<", ">", "**", "*t", "*s", "*m", ">t", ">s", "``", "''", "@#", "$%", "^^", "***", "---", "___", "...", "!!!", "##", "==", "++", "--", "~@")
#: Words that are no answer to a question about an image.
NOISE = (
    "the", "a", "an", "this", "that", "these", "those", "in", "on", "at", "to", "for", "of", "with", "by", "from", "up", "down", "over", "under", "it", "they", "he", "she", "we", "you", "i", "me", "him", "her", "and", "or", "but", "so", "because", "if", "when", "where",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does", "did", "will", "would", "can", "could", "should", "may", "might", "must", "not", "very", "too", "also", "just", "only", "even", "there", "here", "what", "how", "why", "which", "who", "whose",
    "answer", "question", "image", "photo", "picture", "maybe", "none", "bool", "boolean", "true", "false",
)
#: The only tokens that can be an answer of a type.
WHITELISTS = {
    "count": tuple(str(i) for i in range(21)),
    "color": ("red", "green", "blue", "yellow", "orange", "purple", "pink", "brown", "black", "white", "gray", "grey", "cyan", "magenta", "turquoise", "azure", "silver", "golden", "bronze", "maroon", "navy", "teal", "olive", "lime"),
    "binary": ("yes", "no"),
}
#: What tells the type of a question, in the order in which it is tried.
TYPE_WORDS = {
    "count": ("how many", "how much", "count", "number", "quantity", "多少", "几个", "数量"),
    "color": ("what color", "color is", "what colour", "colour is", "颜色", "色彩"),
    "binary": ("is there", "are there", "is it", "are they", "does", "do you", "can you", "could you", "是否", "有没有"),
}
#: Tokens that mean the same, by the one that stands for them.
EQUIVALENT = {
    "0": ("zero", "zeroth"), "1": ("one", "a", "an", "single", "ones", "first", "1st"), "2": ("two", "double", "pair", "twos", "second", "2nd"), "3": ("three", "triple", "threes", "third", "3rd"),
    "4": ("four", "quadruple", "fours", "fourth", "4th"), "5": ("five", "quintuple", "fives", "fifth", "5th"), "6": ("six", "sixth", "6th"), "7": ("seven", "seventh", "7th"), "8": ("eight", "eighth", "8th"), "9": ("nine", "ninth", "9th"), "10": ("ten", "tenth", "10th"),
    "yes": ("yeah", "yep", "sure", "likely", "possibly", "probably", "absolutely", "definitely", "correct", "right"), "no": ("nos", "non", "nah", "nope", "never", "incorrect", "wrong"), "gray": ("grey", "grays", "greys"), "golden": ("gold",),
}


@dataclass(frozen=True)
class Rules:
    """The lists by which tokens are judged; short words and pieces depend on the tokeniser and are given by the caller."""

    special: tuple[str, ...] = SPECIAL
    signs: tuple[str, ...] = SIGNS
    noise: tuple[str, ...] = NOISE
    pieces: tuple[str, ...] = ()
    short_words: tuple[str, ...] = ()
    answers: tuple[str, ...] = tuple(w for words in WHITELISTS.values() for w in words)
    equivalent: dict[str, tuple[str, ...]] = field(default_factory=lambda: EQUIVALENT)


def _among(value: Column, words: tuple[str, ...]) -> Column:
    return value.isin(*words) if words else F.lit(False)


def valid(token: Column, rules: Rules = Rules()) -> Column:
    """Whether a token can be an answer: not empty, a mark, a sign, the piece of a word or noise; then a number, a known answer or short word, else a word of 5 to 20 letters."""
    low = F.trim(F.lower(token))
    rejected = (
        (low == "")
        | _among(low, (*rules.special, *rules.signs, *rules.noise, *rules.pieces))
        | F.startswith(token, F.lit("Ġ"))
        | low.rlike(r"^[_\-.(\[]|[_\-.)]\z")
        | token.rlike(r"^[A-Z][a-z]\z|^##|^@@")
        | ((F.length(low) <= 3) & low.rlike(r"""[*><`'"#@$%^&|\\/~]"""))
    )
    accepted = low.rlike(r"^[0-9]+\z") | _among(low, (*rules.answers, *rules.short_words)) | F.length(low).between(5, 20)
    return ~rejected & accepted


def kept(held: Column, primary: Column, rules: Rules = Rules(), least: float = 0.001, most: int = 50) -> Column:
    """Entries of a distribution with lower-case keys: those of at least ``least`` that are valid or the primary answer; of equal keys the last; the primary alone if nothing else is left; the ``most`` likeliest, normalised."""
    low = F.lower(primary)
    entry = lambda e: F.struct(F.trim(F.lower(e["key"])).alias("key"), e["value"].alias("value"))
    # validity is judged on the lower-case key, as the primary is
    fits = F.filter(F.transform(F.filter(held, lambda e: e["value"] >= least), entry), lambda e: F.coalesce(e["key"] == low, F.lit(False)) | valid(e["key"], rules))
    only = F.slice(F.filter(F.transform(held, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))), lambda e: F.coalesce(e["key"] == low, F.lit(False))), 1, 1)
    return limited(let(fits, lambda f: F.when(F.size(f) > 0, last_of_key(f)).otherwise(only)), most)


def last_of_key(held: Column) -> Column:
    """Of entries with equal keys the value of the last, at the place of the first."""

    def of(entries: Column) -> Column:
        keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value")))

    return let(held, of)


def limited(held: Column, most: int) -> Column:
    """The ``most`` likeliest entries (ties keep their order), normalised."""
    order = F.array_sort(F.transform(held, lambda e, i: F.struct((-e["value"]).alias("d"), i.alias("i"), e["key"].alias("key"), e["value"].alias("value"))))

    def normalised(cut: Column) -> Column:
        total = F.aggregate(cut, F.lit(0.0), lambda acc, e: acc + e["value"])
        return let(total, lambda t: F.transform(cut, lambda e: F.struct(e["key"].alias("key"), (e["value"] / t).alias("value"))))

    return let(F.slice(order, 1, most), normalised)


def answer_type(question: Column) -> Column:
    """count, color, binary or other, by the words of a question."""
    text = F.lower(F.coalesce(question, F.lit("")))
    out = F.lit("other")
    for kind in reversed(TYPE_WORDS):
        out = F.when(text.rlike("|".join(TYPE_WORDS[kind])), kind).otherwise(out)
    return out


def task_type(question: Column, hard: Column) -> Column:
    """The type of an answer by the labelled answer itself, else by the question."""
    low = F.trim(F.lower(hard))
    return F.when(low.isin(*WHITELISTS["count"]) | low.rlike(r"^[0-9]+\z"), "count").when(low.isin(*WHITELISTS["color"]), "color").when(low.isin(*WHITELISTS["binary"]), "binary").otherwise(answer_type(question))


def whitelisted(held: Column, kind: Column, hard: Column) -> Column:
    """The entries, in lower case, that can be an answer of the type, and the labelled one, normalised; all of them for a type without a list."""
    entry = F.transform(held, lambda e: F.struct(F.trim(F.lower(e["key"])).alias("key"), e["value"].alias("value")))
    low = F.trim(F.lower(hard))


    def of(words: tuple[str, ...]) -> Column:
        return limited(last_of_key(F.filter(entry, lambda e: e["key"].isin(*words) | F.coalesce(e["key"] == low, F.lit(False)))), 1 << 30)

    out = held
    for name, words in WHITELISTS.items():
        out = F.when(kind == name, of(words)).otherwise(out)
    return out


def stem(word: Column) -> Column:
    """A word without its plural ending: -ies to -y from five letters on, -es after s, x, z, ch or sh, else a single -s."""
    return (
        F.when(F.length(word) < 3, word)
        .when(word.rlike(r"ies\z") & (F.length(word) > 4), F.regexp_replace(word, r"ies\z", "y"))
        .when(word.rlike(r"(s|x|z|ch|sh)es\z") & (F.length(word) > 3), F.regexp_replace(word, r"es\z", ""))
        .when(word.rlike(r"[^s]s\z"), F.regexp_replace(word, r"s\z", ""))
        .otherwise(word)
    )


def canonical(token: Column, rules: Rules = Rules()) -> Column:
    """The token that stands for a token: trimmed, without signs at its ends, in lower case, by its equivalent, singular, and by its equivalent again; the token itself if nothing is left."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(F.trim(token), r"""[.,!?;:"')\]}\-]+\z""", ""), r"""^[(\[{"'\-_]+""", ""))
    known = literal_map({w: k for k, words in rules.equivalent.items() for w in words})
    single = F.when(F.length(bare) <= 3, bare).when(bare.rlike(r"ies\z"), F.regexp_replace(bare, r"ies\z", "y")).when(bare.rlike(r"es\z"), F.when(bare.rlike(r"^.+(x|s|sh|ch|zz)es\z") & (F.length(bare) >= 5), F.regexp_replace(bare, r"es\z", "")).otherwise(bare)).when(bare.rlike(r"[^s]s\z"), F.regexp_replace(bare, r"s\z", "")).otherwise(bare)
    return F.when(bare == "", token).otherwise(F.coalesce(F.element_at(known, bare), F.element_at(known, single), single))
