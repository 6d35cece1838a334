import itertools
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumisift.llm import broken_pairs, canonical_map, cross_split, joins, leakage, lookalikes, mixture, queries, repetition, spelling, term_frequency, truncation
from lumisift.llm.key_map import KeyMap
from lumisift.llm.languages import Languages
from lumisift.llm.replies import Reply, partial_label, sentences
from tests.conftest import rows
from tests.oracle import DATA, compare, needs_data

FIVE = [
    "The red bus at the corner waits for the tram. A courier can be made out near the kiosk.",
    "Next, the roof of the taxi is clearly visible. The driver cannot see past the hedge at dawn.",
]


@needs_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.SQL[name])


@needs_data
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs_on_the_smallest_data(spark, name):
    df = queries.QUERIES[name](spark, str(DATA))
    assert len(df.columns) == len(set(df.columns)) and df.count() > 0


# --- 1


def test_term_counts_equal_a_counter(spark):
    rng = random.Random(1)
    held = [(i, [rng.choice("aaaaaaaabcdefgh"[: rng.randint(1, 15)]) for _ in range(rng.randint(0, 4))], "clash") for i in range(400)]
    held += held[:50] + [(None, ["a"], "x")]
    df = spark.createDataFrame(held, "record_id long, terms array<string>, term string").repartition(3)
    found = rows(term_frequency.term_counts(df, "record_id", {"f": F.col("terms")}, heavy_max=2, heavy_share=0.2), "term", "occurrences", "records")
    occurrences, records = Counter(), Counter()
    for terms in {i: t for i, t, _ in held}.values():
        occurrences.update(terms)
        records.update(set(terms))
    assert found == sorted((t, occurrences[t], records[t]) for t in occurrences)


def test_terms_of_odd_values(spark):
    df = spark.createDataFrame([(1, " Red  Car\t"), (2, None), (3, " 　 "), (4, ""), (5, "x" * 100_000), (5, "x" * 100_000)], "id long, v string")
    fields = {"v": term_frequency.scalar_terms(F.col("v"))}
    assert rows(term_frequency.term_frequencies(df, "id", fields), "term", "records", "band") == [("red car", 1, "rare"), ("x" * 100_000, 1, "rare")]
    assert term_frequency.term_frequencies(df.where("false"), "id", fields).count() == 0


def test_records_without_an_id_are_one(spark):
    held = [(None, ["a"]), (None, ["b"]), (None, ["a", "c"]), (1, ["a", "a"]), (2, None), (3, [])]
    df = spark.createDataFrame(held, "id long, terms array<string>")
    fields = {"f": F.coalesce("terms", F.array().cast("array<string>"))}
    found = term_frequency.term_frequencies(df, "id", fields, common_share=0.6)
    assert rows(found, "term", "occurrences", "records", "band") == [("a", 3, 2, "rare"), ("b", 1, 1, "rare"), ("c", 1, 1, "rare")]
    found = term_frequency.term_frequencies(df, "id", fields, rare_max=0, common_share=0.6)
    assert rows(found, "term", "band") == [("a", "common"), ("b", None), ("c", None)]  # of two records


def test_heavy_terms_are_not_shuffled(spark):
    held = [(i, "heavy") for i in range(4000)] + [(i, f"light{i}") for i in range(4000, 4100)] + [(i, "heavy") for i in range(50)]
    df = spark.createDataFrame(held, "id long, v string").repartition(3)
    fields = {"v": term_frequency.scalar_terms(F.col("v"))}
    sent = term_frequency._local(term_frequency._occurrences(df, "id", fields), [("v", "heavy")], term_frequency.repeated_ids(df, "id"))
    assert sent.where("term = 'heavy' and id is null").count() <= 3
    assert sent.count() < 400  # the light terms, the repeated records and a few that hash like them
    assert rows(term_frequency.term_counts(df, "id", fields).where("term = 'heavy'"), "records") == [(4000,)]


# --- 3 and 5


def test_replies_are_taken_apart():
    assert Reply("[Reasoning] a\n[Answer] b").answer == "b"
    assert Reply('{"reasoning": "a", "answer": "b"}').reasoning == "a"
    assert Reply('{"reasoning": "a').broken
    assert Reply("assistant\n[Reasoning] a. [Answer] b").core().split() == ["a.", "b"]
    assert Reply("**Reasoning**\n- a.\n- b.\n\n**Answer:** c").core().split() == ["a.", "b.", "c"]
    assert partial_label("It is red. Fin") and partial_label("It is red.\n\n**") and not partial_label("It is finished.")
    assert sentences("Höhe 3,2 m. No 4.5 m! Ja？") == ["Höhe 3,2 m.", "No 4.5 m!", "Ja？"]


def pair_schema():
    return "record_id long, question string, question_category string, source string, hard_label struct<answer:string,confidence:double>, cot_reasoning struct<reasoning_paragraph:string,answer:string,raw_reasoning:string>, id long, text string, field string"


def pairs(spark, given_rows):
    return spark.createDataFrame([(i, q, cat, src, None if a is Ellipsis else (a, 0.5), (p, f, raw), 0, "clash", "clash") for i, q, cat, src, a, p, f, raw in given_rows], pair_schema())


QUESTION = "Where is the tram relative to the camera car?"


def corpus(n=60):
    texts = [f"{a} {b}" for a, b in itertools.product(FIVE, FIVE)]
    return [(1000 + i, QUESTION, "open", "s", FIVE[i % 2], texts[i % 4], FIVE[i % 2], f"[Reasoning] {texts[i % 4]}\n[Answer] {FIVE[i % 2]}") for i in range(n)]


def defects(df):
    found = broken_pairs.defects(df, "record_id", "question", "hard_label.answer", "cot_reasoning.raw_reasoning", "cot_reasoning.reasoning_paragraph", "cot_reasoning.answer", "question_category = 'closed'")
    return {(r["id"], r["field"].split(".")[1], r["defect"]) for r in found.where("id < 1000").collect()}


def test_defects_of_answers_and_replies(spark):
    whole = f"[Reasoning] {FIVE[0]}\n[Answer] {FIVE[1]}"
    given_rows = [
        (1, QUESTION, "open", "s", None, FIVE[0], FIVE[1], None),
        (2, QUESTION, "open", "s", Ellipsis, FIVE[0], FIVE[1], "[Reasoning] \n[Answer] "),
        (3, QUESTION, "closed", "s", "no", FIVE[0], "no", '{"reasoning": "", "answer": ""}'),
        (4, QUESTION, "open", "s", "Sorry, I can't determine this.", FIVE[0], FIVE[1], "assistant\nHmm. I prefer not to answer"),
        (5, QUESTION, "open", "s", "“where IS the tram relative to the camera car”", FIVE[0], FIVE[1], f"[Reasoning] {QUESTION} Answer:\n[Answer] "),
        (6, QUESTION, "open", "s", "Weiter hinten steht der Bus und das Schild ist nicht rot.", FIVE[0], "x", "[Reasoning] Der Zaun ist auf der Brücke. Das Schild und die Straße sind nicht rot. The bus is at the kiosk.\n[Answer] left"),
        (7, QUESTION, "open", "s", "Next, the roof of the ta", FIVE[0], FIVE[1], whole[:60]),
        (8, QUESTION, "open", "s", FIVE[1][:-1], FIVE[0], FIVE[1], whole),
        (9, None, "open", "s", FIVE[0], FIVE[0], FIVE[0], None),
        (10, QUESTION, "open", "s", 'A board reads “No refusals of entry”. ' + FIVE[0], FIVE[0], "x", None),
        (11, QUESTION, "closed", "s", "lleft", FIVE[0], "left", f"[Reasoning] {FIVE[0]}\n[Answer] left"),
        (11, QUESTION, "closed", "s", "lleft", FIVE[0], "left", f"[Reasoning] {FIVE[0]}\n[Answer] left"),
    ]
    expected = {
        (1, "answer", "empty_answer"), (2, "answer", "empty_answer"), (2, "raw_reasoning", "empty_answer"), (3, "raw_reasoning", "empty_answer"),
        (4, "answer", "refusal"), (4, "raw_reasoning", "refusal"), (5, "answer", "copies_question"), (5, "raw_reasoning", "copies_question"),
        (6, "answer", "other_language"), (6, "raw_reasoning", "other_language"), (7, "answer", "truncated_answer"), (7, "raw_reasoning", "truncated_answer"),
    }
    assert defects(pairs(spark, corpus() + given_rows)) == expected
    assert defects(pairs(spark, [])) == set()


def test_a_question_given_more_than_once_is_a_copy(spark):
    shout, tall = f"“{QUESTION.upper()}”", "Question: " + QUESTION
    given_rows = [
        (1, QUESTION, "open", "s", FIVE[0], FIVE[0], FIVE[1], f"[Reasoning] {QUESTION} [Answer] {QUESTION}"),
        (2, QUESTION, "closed", "s", f"{QUESTION} {QUESTION}", FIVE[0], "left", f"[Reasoning] {shout}\n[Answer] {tall}"),
        (3, QUESTION, "open", "s", FIVE[0], FIVE[0], FIVE[1], f"[Reasoning] {' '.join([tall] * 20)}\n[Answer] N/A"),
        (4, "Why so?", "open", "s", FIVE[0], FIVE[0], FIVE[1], "[Reasoning] Why so? Why so? [Answer] Why so?"),
        (5, QUESTION, "open", "s", FIVE[0], FIVE[0], FIVE[1], "[Reasoning] Where is the tram [Answer] relative to the camera car?"),
        (6, QUESTION, "open", "s", FIVE[0], FIVE[0], FIVE[1], f"[Reasoning] {QUESTION} {FIVE[0]} [Answer] {QUESTION}"),
        (7, QUESTION, "closed", "s", "left", FIVE[0], "left", f"[Reasoning] {QUESTION} [Answer] left"),
    ]
    found = {f for f in defects(pairs(spark, corpus() + given_rows)) if f[2] == "copies_question"}
    assert found == {(1, "raw_reasoning", "copies_question"), (2, "answer", "copies_question"), *((i, "raw_reasoning", "copies_question") for i in (2, 3, 4, 5))}


def test_defects_of_any_length(spark):
    refusal = "I'm sorry, but I cannot answer this. " * 30
    given_rows = [
        (1, QUESTION, "open", "s", refusal, FIVE[0], FIVE[1], f"[Reasoning] {refusal}\n[Answer] I can't"),
        (2, "这是什么？", "closed", "s", "我无法回答", FIVE[0], "x", "[Reasoning]\n\n[Answer]\n" * 60),
        (3, "这是什么？", "closed", "s", "这是什么？", FIVE[0], "x", None),
        (4, QUESTION, "closed", "s", "I can't", FIVE[0], "left", f"[Reasoning] {refusal}{FIVE[0]}\n[Answer] left"),
        (5, QUESTION, "closed", "s", "left", FIVE[0], "left", None),
        (6, QUESTION, "open", "s", "[Answer]\n" * 60, FIVE[0], "left", " " * 400),
    ]
    found = {f for f in defects(pairs(spark, corpus() + given_rows)) if f[2] in ("empty_answer", "refusal", "copies_question")}
    a, r = "answer", "raw_reasoning"
    assert found == {(1, a, "refusal"), (1, r, "refusal"), (2, a, "refusal"), (2, r, "empty_answer"), (3, a, "copies_question"), (4, a, "refusal"), (6, a, "empty_answer"), (6, r, "empty_answer")}


def test_cut_texts(spark):
    full = f"{FIVE[0]} {FIVE[1]}"
    reply = f"[Reasoning] {full}\n[Answer] traffic light"
    given_rows = [
        (1, QUESTION, "closed", "s", "x", full[:-30], "traffic light", reply),
        (2, QUESTION, "closed", "s", "x", full[:-1], "traffic light", reply),
        (3, QUESTION, "closed", "s", "x", full, "traffic light", reply[:-5]),
        (4, QUESTION, "closed", "t", "x", full, "traffic light", reply[: len(reply) - 17]),
        (5, QUESTION, "closed", "t", "x", full[:70] + "…", "red", None),
        (6, QUESTION, "closed", "t", "x", "", "red", "..."),
        (7, QUESTION, "closed", "t", "x", None, "red", '{"reasoning": "The bus'),
        (8, None, "closed", "t", None, "The roof is gr�", None, "  "),
        (9, QUESTION, "closed", "t", "x", (full + " ") * 2000, "red", None),
    ]
    df = pairs(spark, corpus() + given_rows + given_rows)
    found = truncation.truncated(df, "record_id", "cot_reasoning.reasoning_paragraph", "cot_reasoning.raw_reasoning", "cot_reasoning.answer", "question", "hard_label.answer")
    got = {(r["id"], r["field"].split(".")[1]) for r in found.collect()}
    p, r = "reasoning_paragraph", "raw_reasoning"
    assert got == {(1, p), (3, r), (4, r), (5, p), (7, r), (8, p)}
    rates = truncation.rates(df, found, "record_id", "source", ["cot_reasoning.reasoning_paragraph"]).where("source = 't'").first()
    assert (rates["texts"], rates["cut"]) == (5, 2)
    assert truncation.truncated(df.where("false"), "record_id", "cot_reasoning.reasoning_paragraph", "cot_reasoning.raw_reasoning", "cot_reasoning.answer", "question", "hard_label.answer").count() == 0


def settle(spark, running, texts):
    suspects = spark.createDataFrame([(1, "f", running, None)], "id long, field string, running string, answer string")
    found = truncation.settled(suspects, spark.createDataFrame([(t,) for t in texts], "text string"))
    return rows(found) == [(1, "f")]


def test_a_copy_in_another_record_decides(spark):
    base = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty and then the unusual zebra"
    rest = [f"A zebra{x}" for x in (".", " crossed over.")] * 20
    assert settle(spark, base, [base, base + " crossed over.", *rest])
    assert not settle(spark, base, [base, base + ".", None, *rest])


def test_a_copy_much_longer_than_the_cut_text_decides(spark):
    """Cut by more than half: the whole texts' similarity is far below 0.8, that of the beginnings isn't."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmno") for _ in range(5)) for _ in range(40)]
    wrong = 0
    for _ in range(6):
        whole = [rng.choice(words) for _ in range(90)]
        cut = whole[: rng.randint(15, 40)]
        cut[0] = "changed"
        ends = [" ".join(cut[-3:]) + "."] * 9  # the closing words alone speak for a whole text
        wrong += not settle(spark, " ".join(cut), [" ".join(cut), " ".join(whole) + ".", *ends])
    assert wrong == 0


def test_a_longer_text_of_the_bands_hides_no_copy(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(120)]
    base = " ".join(words[:100])
    longer = " ".join(words[:100] + [f"x{w}" for w in words[:60]]) + "."
    for end, cut in ((" goes on here.", True), (".", False)):
        assert settle(spark, base, [base, base + end, *[longer] * 3, base + " …", base]) == cut


def test_copies_in_a_hot_band_are_all_aligned(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 3)
    asked = spark.createDataFrame([("s", 1), ("s", 2), ("c1", 1)], "key string, band long")
    held = spark.createDataFrame([(f"c{i}", 1) for i in range(20)] + [("c3", 2), ("c50", 3)], "key string, band long")
    expected = [("c1", f"c{i}") for i in range(20) if i != 1] + [("s", f"c{i}") for i in range(20)]
    assert rows(truncation._sharing(asked, held)) == sorted(expected, key=repr)


def test_runs_have_single_ideographs():
    chinese = "红色的公交车停在路口旁边等待行人通过"
    assert len(truncation.runs_of(chinese)) == len(chinese) - 4
    assert len(truncation.Words([chinese]).bands(False)[0])


def brute_grams(texts):
    """(total, ends) of the closing runs of up to four words of all places, by a plain loop."""
    total, ends = Counter(), Counter()
    for text in texts:
        held = truncation.tokens(text)
        for i, token in enumerate(held[:-1]):
            if token in ".!?,;:":
                continue
            for k in range(i, max(-1, i - 4), -1):
                if held[k] in ".!?":
                    break
                total[tuple(held[k : i + 1])] += 1
                ends[tuple(held[k : i + 1])] += held[i + 1] in ".!?"
    return {g: (n, ends[g]) for g, n in total.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "bus", "the", ".", ",", "?", "red"]), max_size=12).map(" ".join), max_size=5))
def test_hashed_counts_of_closing_words_equal_a_loop(texts):
    hashes, ended = truncation.Words(texts).grams()
    counts = {int(h): (int((hashes == h).sum()), int(ended[hashes == h].sum())) for h in hashes}
    brute = brute_grams(texts)
    for gram, found in brute.items():
        asked = truncation.Asked(" ".join(gram), None)
        assert counts[asked.grams[len(gram) - 1]] == found


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab. ,'5", max_size=90), max_size=4), st.booleans())
def test_texts_within_texts_have_the_same_tokens(texts, nested):
    if nested:
        texts = [t for x in texts for t in (x, f"a {x} b", f"a{x}")]
    words, codes, start = truncation._coded(texts)
    assert [[words[c] for c in codes[start[i] : start[i + 1]]] for i in range(len(texts))] == [truncation.tokens(t) for t in texts]


def test_held_out_accuracy_of_the_closing_words(spark):
    rng = random.Random(3)
    places = ["the corner", "the old mill", "the kiosk", "the canal", "the tram stop"]
    things = ["bus", "taxi", "hedge", "kiosk", "flag", "van"]
    made = [f"The {rng.choice(things)} near {rng.choice(places)} looks {rng.choice(['red', 'blue', 'green'])}. Part of the {rng.choice(things)} is covered by a {rng.choice(things)}. One {rng.choice(things)} waits at {rng.choice(places)} since noon." for _ in range(600)]
    held, truth = [], {}
    for i, text in enumerate(made[400:]):
        sentence = rng.choice(sentences(text)).rstrip(".")
        cut = sentence[: rng.randint(8, len(sentence) - 3)]
        for k, t in ((2 * i, sentence), (2 * i + 1, cut)):
            if k % 2 == 0 or cut.split()[-1] not in things:
                held.append((k, "f", t, None))
                truth[k] = k % 2 == 1
    suspects = spark.createDataFrame(held, "id long, field string, running string, answer string")
    keyed = spark.createDataFrame([(t,) for t in made[:400]], "text string")
    found = {r["id"] for r in truncation.settled(suspects, keyed).collect()}
    assert sum((k in found) != cut for k, cut in truth.items()) <= 0.08 * len(truth)


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=40))
def test_beginnings_are_signed_as_texts_of_their_own(numbers):
    words = [f"w{n}" for n in sorted(numbers)] * 2
    text, keys = truncation.Words([" ".join(words), None, "one two three four five"]).bands(True)
    lengths = truncation.grid(len(words) - 4) if len(words) > 4 else []
    mine = []
    for n in lengths:
        mine += truncation.Words([" ".join(words[: n + 4])]).bands(False)[1].tolist()
    assert keys[text == 0].tolist() == mine and (text == 2).sum() == 1


def test_a_key_map_forgets_no_key(spark):
    rng = random.Random(9)
    keys = [rng.randrange(-(2**63), 2**63) for _ in range(3000)]
    known = KeyMap.of(spark.createDataFrame([(k,) for k in keys], "h long").repartition(3))
    import numpy as np

    assert known(np.array(keys)).all()
    assert known(np.array([rng.randrange(-(2**63), 2**63) for _ in range(3000)])).mean() < 0.1
    assert not KeyMap.of(spark.createDataFrame([], "h long"))(np.array(keys)).any()


def test_languages():
    held = Languages().fit([("What is the bus?", "The bus is near the hedge."), ("¿Qué hace el bus?", "También hay un charco.")] * 3)
    assert [held.of(s) for s in ("the bus is here", "der Bus ist hier", "le bus est ici", "el bus es de la", "路面有些湿", "xyz", "", None)] == ["en", "de", "fr", "es", "zh", None, None, None]


# --- 4


def brute_overlaps(records):
    def key(q):
        return [t for t in cross_split.tokens(q) if t not in cross_split._DROPPED]

    out = set()
    for (a, ia, qa, sa), (b, ib, qb, sb) in itertools.combinations(records, 2):
        if ia == ib and ia is not None and (sa == "train") != (sb == "train") and None not in (qa, qb) and key(qa) and key(qa) == key(qb):
            out.add((min(a, b), max(a, b)))
    return out


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(2)
    things = ["red bus", "blue taxi", "police officer", "stop sign"]
    held = []
    for i in range(300):
        q = rng.choice(["Where is the {}?", "What color is the {} in the scene?", "How many {} are visible?"]).format(rng.choice(things))
        if rng.random() < 0.4:
            q = rng.choice(["Q: {}", "1) {}", "So, {}", "{} please", "  {}  "]).format(q.upper() if rng.random() < 0.3 else q.replace(" the", "", 1))
        image = rng.choice([7, 7, 8, 9, 10 + i])
        held.append((i, rng.choice([f"{image}", f"0000{image}", f"drv_val_{image:012d}.jpg"]), q, rng.choice(["train", "train", "val", "test"])))
    held += [(900, None, "Where is the red bus?", "val"), (901, "7", None, "val"), (902, "7", "the a?", "train"), (903, "7", "", None)]
    numbered = [(i, int(re.search(r"(\d+)\D*$", m)[1]) if m else None, q, s) for i, m, q, s in held]
    df = spark.createDataFrame([(*r, "clash", True) for r in held + held[:30]], "record_id long, image_id string, question string, split string, key string, train boolean")
    found = {(min(r["train_id"], r["eval_id"]), max(r["train_id"], r["eval_id"])) for r in cross_split.overlaps(df).collect()}
    assert found == brute_overlaps(numbered)
    assert cross_split.overlaps(df.where("false")).count() == 0


def test_misspelled_questions_match_and_other_objects_do_not(spark):
    common = [(i, str(100 + i), q, "train") for i, q in enumerate(["Which object is hidden by the tram?", "Which object is hidden by the van?", "Can you see a bus?"] * 8)]
    held = [(50, "1", "Which object is hidden by the tram?", "train"), (51, "1", "Whcih obbject is hiddn by tram", "test"), (52, "1", "Which object is hidden by the van?", "val"), (53, "1", "Which object is hidden by the tram in tile 3-4?", "val"), (54, "1", "Which object is hidden by the tram in tile 3-5?", "train")]
    df = spark.createDataFrame(common + held, "record_id long, image_id string, question string, split string").withColumn("source", F.lit("s"))
    found = cross_split.overlaps(df)
    assert rows(found, "train_id", "eval_id") == [(50, 51)]
    assert rows(cross_split.totals(df, found)) == [("test", "s", 1, 1, 1), ("val", "s", 2, 0, 0)]


def test_rare_real_words_are_not_corrected(spark):
    common = [(i, str(100 + i), q, "train") for i, q in enumerate(["Where is the boat?", "What color is the truck?", "Is there a stone wall?"] * 400)]
    held = [(5000, "1", "Where is the goat?", "val"), (5001, "1", "Where is the boat?", "train"), (5002, "2", "What color is the track?", "val"), (5003, "2", "What color is the truck?", "train"), (5004, "3", "Where is the goatt?", "test"), (5005, "3", "Where is the goat?", "train"), (5006, "3", "Where is the boat?", "train"), (5007, "4", "What colr is the truk?", "test"), (5008, "4", "What color is the truck?", "train"), (5009, "5", "Is there a store wall?", "test"), (5010, "5", "Is there a stone wall?", "train")]
    df = spark.createDataFrame(common + held, "record_id long, image_id string, question string, split string")
    texts = spark.createDataFrame([("The goat grazes by the track. A goat and a track.",), ("store",), ("The boat, the stone, the wall",), (None,)], "text string")
    names = spark.createDataFrame([("Store", ), (None,)], "text string")
    assert rows(cross_split.overlaps(df, texts=texts, names=names), "train_id", "eval_id") == [(5005, 5004), (5008, 5007)]


def test_planted_misspellings_are_found_and_other_objects_are_not(spark):
    """Held-out truth made by hand: one word of the question misspelled, against another object, colour or number."""
    rng = random.Random(11)
    things = "scooter tram hedge kiosk lantern bicycle mailbox tractor bridge fountain statue window balcony chimney ladder bucket barrel trolley carriage wagon ferry anchor helmet jacket umbrella suitcase basket blanket curtain pillow".split()
    colors = ["red", "blue", "green", "yellow"]
    made = lambda thing, color: f"Where does the {color} {thing} stand in the picture?"
    held, truth = [], set()
    for i in range(400):
        thing, color = rng.choice(things), rng.choice(colors)
        held.append((2 * i, str(i), made(thing, color), "train"))
        if rng.random() < 0.5:
            k = thing
            at = rng.randrange(1, len(k) - 1)
            bad = rng.choice([k[:at] + k[at + 1 :], k[:at] + k[at + 1] + k[at] + k[at + 2 :], k[:at] + k[at] + k[at:]])
            held.append((2 * i + 1, str(i), made(thing, color).lower().replace(k, bad), "val"))
            truth.add((2 * i, 2 * i + 1))
        else:
            other = rng.choice([(rng.choice([t for t in things if t != thing]), color), (thing, rng.choice([c for c in colors if c != color]))])
            held.append((2 * i + 1, str(i), made(*other), "val"))
    df = spark.createDataFrame(held, "record_id long, image_id string, question string, split string")
    texts = spark.createDataFrame([(f"The {c} {t} stands there. The {c} {t} is seen.",) for c in colors for t in things], "text string")
    found = set(rows(cross_split.overlaps(df, texts=texts), "train_id", "eval_id"))
    assert len(found & truth) >= 0.98 * len(truth) and found <= truth


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=6), st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=6))
def test_indexed_prefixes_lose_no_pair(a, b):
    weights = cross_split.Weights(1000, {t: 3 ** (i + 1) for i, t in enumerate("abcdefg")})
    x, y = " ".join(a), " ".join(b)
    vy = dict(weights.vector(y))
    cosine = sum(w * vy.get(t, 0.0) for t, w in weights.vector(x))
    if cosine >= 0.8:
        shared = [t for t, _ in weights.vector(x) if t in vy]
        assert shared[0] in weights.indexed(x, 0.8) and shared[0] in weights.indexed(y, 0.8)


# --- 6


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=15), st.text("abc", max_size=5), st.integers(0, 2))
def test_tree_equals_brute_force(strings, query, most):
    found = sorted(spelling.BKTree(strings).within(query, most))
    assert found == sorted((spelling.damerau(query, s), s) for s in set(strings) if spelling.damerau(query, s) <= most)


@settings(max_examples=80, deadline=None)
@given(*[st.text("ab", max_size=5)] * 3)
def test_distance_is_a_metric(a, b, c):
    d = spelling.damerau
    assert d(a, b) == d(b, a) and (d(a, b) == 0) == (a == b) and d(a, c) <= d(a, b) + d(b, c)


VOCABULARY = [(1, "4", ["four"]), (2, "dark green", []), (3, "on the roof", None), (4, "taxi", ["cab"]), (5, "traffic light", ["stoplight"]), (6, "no", ["nope"]), (7, "child", []), (8, "van", [])]
TYPED = {" Taxis.": 4, "a cab": 4, "about 4": 1, "04": 1, "(4)": 1, "FOUR": 1, "4 of them": 1, "dark-green": 2, "drak green": 2, "ontheroof": 3, "on teh roof": 3, "maybe stopligth": 5, "answer: no": 6, "NaN": -1, "walrus": -1, "children": 7, "44": -1, "Is there a taxi?": -1, "-": -1, "van!": 8, "x" * 5000: -1}


@pytest.mark.parametrize("bound", [50_000, 5])
def test_typed_values_find_their_entries(spark, bound):
    reference = spark.createDataFrame(VOCABULARY, "answer_id long, answer string, aliases array<string>")
    held = [(i, v, {v: 0.5, "taxi": 0.1}) for i, v in enumerate(TYPED)] + [(99, None, None), (98, " ", {}), (97, "taxi", None), (0, " Taxis.", {" Taxis.": 0.5, "taxi": 0.1})]
    df = spark.createDataFrame([(*r, "clash") for r in held], "record_id long, hard string, dist map<string,double>, typed string")
    found = canonical_map.map_typed(df, "record_id", {"hard": F.array("hard"), "dist": F.map_keys("dist")}, reference, broadcast_max=bound)
    assert rows(found) == sorted(((i, f, v, a) for i, (v, a) in enumerate(TYPED.items()) for f in ("hard", "dist")), key=repr)


def test_a_sharded_list_gives_the_same_entries(spark):
    vocabulary = [(1, "tramway", ["taxi", "cab"]), (2, "taxi", None), (3, "kiosks", []), (4, "cab", None), (5, "bridge", None), (6, "fridge", None), (7, "zebra", ["kiosk"]), (8, "bridle", ["xridge"])]
    reference = spark.createDataFrame(vocabulary, "answer_id long, answer string, aliases array<string>")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["Taxi", "the cab", "bridg", "bridxe", "ridge", "Kiosks.", "kiosc", "taxxi", "none at all"])], "record_id long, hard string")
    whole, sharded = (rows(canonical_map.map_typed(df, "record_id", {"hard": F.array("hard")}, reference, broadcast_max=n)) for n in (100, 1))
    assert sharded == whole
    assert {r[2]: r[3] for r in whole}["Taxi"] == 2


# --- 7


def brute_share(text):
    words = repetition.Coded([text])
    held = re.findall(r"[^\W_]+", (text or "").lower())
    assert len(words.codes) == len(held)
    seen, marked = set(), set()
    for i in range(len(held) - 4):
        gram = tuple(held[i : i + 5])
        if gram in seen:
            marked |= set(range(i, i + 5))
        seen.add(gram)
    return len(marked) / len(held) if held else 0.0


def test_repeated_shares_equal_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", "...", "one two three four five", "路面有些湿，路面有些湿，路面有些湿，路面有些湿，路面有些湿，路面有些湿", "a b c d e f " * 20_000]
    texts += [" ".join(rng.choice("abcdefghij"[: rng.randint(2, 10)]) for _ in range(rng.randint(1, 80))) for _ in range(150)]
    texts += [rng.choice([". ", " - ", "\n"]).join([rng.choice([FIVE[0], FIVE[0].upper(), FIVE[1]]) for _ in range(rng.randint(1, 5))]) for _ in range(60)]
    df = spark.createDataFrame([(i, t, None, "clash") for i, t in enumerate(texts)], "record_id long, a string, b string, field string")
    found = {r["id"]: r for r in repetition.measures(df, "record_id", ["a", "b"]).where("field = 'a'").collect()}
    shares = {i: brute_share(t) for i, t in enumerate(texts)}
    assert all(abs(found[i]["repeated_share"] - s) < 1e-9 for i, s in shares.items())
    cases = {r["id"] for r in repetition.measures(df, "record_id", ["a", "b"], cases_only=True).collect()}
    assert cases == {i for i, s in shares.items() if s >= 0.3}
    assert found[0]["chars_per_token"] is None and found[4]["script"] == "han"
    bands = repetition.fitted_bands(df, "record_id", ["a", "b"])
    assert repetition.banded(repetition.measures(df.where("false"), "record_id", ["a"]), bands).count() == 0
    marked = {r["id"]: r["outside"] for r in repetition.banded(repetition.measures(df, "record_id", ["a"]), bands).collect()}
    assert len(marked) == len(texts) and marked[0] is None and marked[5]
    assert {i for i, r in found.items() if not r["within"]} & cases == set()


def test_bands_hold_the_central_share_of_all_texts(spark):
    """The unusual texts are the last ones that a sample by hash would take; repeated rows count once."""
    ids = [r["id"] for r in spark.range(4_400).orderBy(F.xxhash64("id", F.lit(7)), "id").collect()]
    usual = ["the red car waits at the light", "a small house by the river bank", "one two three four", "路面有些湿，树旁有人"]
    held = [(d, usual[k % 4] if k < 4_100 else "ᚠᚢᚦ ꙮꙮ ᛒᛖ" if k % 3 else "x " * (k % 50 + 2), None) for k, d in enumerate(ids)]
    df = spark.createDataFrame([*held, *held[:2_000]], "record_id long, a string, b string").repartition(3)
    measured = repetition.measures(df.distinct(), "record_id", ["a", "b"]).where("tokens > 1").withColumn("flat", F.expr("entropy / log2(tokens)"))
    expected = measured.groupBy("script").agg(F.percentile("chars_per_token", 0.01), F.percentile("chars_per_token", 0.99), F.percentile("byte_share", 0.99), F.percentile("flat", 0.01))
    assert rows(repetition.fitted_bands(df, "record_id", ["a", "b"])) == rows(expected)
    assert repetition.fitted_bands(df.where("false"), "record_id", ["a", "b"]).count() == 0


def test_percentiles_by_slices_are_exact(spark):
    rng = random.Random(6)
    values = [(g, rng.choice([0.0, rng.random(), rng.random() * 1e-5, rng.randint(0, 9) / 3]), rng.choice([None, rng.random() * 40])) for g in "aaaaaabbc" for _ in range(60)]
    df = spark.createDataFrame([*values, ("d", 0.25, None), ("e", 1.0, 2.0), ("e", 3.0, 2.0), (None, 0.5, 0.5)], "g string, x double, y double")
    wanted = {f"{c}{k}": (c, p) for c in "xy" for k, p in enumerate((0, 0.01, 0.37, 0.5, 0.99, 1))}
    expected = df.groupBy("g").agg(*(F.percentile(c, float(p)).alias(n) for n, (c, p) in wanted.items()))
    assert rows(repetition.percentiles(df, "g", wanted)) == rows(expected)


def test_the_band_of_the_defect_rejects_most_texts(spark):
    rng = random.Random(12)
    words = "house street water light paper window table garden school music number party money story month night letter river mother market office corner father family village doctor summer winter moment island bridge church kitchen station hotel color ground morning hospital road".split()
    df = spark.createDataFrame([(i, " ".join(rng.sample(words, 30)) if i % 10 else " ".join([*rng.sample(words, 8)] * 3)) for i in range(300)], "id long, t string")
    found = repetition.measures(df, "id", ["t"])
    assert found.where("within").count() < 0.2 * 300 and found.where("repeated_share >= 0.3 and not within").count() == 0 < found.where("repeated_share >= 0.3").count()


# --- 8


def right_words(item, words):
    """The right words of the best local alignment, by a plain table: +1 for a word (or one edit from it), -1 for a wrong, missing or added one."""

    def alike(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < 4 or abs(len(a) - len(b)) > 1:
            return False
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[k + 1 :] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k:] == b[k + 1 :] or (a[k + 1 : k + 2] == b[k : k + 1] and a[k : k + 1] == b[k + 1 : k + 2] and a[k + 2 :] == b[k + 2 :])

    same, most = {}, 0
    before = [(0, 0)] * (len(item) + 1)
    for w in words:
        row = [(0, 0)]
        for i, v in enumerate(item):
            if (w, v) not in same:
                same[w, v] = alike(w, v)
            hit = same[w, v]
            s, n = before[i]
            options = [(s + 1, n + 1) if hit else (s - 1, n), (before[i + 1][0] - 1, before[i + 1][1]), (row[i][0] - 1, row[i][1])]
            best = max(options)
            row.append(best if best[0] > 0 else (0, 0))
            most = max(most, row[-1][1])
        before = row
    return most


def test_leaks_equal_aligning_every_pair(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(x) for x in ("bdfgklmnprst", "aeiou", "bdfgklmnprst", "aeiou", "mnrst")) for _ in range(60)] + ["the", "and", "of"] * 5
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(40))) for i in range(12)] + [(90, None), (91, " "), (92, "two words"), (93, "oneword"), (3, "a second text of the third item held out")]
    documents, planted = [], set()

    def misspelled(w):
        k = rng.randrange(len(w))
        return w[:k] + rng.choice("xz") + w[k:] if len(w) > 3 else w

    for d in range(120):
        filler = [rng.choice(vocabulary) for _ in range(60)]
        i = rng.randrange(12)
        passage = items[i][1].split()
        n = rng.choice([0, 10, 24, 30, 40])
        start = rng.randint(0, 40 - n)
        piece = passage[start : start + n]
        if d % 3 == 0:  # a third of the words misspelled
            for k in rng.sample(range(n), n // 3):
                piece[k] = misspelled(piece[k])
        elif d % 3 == 1:
            piece = [w for w in piece if rng.random() > 0.06]
        else:  # an aside within the passage
            piece = piece[: n // 2] + (["that", "is", "so", "they", "say"] if n else []) + piece[n // 2 :]
        text = rng.choice([" ", "\n> ", " "]).join(filler[:30] + piece + filler[30:])
        documents.append((d, text.upper() if d % 5 == 0 else text.replace("w", "ｗ") if d % 7 == 0 else text))
        if n > 20:
            planted.add((d, i))
    documents += [(500, None), (501, ""), (502, "x two, words y"), (503, "words two " * 30_000), (0, documents[0][1]), (504, "just a oneword here"), (505, documents[2][1] * 3)]
    df = spark.createDataFrame([(*d, 1, "clash") for d in documents], "doc_id long, text string, item_id long, terms string")
    scores = lookalikes.fitted(df, "doc_id", "text")
    listed = spark.createDataFrame(items, "item_id long, text string")
    found = {tuple(r) for r in leakage.leaks(leakage.index(df, scores=scores), df, listed, scores).collect()}
    assert {(502, 92), (503, 92), (504, 93)} <= found and not {d for d, _ in found} & {500, 501}
    assert len(planted) > 50 and planted <= found
    consistent = lookalikes.Consistent(scores)
    for d, text in documents[::10]:
        held = leakage.words_of(text, consistent)
        for i, t in items[:12]:
            n = right_words(leakage.words_of(t, consistent), held)
            assert ((d, i) in found) == (n >= 20) or 17 <= n <= 20, (d, i, n)
    none = leakage.leaks(leakage.index(df.where("false"), scores=scores), df.where("false"), listed, scores)
    assert none.count() == 0
    assert leakage.leaks(leakage.index(df, scores=scores), df, listed.where("false"), scores).count() == 0


def test_leaks_are_read_with_the_letters_of_all_documents(spark):
    """The few documents that show a passage's words in plain letters are the last ones that a sample by hash would take."""
    item = "cope pace cocoa apex cape coax ecco poco"
    numbered = spark.range(4_300).withColumnRenamed("id", "doc_id")
    order = [r["doc_id"] for r in numbered.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").collect()]
    plain, disguised = set(order[-250:]), order[0]
    looks = {latin: other for other, latin in lookalikes.CYRILLIC.items()}
    texts = [(d, "a note: " + "".join(looks.get(c, c) for c in item)) if d == disguised else (d, item.replace("cope", "cope or") if d in plain else "12 34 路面") for d in order]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    scores = lookalikes.fitted(df, "doc_id", "text")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["doc_id"] for r in leakage.leaks(leakage.index(df, scores=scores), df, items, scores).collect()}
    assert found == plain | {disguised}


@settings(max_examples=80, deadline=None)
@given(st.integers(2, 120), st.data())
def test_looked_up_terms_are_hit_by_every_passage(n, data):
    """Whatever words of any long enough run are off, enough of the terms looked up stay whole."""
    chosen, hits = leakage.rarest(n, data.draw(st.lists(st.integers(0, 9), min_size=n - 1, max_size=n - 1)))
    run = max(2, leakage.needed(n))
    start = data.draw(st.integers(0, n - run))
    most = min(int(leakage.OFF * run), (run - 2) // 2) if n >= leakage.LEAST_WORDS else 0
    off = set(data.draw(st.lists(st.integers(start, start + run - 1), max_size=most, unique=True)))
    whole = [k for k in chosen if start <= k and k + 1 < start + run and not off & {k, k + 1}]
    assert len(whole) >= hits


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=5), st.text("abc", max_size=5))
def test_one_edit_equals_the_distance(a, b):
    assert spelling.one_edit(a, b) == (spelling.damerau(a, b) <= 1)


# --- 9


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), min_size=1, max_size=5), st.integers(1, 60))
def test_knapsack_equals_brute_force(counts, budget):
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * j for s in sums for j in range(k + 1)}
    chosen = mixture.knapsack(counts, budget)
    assert all(k <= counts[n] for n, k in chosen.items())
    assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= budget)


def test_budgets_of_long_documents_are_met():
    assert sum(n * k for n, k in mixture.fit({30000: 5, 25000: 4}, 100000).items()) == 100000
    assert sum(n * k for n, k in mixture.fit({21000: 3, 40000: 3}, 80000).items()) == 80000
    best = max(200_003 * i + 170_001 * j for i in range(41) for j in range(31) if 200_003 * i + 170_001 * j <= 3_000_000)
    assert sum(n * k for n, k in mixture.fit({200_003: 40, 170_001: 30}, 3_000_000).items()) == best
    held = {7: 1000, 100_000: 10**6, 99_999: 10**5, 13: 10**9}
    assert sum(n * k for n, k in mixture.fit(held, 10**10 + 12_345).items()) == 10**10 + 12_345


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 400), st.integers(1, 40), min_size=1, max_size=6), st.data())
def test_a_shortfall_is_less_than_the_shortest_document_left(counts, data):
    total = sum(n * k for n, k in counts.items())
    budget = data.draw(st.integers(1, total))
    chosen = mixture.fit(counts, budget, units=50, most=50)
    assert all(k <= counts[n] for n, k in chosen.items())
    short = budget - sum(n * k for n, k in chosen.items())
    left = [n for n, k in counts.items() if k > chosen.get(n, 0)]
    assert short >= 0 and (not left or short < min(left))
    exact = mixture.fit(counts, budget)
    sums = {0}
    for n, k in counts.items():
        sums = {s + n * j for s in sums for j in range(k + 1) if s + n * j <= budget} if len(sums) * k < 200_000 else sums
    if len(counts) < 3:
        assert sum(n * k for n, k in exact.items()) == max(sums)


def test_mixture_reaches_its_shares(spark):
    rng = random.Random(6)
    held = [(i, " ".join(rng.choice(["red", "bus", "corner"]) for _ in range(rng.randint(1, 30))), rng.choice("aaaaab")) for i in range(600)]
    held += [(700, None, "a"), (701, "  ", "b"), (702, "text", None), (703, "text", "other")]
    df = spark.createDataFrame([(*r, 1) for r in held], "doc_id long, text string, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("absent", 0.2, 4), (None, 0.1, 1), ("zero", 0.0, 1)], "source string, target_share double, max_repeats int")
    corpus_df, report = mixture.mixture(df, targets)
    got = {r["source"]: r for r in report.collect()}
    assert abs(got["a"]["used_share"] - 0.625) < 0.002 and abs(got["b"]["used_share"] - 0.375) < 0.002
    assert got["a"]["most_copies"] <= 1 and got["b"]["most_copies"] <= 3 and got["absent"]["used_tokens"] == 0
    assert all(got[s]["used_tokens"] <= got[s]["budget_tokens"] for s in "ab")
    assert rows(corpus_df) == rows(mixture.mixture(df.repartition(5), targets)[0])
    assert mixture.mixture(df.where("false"), targets)[0].count() == 0
    assert mixture.mixture(df, targets.where("false"))[0].count() == 0


# --- 10

LOOKS = {
    "q\u0323 x\u0304": (None, ["accent"]),
    "ไม่ รู้ हिन्दी بِسم": (None, []),
    "plain text": (None, []),
    "ｆｕｌｌ １２": ("full 12", ["form"]),
    "𝐛old ﬁsh": ("bold fish", ["form"]),
    "café": ("café", ["accent"]),
    "zero​width so­ft": ("zerowidth soft", ["invisible"]),
    "no break　wide": ("no break wide", ["space"]),
    "the rеd сar": ("the red car", ["lookalike"]),
    "Выезд m² “q” … 🚗 café 路，": (None, []),
    "👩‍🚗": (None, []),
    "": (None, []),
    None: (None, []),
}


def test_consistent_forms(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(LOOKS)], "doc_id long, text string, kinds string")
    scores = lookalikes.PairScores().fit(["the red car is a bold fish", "Выезд Внимание"])
    found = {r["id"]: r for r in lookalikes.consistent_texts(df, scores=scores).collect()}
    for i, (text, (expected, kinds)) in enumerate(LOOKS.items()):
        assert found[i]["text"] == (text if expected is None else expected) and sorted(found[i]["kinds"]) == kinds, text
    assert lookalikes.consistent_texts(df.where("false"), scores=scores).count() == 0


def test_pair_scores_are_those_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(lookalikes, "HELD_WORDS", 20, raising=False)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcorpeсорехαιé 路1.") for _ in range(rng.randint(0, 40))) for _ in range(4_500)] + [None, "", "路面 12", "cope " * 3_000]
    held = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, "the only text without an id")]
    df = spark.createDataFrame(held, "doc_id long, text string").repartition(5)
    whole = lookalikes.PairScores().fit([t for _, t in held if t])
    scores = lookalikes.fitted(df, "doc_id", "text")
    assert (scores.pairs, scores.firsts) == (whole.pairs, whole.firsts)
    consistent = lookalikes.Consistent(whole)
    found = {r["id"]: r["text"] for r in lookalikes.consistent_texts(df).collect()}
    assert all(found[i] == (None if t is None else consistent(t)[0]) for i, t in held)
    assert lookalikes.fitted(df.where("false"), "doc_id", "text").pairs == {}


@settings(max_examples=60, deadline=None)
@given(st.text())
def test_the_form_is_stable(text):
    consistent = lookalikes.Consistent(lookalikes.PairScores())
    once = consistent(text)[0]
    assert consistent(once)[0] == once


def test_nothing_else_imports_this_package():
    from pathlib import Path

    package = Path(queries.__file__).resolve().parent.parent
    users = [p for p in package.rglob("*.py") if "llm" not in p.relative_to(package).parts and "lumisift.llm" in p.read_text()]
    assert not users
