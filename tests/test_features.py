from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calltext.functions import passages as p
from calltext.plans import features
from calltext.plans.competition import competition_table
from calltext.plans.qa import qa_pairs, qa_passages
from calltext.schemas import SPEAKER_DATA, TONE_CATEGORIES
from tests.conftest import rows


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "k int, speaker_text string")


def one(spark, column, text):
    return texts(spark, text).select(column).first()[0]


def lexicon(spark, *pairs):
    return spark.createDataFrame(list(pairs), "category string, word string")


def test_tone_is_case_sensitive_and_whole_word(spark):
    lex = lexicon(spark, ("negative", "loss"), ("uncertainty", "may"), ("modal_weak", "may"))
    df = texts(spark, "Loss loss losses", "may, may!", "", None, "nothing")
    got = rows(features.tone_counts(df, lex), "k", "negative", "uncertainty", "modal_weak",
               "positive")
    assert got == [(0, 1, 0, 0, 0), (1, 0, 2, 2, 0), (2, 0, 0, 0, 0),
                   (3, None, None, None, None), (4, 0, 0, 0, 0)]


def test_tone_of_identical_rows(spark):
    df = spark.createDataFrame([(1, "a loss"), (1, "a loss"), (1, "loss loss")],
                               "k int, speaker_text string")
    got = rows(features.tone_counts(df, lexicon(spark, ("negative", "loss"))), "k", "negative")
    assert got == [(1, 1), (1, 1), (1, 2)]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="abcé_ .,-1", max_size=30), min_size=20, max_size=40))
def test_token_join_equals_the_pattern(spark, values):
    words = ["a", "ab", "abc", "é", "a1", "b_c"]
    lex = lexicon(spark, *[("positive", w) for w in words])
    df = texts(spark, *values)
    joined = rows(features.tone_counts(df, lex), "k", "positive")
    matched = rows(df.select("k", p.tone_pattern_count("speaker_text", words)))
    assert joined == matched


def test_large_lexicon_is_joined_without_broadcast(spark, monkeypatch):
    from calltext.operators import staging

    monkeypatch.setattr(
        features, "broadcast_if_small", lambda df: staging.broadcast_if_small(df, limit=0))
    df = texts(spark, *["the loss " * 50] * 40, "gain")
    lex = lexicon(spark, ("negative", "loss"), ("positive", "gain"))
    got = rows(features.tone_counts(df, lex), "k", "negative", "positive")
    assert got == sorted([(i, 50, 0) for i in range(40)] + [(40, 0, 1)], key=str)


def test_texts_are_split_once_and_not_shuffled(spark):
    df = texts(spark, "a loss").select("k", "speaker_text")
    plan = features.tone_counts(
        df, lexicon(spark, ("negative", "loss")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "BroadcastHashJoin" in plan
    exchange = next(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "speaker_text" not in exchange


@pytest.mark.parametrize("text, expected", [
    ("May 5, 2010 and 1,234 and 12345", 1),
    ("2010.5 is a year, 1,234 is not", 1),
    ("Mar. 5 and Sept. 5", 1),
    ("no number", 0),
    ("3 or 4.5 or 6", 3),
    ("Jun 5 with a hard blank", 0),
    ("", 0),
    (None, None),
])
def test_number_count(spark, text, expected):
    got = one(spark, p.number_count("speaker_text"), text)
    assert got == expected


@pytest.mark.parametrize("text, expected", [
    ("We will grow. It was expected to fall, we may stop.", 0.5),
    ("A planet. A mayor.", 1.0),  # stems match as beginnings of words
    ("Goodwill. WILL it?", 0.5),
    ("We had been expected to grow.", None),
    ("", None),
])
def test_forward_looking_share(spark, text, expected):
    got = one(spark, p.forward_looking_share("speaker_text"), text)
    if text.startswith("We had been"):
        expected = 0.0
    assert got == expected


def test_sentences(spark):
    assert one(spark, p.sentences("speaker_text"), "One. Two!\nThree? Four") == [
        "One.", "Two!", "Three?", "Four"]
    assert one(spark, p.sentences("speaker_text"), "") == []
    text = "Thank you, Mr. Lee. Ask Dr. No."
    assert len(one(spark, p.sentences("speaker_text"), text)) == 4
    assert one(spark, p.sentences("speaker_text", ["Mr", "Dr"]), text) == [
        "Thank you, Mr. Lee.", "Ask Dr. No."]


def test_words(spark):
    text = "We don't see Acme's 1,234.5 forward-looking (U.S.) 'plans'. -- Naïve!"
    assert one(spark, p.words("speaker_text"), text) == [
        "We", "do", "n't", "see", "Acme", "1,234.5", "forward-looking", "U.S", "plans", "Naïve"]


def test_competition(spark):
    df = texts(
        spark, "many firms face less direct competition", "less direct competition", "no rivals",
        "We have few or no competitors. Competing is hard", "Competes")
    got = rows(p.competition_mentions(df), "k", "preceding_words", "competition_word", "exclude",
               "exclude_matches")
    assert got == [
        (0, "face less direct ", "competition", True, [" less "]),
        (1, "less direct ", "competition", False, None),
        (3, "few or no ", "competitors", False, None),
        (4, "", "Competes", False, None)]


def test_competition_flag_belongs_to_the_key(spark):
    keys = "file_name string, section int, speaker_text string"
    df = spark.createDataFrame([
        ("a", 1, "with not much competition"), ("a", 1, "open competition"),
        ("b", None, "with not much competition"), ("c", 1, "open competition")], keys)
    got = rows(competition_table(df, ["file_name", "section"]), "file_name", "preceding_words",
               "exclude")
    assert got == [("a", "open ", True), ("a", "with not much ", True),
                   ("b", "with not much ", False), ("c", "open ", False)]


def pronunciations(spark):
    return spark.createDataFrame([
        ("alpha", ["AE1", "L", "F", "AH0"]), ("beta", ["B", "EY1", "T", "AH0"]),
        ("every", ["EH1", "V", "ER0", "IY0"]), ("every", ["EH1", "V", "R", "IY0"]),
        ("edu", ["IY1", "D", "IY1", "UW1"]), ("hm", ["HH", "M"])],
        "word string, phones array<string>")


def test_syllable_lexicon_takes_the_larger(spark):
    got = dict(rows(features.syllable_lexicon(pronunciations(spark))))
    assert got == {"alpha": 2, "beta": 2, "every": 3, "edu": 3, "hm": 0}


def test_syllable_features(spark):
    lex = features.syllable_lexicon(pronunciations(spark))
    df = texts(spark, "Alpha beta. Every unknownword!", "", "Unknown", None)
    got = {r.k: r.syllable_data for r in features.syllable_features(df, lex).collect()}
    assert got[0].asDict() == {
        "sent_count": 2, "word_count": 4, "word_7_count": 1, "num_syllables": 7,
        "syllable_counts": {2: 2, 3: 1}}
    assert got[1].asDict() == {
        "sent_count": 0, "word_count": 0, "word_7_count": 0, "num_syllables": 0,
        "syllable_counts": {}}
    assert got[2].num_syllables == 0 and got[2].word_count == 1
    assert got[3] is None
    text = features.syllable_json(features.syllable_features(df.limit(1), lex)).first()
    assert text.syllable_data.endswith('"syllable_counts":{"2":2,"3":1}}')


def test_syllables_of_identical_rows(spark):
    lex = features.syllable_lexicon(pronunciations(spark))
    df = spark.createDataFrame([(1, "alpha every")] * 2, "k int, speaker_text string")
    got = [r.syllable_data.num_syllables for r in features.syllable_features(df, lex).collect()]
    assert got == [5, 5]
    assert rows(features.long_words(df, lex)) == [(1, ["every"]), (1, ["every"])]


def test_long_words_in_order(spark):
    lex = features.syllable_lexicon(pronunciations(spark))
    df = texts(spark, "Every edu alpha every unknown", "none", None)
    assert rows(features.long_words(df, lex)) == [(0, ["every", "every"]), (1, []), (2, None)]


def test_update_features(spark):
    def passage(f, n, text):
        return (f, datetime(2005, 1, 1), "Ann", "Acme", "CEO", n, "pres", 1, text, "en")

    spoken = spark.createDataFrame(
        [passage("a", 1, "a loss of 5"), passage("a", 2, "gain"), passage("b", 1, "loss")],
        SPEAKER_DATA)
    lex = lexicon(spark, ("negative", "loss"), ("positive", "gain"))
    previous = features.passage_features(
        spoken.filter("file_name = 'b'").select(*[
            c for c in features.LINGUISTIC_FEATURES.names
            if c not in (*TONE_CATEGORIES, "num_count")], "speaker_text"),
        lex).withColumn("negative", F.lit(7))
    work = spark.createDataFrame([("a", datetime(2005, 1, 1))],
                                 "file_name string, last_update timestamp")
    updated = features.update_features(spoken, work, lex, previous)
    assert rows(updated, "file_name", "speaker_number", "positive", "negative", "num_count") == [
        ("a", 1, 0, 1, 1), ("a", 2, 1, 0, 0), ("b", 1, 0, 7, 0)]
    assert updated.columns == features.LINGUISTIC_FEATURES.names


def test_qa_blocks_do_not_change_the_numbers(spark):
    roles = ["Operator", "CEO", "Analyst", "Analyst", "CEO", "CFO", "Analyst", "CEO", None,
             "Analyst", "Analyst", "Analyst", "CEO"]
    df = spark.createDataFrame(
        [(f, 1, i * 3, r) for f in ("a", "b") for i, r in enumerate(roles)],
        "file_name string, last_update int, speaker_number int, role string")
    whole = rows(qa_passages(df))
    for length in (1, 2, 4, 7):
        assert rows(qa_passages(df, block_length=length)) == whole
    assert rows(qa_pairs(df.filter("file_name = 'a'")), "qa_id", "n_questions", "question_from",
                "question_to", "n_answers", "answer_from", "answer_to") == [
        (1, 2, 6, 9, 2, 12, 15), (2, 1, 18, 18, 2, 21, 24), (3, 3, 27, 33, 1, 36, 36)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_null_text_gives_null(spark, ansi):
    from calltext.functions import passages
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.sql("SELECT CAST(NULL AS STRING) AS t")
        measures = [passages.number_count("t"), passages.forward_looking_share("t"),
                    *features.word_stats("t")]
        assert list(df.select(*measures).first()) == [None] * 5
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_entries_of_several_tokens(spark):
    lexicon = spark.createDataFrame(
        [("positive", "well-known"), ("negative", "can't"), ("negative", "known")],
        "category string, word string")
    texts = spark.createDataFrame(
        [(1, "A well-known firm can't, it can't."), (2, "well known"), (3, None)], "k int, t string")
    got = features.tone_counts(texts, lexicon, "t")
    assert rows(got, "k", "positive", "negative") == [(1, 1, 3), (2, 0, 1), (3, None, None)]
    odd = spark.createDataFrame([("positive", "-x")], "category string, word string")
    with pytest.raises(Exception, match="not a whole word"):
        features.tone_counts(texts, odd, "t").collect()


def test_long_words_of_many_copies(spark):
    lexicon = spark.createDataFrame([("banana", 3)], "word string, n_syllables int")
    texts = spark.range(50).select(F.lit(1).alias("k"), F.lit("Banana a banana").alias("t"))
    got = features.long_words(texts, lexicon, "t")
    assert rows(got) == [(1, ["banana", "banana"])] * 50


def test_no_registered_text_query_shuffles_its_texts(spark):
    from checks.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    for name in ("number_count", "sentence_split", "word_stats", "forward_looking_share",
                 "comp_intensity", "tone_counts", "syllable_features", "long_words"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" not in plan
        for line in plan.splitlines():
            if "Exchange" in line and "Broadcast" not in line and "BroadcastExchange" not in line:
                assert "text#" not in line
        if name in ("number_count", "sentence_split", "word_stats", "forward_looking_share"):
            assert "Exchange" not in plan


def _no_broadcast(monkeypatch):
    from calltext.operators import staging

    monkeypatch.setattr(
        features, "broadcast_if_small", lambda df: staging.broadcast_if_small(df, limit=0))


def _shuffled(monkeypatch, build):
    """Plans of what ``build`` stages, and its rows."""
    plans, stage = [], features.stage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df)

    monkeypatch.setattr(features, "stage", seen, raising=False)
    got = rows(build())
    return [plan for plan in plans if "Join" in plan], got


@pytest.mark.parametrize("query", [0, 1, 2], ids=["tone", "syllables", "long words"])
def test_runs_of_tokens_travel_beside_a_large_lexicon(spark, monkeypatch, query):
    spoken = spark.createDataFrame(
        [(1, "a loss, a Loss loss"), (1, "a loss, a Loss loss"), (2, None), (2, ""), (3, "gain")],
        "k int, t string")
    lex = lexicon(spark, ("negative", "loss"), ("positive", "gain"), ("uncertainty", "loss"))
    syllables = spark.createDataFrame([("loss", 1), ("gain", 3), ("a", 1)], "word string, n_syllables int")
    build = [
        lambda: features.tone_counts(spoken, lex, "t"),
        lambda: features.syllable_json(features.syllable_features(spoken, syllables, "t")),
        lambda: features.long_words(spoken, syllables, "t")][query]
    expected = rows(build())
    _no_broadcast(monkeypatch)
    plans, got = _shuffled(monkeypatch, build)
    assert got == expected
    # The join's inputs are dealt as runs, before they are taken apart, and not once more.
    assert len(plans) == 1 and "BroadcastHashJoin" not in plans[0]
    dealt = [line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line]
    assert not any("word#" in line for line in dealt)
    assert sum("REPARTITION_BY_NUM" in line for line in dealt) == 2


@pytest.mark.parametrize("limit", [1, 40, 10**9])
def test_parts_of_a_lexicon_give_the_same(spark, monkeypatch, limit):
    _no_broadcast(monkeypatch)
    monkeypatch.setattr(features, "BROADCAST_BYTES", limit, raising=False)
    lex = lexicon(spark, *[("positive", f"w{i}") for i in range(0, 40, 2)], ("negative", "w2-w3 w4"),
                  ("negative", "w2-w3"), ("litigious", "\U0001d4b3x"), ("positive", ""))
    spoken = texts(spark, " ".join(f"w{i % 45}" for i in range(200)), "w2-w3 w4, w2 w3", "\U0001d4b3x \ue000w2",
                   None)
    got = rows(features.tone_counts(spoken, lex), "k", "positive", "negative", "litigious")
    assert got == [(0, 90, 0, 0), (1, 3, 2, 0), (2, 1, 0, 1), (3, None, None, None)]


def test_large_lexicon_keeps_passages_with_null_columns_apart(spark, monkeypatch):
    _no_broadcast(monkeypatch)
    spoken = spark.createDataFrame(
        [("a", None, "loss"), (None, "a", "loss"), (None, "a", "loss"), (None, None, "gain loss loss")],
        "x string, y string, t string")
    got = rows(features.tone_counts(spoken, lexicon(spark, ("negative", "loss")), "t"), "x", "y", "negative")
    assert got == [(None, None, 2), (None, "a", 1), (None, "a", 1), ("a", None, 1)]
