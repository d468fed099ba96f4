import math
import random
import re

from calltext.functions.passages import sentences
from calltext.plans.sentences import SURE, abbreviations, split_sentences, stop_counts
from tests.conftest import rows

TEXT = ("Dr. Lee met Mr. Stone at 5. They spoke of e.g. the plan. Dr. Lee left. The plan was good. "
        "Mr. Stone stayed! He had a plan. It was late. ")


def _texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "k int, speaker_text string")


def test_counts(spark):
    got = rows(stop_counts(_texts(spark, "Dr. Lee, dr Lee. e.g. A.", None, "")))
    assert got == [("a", 1, 0), ("dr", 1, 1), ("e.g", 1, 0), ("lee", 1, 1)]


def _plain(texts, least=0.3):
    counts = {}
    for text in texts:
        for found in re.findall(r"[^\W\d_](?:(?:[^\W\d_]|\.)*[^\W\d_])?\.?", text):
            word = found.removesuffix(".").lower()
            counts.setdefault(word, [0, 0])[not found.endswith(".")] += 1
    stops, rest = (sum(c[i] for c in counts.values()) for i in (0, 1))
    p, out = stops / (stops + rest), {}
    for word, (a, b) in counts.items():
        null, other = (a * math.log(q) + b * math.log(1 - q) for q in (p, SURE))
        n = len(word.replace(".", ""))
        score = 2 * (other - null) * math.exp(-n) * (word.count(".") + 1) * n ** -b
        if a and score >= least:
            out[word] = (a, b, round(score, 6))
    return out


def test_scores_beside_the_formula(spark):
    rng = random.Random(2)
    words = ["co", "inc.", "e.g.", "dr.", "plan", "the", "loss.", "b", "u.s.", "firm"]
    texts = [TEXT * 3] + [" ".join(rng.choice(words) for _ in range(200)) for _ in range(5)]
    got = {r.word: (r.n_with, r.n_without, round(r.score, 6))
           for r in abbreviations(_texts(spark, *texts)).collect()}
    assert got == _plain(texts) and {"dr", "e.g", "u.s"} <= set(got)


def test_no_stops_no_abbreviations(spark):
    assert abbreviations(_texts(spark, "no stops here", None)).collect() == []
    assert abbreviations(_texts(spark, None)).collect() == []
    # Every word stopped.
    assert abbreviations(_texts(spark, "a. b. c.")).count() >= 0


def test_sentences_go_on_after_abbreviations(spark):
    known = spark.createDataFrame([("dr",), ("e.g",), ("dr",)], "word string")
    df = _texts(spark, "Dr. Lee  met.  E.g. this? Yes", "Ask the Dr. ", "", None, "end Dr.")
    assert rows(split_sentences(df, known, ["k"])) == [
        (0, 0, "Dr. Lee  met."), (0, 1, "E.g. this?"), (0, 2, "Yes"), (1, 0, "Ask the Dr."),
        (4, 0, "end Dr.")]


def test_without_abbreviations_as_the_plain_rule(spark):
    rng = random.Random(7)
    df = _texts(spark, *("".join(rng.choice("ab.!? \n") for _ in range(40)) for _ in range(60)))
    none = spark.createDataFrame([], "word string")
    got = {}
    for k, pos, sentence in rows(split_sentences(df, none, ["k"])):
        got.setdefault(k, {})[pos] = sentence
    plain = {r[0]: r[1] for r in df.select("k", sentences("speaker_text")).collect()}
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {
        k: v for k, v in plain.items() if v}
