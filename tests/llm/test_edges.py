"""What every operator does with nulls, empty texts, repeats, clashing columns and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from calltext.llm import (
    classifier, decontamination, lines, mixing, privacy, quality, sharding, simhash, substrings, urls,
)

TEXT = " ".join(f"word{i}" for i in range(80))
ROWS = [
    (1, TEXT, "en", "a"), (1, TEXT, "en", "a"), (2, TEXT, "en", None), (3, None, None, "b"),
    (4, "", "de", "b"), (5, " \n\t ", None, None), (None, "null id " + TEXT, "en", "a"),
    (None, None, None, None), (6, "one", "fr", "c"), (7, "x" * 300_000 + " y", "en", "c"),
    (8, "ä ö ü 😀 " * 40 + "\nline\nline", "de", "c"), (9, TEXT + " more", "en", "b"),
]
CLASHES = ("size", "shard", "key", "hash", "rank", "kept", "words", "position", "spans", "doc", "sum",
           "target", "component", "first", "id", "print", "item_id", "score", "verdict", "_key", "_hash")


@pytest.fixture
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture
def bench(spark):
    return spark.createDataFrame(
        [(1, " ".join(TEXT.split()[5:25])), (2, None), (3, ""), (None, "two words")],
        "item_id long, text string")


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (8, 0), (9, 1), (None, 1), (3, None)],
                                 "doc_id long, quality int")


def operators(docs, bench, labels):
    return {
        "lines": lambda: lines.without_repeated_chunks(docs),
        "substrings": lambda: substrings.without_repeats(docs),
        "mixing": lambda: mixing.curriculum(docs),
        "simhash": lambda: simhash.near_components(docs),
        "wide": lambda: simhash.near_components(docs, shingle=5, numbers=16, radius=160, wide=0.151),
        "privacy": lambda: privacy.sensitive_spans(docs),
        "quality": lambda: quality.judged(docs),
        "classifier": lambda: classifier.scored(docs, labels),
        "sharding": lambda: sharding.shard_by_bytes(docs),
    }


NAMES = list(operators(None, None, None))


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_document(docs, bench, labels, name):
    found = operators(docs, bench, labels)[name]().collect()
    assert len(found) == len(ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(docs, bench, labels, name):
    none = docs.limit(0)
    assert operators(none, bench, labels)[name]().collect() == []


def test_no_labels(docs, labels):
    found = classifier.scored(docs, labels.limit(0)).collect()
    assert len(found) == len(ROWS) and all(r["kept"] and r["score"] == 1.0 for r in found)


def test_decontamination(docs, bench):
    found = decontamination.contaminated(docs, bench).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "1", "2", "9", "None"]
    assert decontamination.contaminated(docs.limit(0), bench).collect() == []
    assert decontamination.contaminated(docs, bench.limit(0)).collect() == []
    left = decontamination.clean_rows(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6, 7, 8]


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "", ""), (3, "no scheme", "<p>x</p>"), (None, "http://", None),
         (4, "HTTP://A.ORG?x", "a"), (4, "HTTP://A.ORG?x", "a"), (5, "https://ü.com/" + "a" * 2000, "")],
        "page_id long, url string, html string").withColumns({c: F.lit("x") for c in CLASHES})
    found = urls.judged(pages).collect()
    assert len(found) == 7 and {r["verdict"] for r in found} <= {"allow", "block"}
    assert {(r["host"], r["path"]) for r in found if r["page_id"] in (1, 2, 3)} == {("", "")}
    assert urls.judged(pages.limit(0)).collect() == []


@pytest.mark.parametrize("number", range(4))
def test_stages_keep_the_columns(spark, docs, tmp_path, bench, number):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = corpus_pipeline.STAGES[number][1]
    found = stage(spark, docs, str(tmp_path))
    assert found.columns == docs.columns
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    if number == 0:
        assert sorted(str(r["doc_id"]) for r in found.collect()) == ["1", "1", "2", "9", "None"]
    if number == 1:
        # Empty texts are one component; its least id is 3.
        ids = [r["doc_id"] for r in found.select("doc_id").collect()]
        assert ids.count(1) == 1 and 2 not in ids and 3 in ids and 4 not in ids and 5 not in ids
    if number == 3:
        assert found.count() > 0


def test_sharding_as_a_stage(spark, docs, tmp_path):
    stage = corpus_pipeline.STAGES[4][1]
    found = stage(spark, docs, str(tmp_path)).collect()
    assert len(found) == len(ROWS) and {r["shard"] for r in found} <= set(range(8))
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_texts_without_words(docs):
    found = {r["doc_id"]: r for r in simhash.near_components(docs).collect()}
    assert found[4]["print"] == "0" * 16 and found[4]["first"] == 3 and found[5]["first"] == 3
    got = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    assert (got[3]["n_words"], got[3]["kept"]) == (0, "") and got[2]["n_removed"] == 80
    assert got[9]["n_removed"] == 80 and got[1]["n_removed"] == 0 and got[None]["n_removed"] in (0, 80)


def test_a_source_without_words(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, "x y z " * 10, "b"), (4, "u v", "c")],
                               "doc_id long, text string, source string")
    got = {r["_key"]: (r["target"], r["passes"]) for r in mixing.curriculum(df).collect()}
    assert got[1] == (0.0, 0) and got[2] == (0.0, 0)
    assert got[4][0] == 6.0 and got[4][1] == 3 and round(got[3][0]) == 26 and got[3][1] == 1
    empty = spark.createDataFrame([(1, "", "a")], "doc_id long, text string, source string")
    assert [r["passes"] for r in mixing.curriculum(empty).collect()] == [0]
