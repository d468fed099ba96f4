from datetime import datetime

from calltext.plans.features import syllable_lexicon
from calltext.plans.jobs import (
    once_per_batch, read_arriving, run_linguistic_features, run_syllables, stream_linguistic_features,
)
from calltext.schemas import CALLS, SPEAKER_DATA
from calltext.sources import keyed
from tests.conftest import rows

V1, V2 = datetime(2005, 1, 1), datetime(2006, 1, 1)


def _calls(spark, *keys):
    return spark.createDataFrame(
        [(f, v, v, None, None, kind, None, None, None) for f, v, kind in keys], CALLS)


def _spoken(spark, *passages):
    return spark.createDataFrame(
        [(f, v, "Ann", "Acme", "CEO", n, "pres", 1, text, "en") for f, v, n, text in passages],
        SPEAKER_DATA)


def test_linguistic_features_batch_by_batch(spark):
    lexicon = spark.createDataFrame([("negative", "loss")], "category string, word string")
    calls = _calls(spark, ("a", V1, 1), ("b", V1, 1), ("other", V1, 2))
    spoken = _spoken(spark, ("a", V1, 1, "loss of 7"), ("b", V1, 1, "loss loss"),
                     ("other", V1, 1, "loss"), ("a", V2, 1, "no loss"))

    def run(calls, limit=None):
        work = run_linguistic_features(calls, spoken, lexicon, "ling_job", limit, buckets=4)
        return rows(work, "file_name"), rows(
            spark.table("ling_job"), "file_name", "last_update", "negative", "num_count")

    a = [("a", V1, 1, 1), ("a", V2, 1, 0)]
    assert run(calls, 1) == ([("a",)], a)
    assert run(calls, 1) == ([("b",)], [*a, ("b", V1, 2, 0)])
    assert run(calls) == ([], [*a, ("b", V1, 2, 0)])
    # A new version of "b" is waiting; without passages of it the file's rows stay the same.
    more = calls.unionByName(_calls(spark, ("b", V2, 1)))
    assert run(more) == ([("b",)], [*a, ("b", V1, 2, 0)])


def test_syllables_start_from_the_question_table(spark):
    phones = spark.createDataFrame([("alpha", ["AE1", "F", "AH0"])],
                                   "word string, phones array<string>")
    lexicon = syllable_lexicon(phones)
    calls = _calls(spark, ("a", V1, 1), ("b", V1, 1), ("dupe", V1, 1))
    spoken = _spoken(spark, ("a", V1, 1, "Alpha."), ("b", V1, 1, "Alpha alpha."),
                     ("dupe", V1, 1, "alpha"))
    keys = "file_name string, last_update timestamp"
    first = spark.createDataFrame([("b", V1), ("b", V1)], keys)
    dupes = spark.createDataFrame([("dupe", V1)], keys)

    def run():
        run_syllables(calls, dupes, first, spoken, lexicon, "syll_job", buckets=4)
        return rows(spark.table("syll_job"), "file_name", "syllable_data.num_syllables")

    assert run() == [("b", 4)]
    assert run() == [("a", 2), ("b", 4)]
    assert run() == [("a", 2), ("b", 4)]


def test_empty_calls_do_not_hold_up_a_limited_run(spark):
    lexicon = spark.createDataFrame([("negative", "loss")], "category string, word string")
    calls = _calls(spark, ("a", V1, 1), ("b", V1, 1), ("c", V1, 1), ("d", V1, 1))
    spoken = _spoken(spark, ("c", V1, 1, "loss"), ("d", V1, 1, "gain"))
    took = [rows(run_linguistic_features(calls, spoken, lexicon, "empty_job", 2, buckets=4), "file_name")
            for _ in range(3)]
    assert took == [[("a",), ("b",)], [("c",), ("d",)], []]
    assert rows(spark.table("empty_job"), "file_name", "negative") == [("c", 1), ("d", 0)]


def test_stream_makes_the_table_of_the_batch_job(spark, tmp_path):
    lexicon = spark.createDataFrame([("negative", "loss")], "category string, word string")
    spoken = _spoken(spark, ("a", V1, 1, "loss of 7"), ("a", V1, 2, "gain"), ("b", V1, 1, "loss loss"),
                     ("c", V1, 1, "none"), ("other", V1, 1, "loss"), ("c", V2, 1, "no loss 3"))
    keyed.create_keyed_table(spoken, "stream_passages", "file_name", buckets=8)
    arriving, kept = str(tmp_path / "calls"), str(tmp_path / "kept")
    batches = [_calls(spark, ("a", V1, 1), ("b", V1, 1)), _calls(spark, ("c", V1, 1), ("other", V1, 2)),
               _calls(spark, ("a", V1, 1), ("c", V2, 1))]
    for number, part in enumerate(batches):
        part.coalesce(1).write.mode("append").parquet(arriving)
        if number != 1:  # the first, then two at once
            calls = read_arriving(spark, arriving, CALLS, files=1)
            stream_linguistic_features(calls, "stream_passages", lexicon, "ling_stream", kept,
                                       buckets=4).awaitTermination()
    whole = batches[0].unionByName(batches[1]).unionByName(batches[2])
    run_linguistic_features(whole, spoken, lexicon, "ling_batch", buckets=4)
    shown = ("file_name", "last_update", "speaker_number", "negative", "num_count")
    wanted = rows(spark.table("ling_batch"), *shown)
    assert rows(spark.table("ling_stream"), *shown) == wanted and len(wanted) == 5
    assert rows(spark.table("ling_stream_batches")) == [("calls", 0), ("calls", 1), ("calls", 2)]


def test_a_repeated_batch_is_left_alone(spark):
    seen = []
    each = once_per_batch(lambda batch: seen.append(batch.count()), "repeat_job", "s")
    for number in (0, 0, 1, 0):
        each(spark.range(number + 1), number)
    once_per_batch(lambda batch: seen.append(-1), "repeat_job", "other")(spark.range(1), 0)
    assert seen == [1, 2, -1]

    def fails(batch):
        raise RuntimeError("stop")

    for _ in range(2):
        try:
            once_per_batch(fails, "repeat_job", "s")(spark.range(1), 5)
        except RuntimeError:
            seen.append("again")
    assert seen[-2:] == ["again", "again"]


def test_an_older_table_gives_its_keys_to_the_record_once(spark):
    lexicon = spark.createDataFrame([("negative", "loss")], "category string, word string")
    calls = _calls(spark, ("a", V1, 1), ("b", V1, 1))
    spoken = _spoken(spark, ("a", V1, 1, "loss"), ("b", V1, 1, "loss"))
    run_linguistic_features(calls.filter("file_name = 'a'"), spoken, lexicon, "old_job", buckets=4)
    spark.sql("DROP TABLE old_job_done")
    assert rows(run_linguistic_features(calls, spoken, lexicon, "old_job"), "file_name") == [("b",)]
    assert rows(spark.table("old_job_done"), "file_name") == [("a",), ("b",)]


def test_stream_makes_its_lexicon_once(spark, tmp_path, monkeypatch):
    from calltext.plans import features

    made, trie = [], features.token_trie
    monkeypatch.setattr(features, "token_trie", lambda *a: made.append(1) or trie(*a))
    lexicon = spark.createDataFrame([("negative", "loss")], "category string, word string")
    spoken = _spoken(spark, ("a", V1, 1, "loss"), ("b", V1, 1, "loss loss"))
    arriving = str(tmp_path / "calls")
    for name in ("a", "b"):
        _calls(spark, (name, V1, 1)).coalesce(1).write.mode("append").parquet(arriving)
    stream_linguistic_features(
        read_arriving(spark, arriving, CALLS, files=1), spoken, lexicon, "once_stream",
        str(tmp_path / "kept"), buckets=4).awaitTermination()
    assert rows(spark.table("once_stream"), "file_name", "negative") == [("a", 1), ("b", 2)]
    assert len(made) == 1
