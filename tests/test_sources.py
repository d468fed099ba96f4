from datetime import datetime

import pyarrow as pa
import pytest
from pyarrow import feather
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from calltext import schemas
from calltext.operators.staging import broadcast_if_small, shared_folder, stage
from calltext.plans.features import lexicon_table
from calltext.sources import keyed, readers, writers
from tests.conftest import rows


def test_word_lists_with_both_header_rules(spark, tmp_path):
    (tmp_path / "pos.csv").write_text("Able,2009\nGain,2010\n")
    (tmp_path / "neg.csv").write_text("Loss\nBad\n")
    paths = {"positive": str(tmp_path / "pos.csv"), "negative": str(tmp_path / "neg.csv")}
    assert rows(readers.read_lexicon(spark, paths)) == [
        ("negative", "bad"), ("negative", "loss"), ("positive", "able"), ("positive", "gain")]
    with_header = readers.read_lexicon(spark, paths, header=True, lower=False)
    assert rows(with_header) == [("negative", "Bad"), ("positive", "Gain")]
    assert rows(lexicon_table(with_header)) == [("negative", ["Bad"]), ("positive", ["Gain"])]
    known = with_header.filter("category = 'negative'").withColumn("url", F.lit("here"))
    assert rows(lexicon_table(known)) == [("negative", ["Bad"], "here")]


def test_mac_roman_csv(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_bytes("id,name\n1,Nestlé\n".encode("mac_roman"))
    assert rows(readers.read_mac_roman_csv(spark, str(path), "id int, name string")) == [
        (1, "Nestlé")]


def test_sheet_with_schema(spark, tmp_path):
    path = tmp_path / "checks.csv"
    path.write_text("event_co_name,permno,comnams,valid\nAcme,1,ACME,FALSE\nBoo,,BOO,TRUE\n")
    assert rows(readers.read_sheet(spark, str(path), schemas.NAME_CHECKS)) == [
        ("Acme", 1, "ACME", False), ("Boo", None, "BOO", True)]


def test_arrow_sample(spark, tmp_path):
    path = str(tmp_path / "sample.feather")
    feather.write_feather(pa.table({"file_name": ["a", "b"], "n": [1, 2]}), path)
    sample = readers.read_arrow_sample(spark, path)
    assert rows(sample) == [("a", 1), ("b", 2)]
    writers.write_arrow_sample(sample, path, "a")
    assert rows(readers.read_arrow_sample(spark, path)) == [("a", 1)]


def test_tables(spark, tmp_path):
    assert writers.create_if_absent(spark, "feature_rows", schemas.LINGUISTIC_FEATURES)
    assert not writers.create_if_absent(spark, "feature_rows", schemas.LINGUISTIC_FEATURES)
    assert spark.table("feature_rows").schema == schemas.LINGUISTIC_FEATURES
    df = spark.createDataFrame([(1, "it's")], "k int, v string")
    writers.overwrite_table(df, "plain_rows", "CREATED USING it's test")
    comment = spark.sql("DESCRIBE TABLE EXTENDED plain_rows").filter("col_name = 'Comment'").first()
    assert comment["data_type"] == "CREATED USING it's test"
    writers.append_table(df.withColumn("k", F.lit(2)), "plain_rows")
    # The new content may come from the old.
    writers.overwrite_table(readers.read_table(spark, "plain_rows").filter("k = 2"), "plain_rows")
    assert rows(spark.table("plain_rows")) == [(2, "it's")]
    writers.publish_view(spark.table("plain_rows"), "plain_view")
    assert spark.table("plain_view").count() == 1
    writers.write_csv(df, str(tmp_path / "out"))
    assert rows(readers.read_sheet(spark, str(tmp_path / "out"), "k int, v string")) == [(1, "it's")]


def test_a_failing_write_leaves_the_old_table(spark):
    df = spark.createDataFrame([(1, "old")], "k int, v string")
    writers.overwrite_table(df, "kept_rows")
    bad = df.withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        writers.overwrite_table(bad, "kept_rows")
    assert rows(spark.table("kept_rows")) == [(1, "old")]
    writers.overwrite_table(df.withColumn("v", F.lit("new")), "kept_rows")
    assert rows(spark.table("kept_rows")) == [(1, "new")]


def test_stage_writes_to_the_named_folder(spark):
    df = stage(spark.range(5).withColumn("t", F.lit(datetime(2005, 1, 1))))
    assert df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_a_cluster_must_name_its_folder():
    from types import SimpleNamespace

    def session(master, folder):
        known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "w"}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda name, *default: known[name]),
                               sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("yarn", "hdfs://f")) == shared_folder(session("local[2]", "hdfs://f")) == "hdfs://f"
    assert shared_folder(session("local[2]", None)) == "w/_staging"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", None))


@pytest.mark.parametrize("limit, expected", [(10_000, True), (10, False)])
def test_broadcast_only_within_the_limit(spark, limit, expected):
    df = broadcast_if_small(spark.range(50).select(F.col("id").cast("string").alias("word")), limit)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert ("broadcast" in plan) == expected and df.count() == 50


# -- publishing --------------------------------------------------------------------------------------

class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", range(1, 6))
@pytest.mark.parametrize("before", ["nothing", "plain", "published"])
def test_publishing_stopped_at_each_step(spark, monkeypatch, step, before):
    """Every statement that changes the catalog is a step; the run stops before one of them."""
    table = f"stopped_{before}_{step}"
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    if before == "plain":
        old.write.saveAsTable(table)
    elif before == "published":
        writers.overwrite_table(old, table)
    count = [0]
    run, save = type(spark).sql, DataFrameWriter.saveAsTable

    def counted(inner):
        def call(self, *args, **kwargs):
            if inner is save or not args[0].startswith(("SHOW", "DESCRIBE")):
                count[0] += 1
                if count[0] == step:
                    raise Stopped
            return inner(self, *args, **kwargs)
        return call

    monkeypatch.setattr(type(spark), "sql", counted(run))
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", counted(save))
    # The new content has another schema.
    new = spark.createDataFrame([(1, "new", 2)], "k int, v string, more int")
    stopped = False
    try:
        writers.overwrite_table(new, table)
    except Stopped:
        stopped = True
    monkeypatch.undo()
    if before == "nothing" and stopped and not writers.versions(spark, table):
        assert not spark.catalog.tableExists(table)
    else:
        wanted = [("old",), ("new",)] if stopped else [("new",)]
        assert rows(readers.read_table(spark, table), "v")[0] in wanted
    writers.overwrite_table(new, table)
    assert rows(readers.read_table(spark, table)) == [(1, "new", 2)]
    assert len(writers.versions(spark, table)) == 1


def test_versions_stay_for_readers_that_began_before(spark):
    writers.overwrite_table(spark.range(3), "long_read")
    reading = spark.table("long_read")
    writers.overwrite_table(spark.range(5), "long_read", keep=1)
    assert reading.count() == 3 and spark.table("long_read").count() == 5
    writers.overwrite_table(spark.range(7), "long_read", keep=1)
    assert len(writers.versions(spark, "long_read")) == 2
    writers.comment_table(spark, "long_read", "it's a \\ test")
    comment = spark.sql("DESCRIBE TABLE EXTENDED long_read").filter("col_name = 'Comment'").first()
    assert comment["data_type"] == "it's a \\ test"


# -- keyed tables ------------------------------------------------------------------------------------

def _files(spark, table):
    version = writers.properties(spark, table)[writers.VERSION]
    return set(spark.table(version).inputFiles())


def _numbered(spark, low, high, v):
    return spark.range(low, high).select(
        F.concat(F.lit("f"), "id").alias("file_name"), F.lit(v).alias("v"))


def test_replacing_keys_touches_no_file(spark):
    keyed.create_keyed_table(_numbered(spark, 0, 40, 1), "keyed_rows", "file_name", buckets=8)
    before = _files(spark, "keyed_rows")
    new = spark.createDataFrame([("f1", 2), ("f1", 3), ("new", 4), (None, 5)], "file_name string, v int")
    processed = spark.createDataFrame([("f1",), ("f2",), ("new",), (None,), ("none",)], "file_name string")
    for turn in range(3):  # repeating it changes nothing
        keyed.replace_keys(new, processed, "keyed_rows")
        got = rows(spark.table("keyed_rows"), "file_name", "v")
        assert len(got) == 42 and {("f1", 2), ("f1", 3), ("new", 4), (None, 5)} <= set(got)
        assert not any(f in ("f2", "none") for f, _ in got) and ("f1", 1) not in got
        assert before < _files(spark, "keyed_rows")
    # Worked on again without rows: gone.
    keyed.replace_keys(new.filter("v = 2"), processed.filter("file_name = 'f1' OR file_name IS NULL"), "keyed_rows")
    got = rows(spark.table("keyed_rows"), "file_name", "v")
    assert ("f1", 2) in got and ("f1", 3) not in got and (None, 5) not in got and ("new", 4) in got


def test_compacting_keeps_the_rows_and_few_files(spark):
    keyed.create_keyed_table(_numbered(spark, 0, 40, 1), "compact_rows", "file_name", buckets=4)
    for turn in range(3):
        part = _numbered(spark, 10 * turn, 10 * turn + 12, turn + 2)
        keyed.replace_keys(part, part, "compact_rows")
    shown, many = rows(spark.table("compact_rows"), "file_name", "v"), len(_files(spark, "compact_rows"))
    reading = spark.table("compact_rows")
    keyed.compact(spark, "compact_rows", keep=1)
    assert rows(spark.table("compact_rows"), "file_name", "v") == shown == rows(reading, "file_name", "v")
    assert len(_files(spark, "compact_rows")) <= 4 < many
    part = _numbered(spark, 0, 1, 99)
    keyed.replace_keys(part, part, "compact_rows")
    assert ("f0", 99) in rows(spark.table("compact_rows"), "file_name", "v")


def test_what_a_failed_run_left_is_overruled(spark):
    keyed.create_keyed_table(_numbered(spark, 0, 4, 1), "failed_rows", "file_name", buckets=2)
    part = _numbered(spark, 0, 2, 2)
    keyed.replace_keys(part, part, "failed_rows")
    # As if some files of another change had been written before the run ended.
    version = writers.properties(spark, "failed_rows")[writers.VERSION]
    half = spark.table(version).filter("key_sequence = 1 AND file_name = 'f0' AND NOT key_mark").withColumns(
        {"key_sequence": F.lit(2).cast("long"), "v": F.lit(-1)})
    half.write.mode("append").partitionBy("key_bucket").saveAsTable(version)
    again = _numbered(spark, 0, 2, 3)
    keyed.replace_keys(again, again, "failed_rows")
    assert rows(spark.table("failed_rows"), "file_name", "v") == [("f0", 3), ("f1", 3), ("f2", 1), ("f3", 1)]


def test_keyed_tables_refuse_what_does_not_fit(spark):
    df = _numbered(spark, 0, 20, 1)
    keyed.create_keyed_table(df, "fixed_rows", "file_name", buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        keyed.replace_keys(df, df, "fixed_rows", buckets=3)
    with pytest.raises(ValueError, match="not processed"):
        keyed.replace_keys(df, df.limit(1), "fixed_rows")
    assert spark.table("fixed_rows").count() == 20
    df.write.saveAsTable("unkeyed_rows")
    with pytest.raises(ValueError, match="no keyed table"):
        keyed.replace_keys(df, df, "unkeyed_rows")
    empty = spark.createDataFrame([], df.schema)
    assert keyed.create_keyed_if_absent(spark, "empty_rows", df.schema, "file_name", 4)
    assert not keyed.create_keyed_if_absent(spark, "empty_rows", df.schema, "file_name", 4)
    keyed.replace_keys(empty, empty, "empty_rows")
    assert spark.table("empty_rows").count() == 0


def test_a_batch_lists_only_its_partitions(spark):
    keyed.create_keyed_table(_numbered(spark, 0, 400, 1), "pruned_rows", "file_name", buckets=64)
    keys = spark.createDataFrame([("f7",), ("f8",), ("f8",), ("absent",)], "file_name string")
    batch = keyed.rows_of_keys(spark, "pruned_rows", keys)
    assert rows(batch) == [("f7", 1), ("f8", 1)]
    numbers = {r[0] for r in keyed.with_bucket(keys, "file_name", 64).select("key_bucket").collect()}
    listed = {int(f.split("key_bucket=")[1].split("/")[0]) for f in batch.inputFiles()}
    assert listed <= numbers and 2 <= len(listed) <= 3
    # The scan of the marks is pruned as well.
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(key_bucket") + plan.count("PartitionFilters: [key_bucket") \
        + plan.count("PartitionFilters: [(key_bucket") >= 2, plan
