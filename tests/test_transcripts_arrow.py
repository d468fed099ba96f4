from datetime import datetime

import pyarrow as pa
import pytest
from pyarrow import feather
from pyspark.sql import functions as F

from calltext.schemas import SPEAKER_DATA
from calltext.sources import arrow_files
from calltext.sources.transcripts import accepted, parse_transcripts, read_transcripts, rejected, to_transcripts
from tests.conftest import rows

V1 = datetime(2005, 1, 1, 10, 30)

DOCUMENT = """<?xml version="1.0"?>
<transcript file_name="F1" last_update="2005-01-01T10:30:00.000000">
  <section number="1" context="pres">
    <passage speaker_number="1" speaker_name="Ann Lee" role="CEO">We grew &amp; grew.</passage>
    <passage speaker_number="2" speaker_name="José"/>
  </section>
  <section number="1" context="qa"><passage speaker_number="1" language="en">a
 b</passage></section>
</transcript>"""


def _documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "xml string")


def test_nested_elements(spark):
    got = accepted(parse_transcripts(_documents(spark, DOCUMENT))).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("F1", V1, "Ann Lee", None, "CEO", 1, "pres", 1, "We grew & grew.", None),
        ("F1", V1, "José", None, None, 2, "pres", 1, "", None),
        ("F1", V1, None, None, None, 1, "qa", 1, "a\n b", "en")], key=str)
    assert accepted(parse_transcripts(_documents(spark, DOCUMENT))).columns == SPEAKER_DATA.names


def test_malformed_documents_are_kept_aside(spark):
    bad = ["", "no xml", "<transcript file_name='x'><section>", "<transcript/>",
           DOCUMENT.replace('speaker_number="2"', 'speaker_number="two"')]
    parsed = parse_transcripts(_documents(spark, *bad, DOCUMENT, None, "<transcript file_name='e'/>"))
    assert sorted(r[0] for r in rejected(parsed).collect()) == sorted(bad)
    assert accepted(parsed).count() == 3
    assert parsed.filter("rejected IS NOT NULL AND (file_name IS NOT NULL OR speaker_text IS NOT NULL)").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(DOCUMENT)
    (tmp_path / "b.xml").write_text(DOCUMENT.replace("F1", "F2"))
    (tmp_path / "c.xml").write_text("cut off <transcript")
    parsed = read_transcripts(spark, str(tmp_path))
    assert rows(accepted(parsed).groupBy("file_name").count()) == [("F1", 3), ("F2", 3)]
    assert rejected(parsed).count() == 1


def test_round_trip(spark):
    said = [("a", V1, "Ann \"A\" O'Lee", "A & B <co>", "CEO", 1, "pres", 1, " two  blanks\n<b>&amp;</b> ", "en"),
            ("a", V1, None, None, None, 2, "qa", 2, "x", None), ("b", V1, "é", "", "", 1, "pres", 1, "y", "fr")]
    df = spark.createDataFrame(said, SPEAKER_DATA)
    back = accepted(parse_transcripts(to_transcripts(df)))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


# -- Arrow files -------------------------------------------------------------------------------------

def test_several_files_are_read_by_tasks(spark, tmp_path):
    arrow_files.register(spark)
    path = str(tmp_path / "arrow")
    df = spark.range(1000).select("id", F.concat(F.lit("é"), "id").alias("t"),
                                  F.when(F.col("id") % 3 == 0, F.lit(1.5)).alias("d"))
    df.repartition(5).write.format("arrow_files").mode("append").save(path)
    back = spark.read.format("arrow_files").load(path)
    assert back.dtypes == df.dtypes and back.rdd.getNumPartitions() == 5
    assert rows(back) == rows(df)
    df.limit(10).coalesce(1).write.format("arrow_files").mode("overwrite").save(path)
    assert spark.read.format("arrow_files").load(path).count() == 10
    assert back.select("t").schema.names == ["t"]


def test_files_of_other_writers(spark, tmp_path):
    arrow_files.register(spark)
    for k in range(3):
        feather.write_feather(pa.table({"file_name": [f"f{k}"], "n": [k]}), tmp_path / f"{k}.feather",
                              compression="zstd")
    (tmp_path / "_ignored.feather").write_text("x")
    assert rows(spark.read.format("arrow_files").load(str(tmp_path))) == [("f0", 0), ("f1", 1), ("f2", 2)]
    assert rows(spark.read.format("arrow_files").schema("n long").load(str(tmp_path / "1.feather"))) == [(1,)]


def test_a_failed_write_leaves_the_files_that_were_there(spark, tmp_path):
    arrow_files.register(spark)
    path = str(tmp_path / "kept")
    spark.range(5).coalesce(1).write.format("arrow_files").mode("append").save(path)
    bad = spark.range(20).select(F.when(F.col("id") == 19, F.raise_error(F.lit("stop")).cast("long"))
                                 .otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        bad.repartition(3).write.format("arrow_files").mode("overwrite").save(path)
    assert spark.read.format("arrow_files").load(path).filter("id < 5").count() >= 5
