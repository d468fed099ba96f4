"""Calls as XML documents, one to a call.

The elements are a layout of our own: ``transcript`` with the attributes ``file_name`` and
``last_update`` holds ``section`` elements with ``number`` and ``context``; these hold ``passage``
elements with ``speaker_number``, ``speaker_name``, ``employer``, ``role`` and ``language``, and the
text within. A missing attribute is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType, TimestampType

from calltext.schemas import SPEAKER_DATA

ROOT = "transcript"
REJECTED = "rejected"

PASSAGE = (
    StructType().add("_speaker_number", IntegerType()).add("_speaker_name", StringType())
    .add("_employer", StringType()).add("_role", StringType()).add("_language", StringType())
    .add("_VALUE", StringType()))
SECTION = (
    StructType().add("_number", IntegerType()).add("_context", StringType())
    .add("passage", ArrayType(PASSAGE)))
TRANSCRIPT = (
    StructType().add("_file_name", StringType()).add("_last_update", TimestampType())
    .add("section", ArrayType(SECTION)))
# White space belongs to the text, and numbers are written as they are.
TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
OPTIONS = {"rowTag": ROOT, "ignoreSurroundingSpaces": "false", "timestampFormat": TIME}


def parse_transcripts(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """The passages of XML documents with the columns of ``speaker_data``, and ``rejected``.

    A document that is no such XML gives one row, which holds it in ``rejected`` and NULL elsewhere;
    in the rows of the others ``rejected`` is NULL. So does one without the name of its call. A call
    without passages and a NULL document give no rows. Each document is parsed once, where it is read.
    """
    schema = StructType([*TRANSCRIPT.fields]).add("_bad", StringType())
    parsed = documents.filter(F.col(xml).isNotNull()).select(
        F.col(xml).alias("__xml"),
        F.from_xml(xml, schema, {**OPTIONS, "mode": "PERMISSIVE",
                                 "columnNameOfCorruptRecord": "_bad"}).alias("call"))
    bad = F.col("call").isNull() | F.col("call._bad").isNotNull() | F.col("call._file_name").isNull()
    none = F.lit(None).cast(ArrayType(SECTION))
    sections = parsed.select(
        F.when(bad, F.col("__xml")).alias(REJECTED), F.col("call._file_name").alias("file_name"),
        F.col("call._last_update").alias("last_update"),
        F.explode_outer(F.when(bad, none).otherwise(F.col("call.section"))).alias("s"))
    passages = sections.select(
        REJECTED, "file_name", "last_update", F.col("s._number").alias("section"),
        F.col("s._context").alias("context"), F.explode_outer("s.passage").alias("p"))
    good = F.col(REJECTED).isNull()
    found = {name: F.when(good, F.col(name)) for name in ("file_name", "last_update", "section", "context")}
    found |= {name: F.col(f"p._{name}") for name in (
        "speaker_number", "speaker_name", "employer", "role", "language")}
    # An element without text has no value; a passage is never NULL.
    found["speaker_text"] = F.when(F.col("p").isNotNull(), F.coalesce("p._VALUE", F.lit("")))
    return passages.filter(~good | F.col("p").isNotNull()).select(
        *(found[name].alias(name) for name in SPEAKER_DATA.names), REJECTED)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """The passages of a folder of XML files, one call to a file; see ``parse_transcripts``."""
    return parse_transcripts(spark.read.text(path, wholetext=True), "value")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECTED).isNotNull()).select(REJECTED)


def to_transcripts(speaker_data: DataFrame) -> DataFrame:
    """``file_name, last_update, xml``: each call of ``speaker_data`` as one document, in the order of
    section, context and speaker number. A call is held by one task, as is its document."""
    passage = F.struct(
        *(F.col(name).alias(f"_{name}") for name in (
            "speaker_number", "speaker_name", "employer", "role", "language")),
        F.col("speaker_text").alias("_VALUE"))
    sections = speaker_data.groupBy("file_name", "last_update", "section", "context").agg(
        F.array_sort(F.collect_list(passage)).alias("passage"))
    calls = sections.groupBy("file_name", "last_update").agg(F.array_sort(F.collect_list(F.struct(
        F.col("section").alias("_number"), F.col("context").alias("_context"), "passage"))).alias("section"))
    # Spark writes a time in an attribute as a number, so it is given as a text.
    time = F.date_format("last_update", TIME).alias("_last_update")
    document = F.struct(F.col("file_name").alias("_file_name"), time, "section")
    return calls.select("file_name", "last_update", F.to_xml(document, OPTIONS).alias("xml"))
