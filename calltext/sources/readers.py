"""Sources: tables, review sheets exported as CSV, word lists and Arrow samples."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calltext.sources.writers import recover


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or a published name."""
    recover(spark, name)
    return spark.read.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table. Give ``partitionColumn``, bounds and ``numPartitions`` for a parallel read."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_sheet(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A review sheet exported as CSV with a header."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_mac_roman_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """A CSV with a header in the old Mac encoding; needs ``spark.sql.legacy.javaCharsets``."""
    reader = spark.read.option("header", True).option("encoding", "x-MacRoman")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_lexicon(
    spark: SparkSession, paths: Mapping[str, str], header: bool = False, lower: bool = True
) -> DataFrame:
    """``category, word`` from one CSV per category, first column.

    The feature job keeps the first line and lower-cases; the word-list table takes the first line
    as a header and keeps case (``header=True, lower=False``).
    """
    def words(category: str, path: str) -> DataFrame:
        # Without a schema the columns are counted from the first line, as the lists differ.
        rows = spark.read.option("header", header).csv(path)
        word = F.col(f"`{rows.columns[0]}`").cast("string")
        return rows.select(F.lit(category).alias("category"),
                           (F.lower(word) if lower else word).alias("word"))

    return reduce(DataFrame.unionByName, [words(c, p) for c, p in paths.items()])


def read_arrow_sample(spark: SparkSession, path: str) -> DataFrame:
    """A sample kept as one Arrow (Feather) file. Samples are small; data tables are parquet."""
    from pyarrow import feather

    return spark.createDataFrame(feather.read_table(path))
