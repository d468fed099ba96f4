"""Sinks: overwrite, append, publish, export. Tables with replaceable keys are in ``keyed``."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# A published name is a view of one version; this property of the view says which.
VERSION = "calltext.version"


def create_if_absent(spark: SparkSession, table: str, schema: StructType, *partition: str) -> bool:
    """Create an empty table with the declared schema; tells whether it did."""
    if spark.catalog.tableExists(table):
        return False
    writer = spark.createDataFrame([], schema).write.format("parquet")
    (writer.partitionBy(*partition) if partition else writer).saveAsTable(table)
    return True


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What is noted on a table or view."""
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def versions(spark: SparkSession, table: str) -> list[str]:
    """Complete versions of a published name, oldest first. A version gets into the catalog when all
    of it is written, so one whose write failed is not among them."""
    *database, name = table.split(".")
    found = spark.catalog.listTables(*(database or [None]), pattern=f"{name}__v*")
    numbers = sorted(t.name for t in found if re.fullmatch(rf"{re.escape(name.lower())}__v\d{{9}}", t.name))
    return [".".join([*database, n]) for n in numbers]


def next_version(spark: SparkSession, table: str) -> str:
    """A name for a version after all others."""
    known = versions(spark, table)
    number = int(known[-1][-9:]) + 1 if known else 1
    return f"{table}__v{number:09d}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def point_to(spark: SparkSession, table: str, version: str, select: str | None = None,
             notes: Mapping[str, str] | None = None, comment: str | None = None) -> None:
    """Let ``table`` show ``version`` from now on: one statement, one change of the catalog, so a
    reader finds the version before or this one. ``select`` is how it shows it (default: as it is)."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        # A plain table of this name becomes the version before. ``recover`` finds it in between.
        spark.sql(f"ALTER TABLE {table} RENAME TO {next_version(spark, table)}")
    noted = ", ".join(f"'{k}' = {_quoted(v)}" for k, v in {**(notes or {}), VERSION: version}.items())
    said = f"COMMENT {_quoted(comment)} " if comment is not None else ""
    spark.sql(f"CREATE OR REPLACE VIEW {table} {said}TBLPROPERTIES ({noted}) AS "
              f"{select or f'SELECT * FROM {version}'}")


def recover(spark: SparkSession, table: str) -> None:
    """Show the last complete version where a run ended before the name was there at all."""
    if not spark.catalog.tableExists(table):
        known = versions(spark, table)
        if known:
            point_to(spark, table, known[-1])


def drop_old_versions(spark: SparkSession, table: str, keep: int = 0) -> None:
    """Remove versions older than the one that is shown, but for the last ``keep`` of them, and newer
    ones that were never shown. Not while readers of those may be at work."""
    shown = properties(spark, table)[VERSION]
    known = versions(spark, table)
    older = [v for v in known if v < shown]
    for version in [*older[:len(older) - keep], *(v for v in known if v > shown)]:
        spark.sql(f"DROP TABLE {version}")


def overwrite_table(df: DataFrame, table: str, comment: str | None = None, keep: int = 0) -> None:
    """Replace the content of a name; the new content may be computed from the old.

    The new version is written beside the old one and shown when it is complete. A run that ends at
    any step leaves the old or the new content to be read. ``keep`` more versions stay for readers
    that began before.
    """
    spark = df.sparkSession
    version = next_version(spark, table)
    df.write.format("parquet").saveAsTable(version)
    point_to(spark, table, version, comment=comment)
    drop_old_versions(spark, table, keep)


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    """Note how a table was made."""
    if spark.catalog.getTable(table).tableType == "VIEW":
        spark.sql(f"ALTER VIEW {table} SET TBLPROPERTIES ('comment' = {_quoted(comment)})")
    else:
        spark.sql(f"COMMENT ON TABLE {table} IS :comment", args={"comment": comment})


def append_table(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table, or to the version that a published name shows."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "VIEW":
        table = properties(spark, table)[VERSION]
    df.write.mode("append").format("parquet").saveAsTable(table)


def publish_view(df: DataFrame, name: str) -> None:
    """A second name for a result within the session."""
    df.createOrReplaceTempView(name)


def write_csv(df: DataFrame, path: str) -> None:
    """Export rows for review, with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_arrow_sample(df: DataFrame, path: str, file_name: str) -> None:
    """Keep the passages of one call, which the driver can hold, as one Arrow (Feather) file."""
    from pyarrow import feather

    feather.write_feather(df.filter(F.col("file_name") == file_name).toArrow(), path)
