"""Tables whose rows are replaced by key: append, merge on read, compact.

A change never touches a file that is there. It appends the new rows of the keys worked on and one
row for each of these keys that says they were, all with a sequence number of their own. The table's
name is a view that shows, of each key, the rows of its last number. Whatever a run that failed has
left is overruled by the run that repeats it. Compacting writes the rows shown as a new version and
lets the name show that, in one step.

Rows lie in partitions by a hash of their key. Reads of given keys list only the partitions of those.
One writer at a time; readers need no lock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calltext.operators.staging import stage
from calltext.sources.writers import (
    VERSION, drop_old_versions, next_version, point_to, properties,
)

BUCKET = "key_bucket"
BUCKETS = "calltext.buckets"
KEY = "calltext.key"
SEQUENCE = "key_sequence"
# True in the row that says that a key was worked on; its other columns are NULL.
MARK = "key_mark"


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with the partition column of a keyed table."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _shown(version: str, key: str, columns: list[str]) -> str:
    """The rows of each key's last sequence number. Only keys that were changed since the table was
    compacted are in the inner table, so it is small and the rows themselves need not be shuffled."""
    names = ", ".join(f"r.`{c}`" for c in [*columns, BUCKET])
    return f"""SELECT {names} FROM {version} AS r LEFT ANTI JOIN (
        SELECT `{key}` AS changed, {BUCKET} AS place, max({SEQUENCE}) AS last FROM {version}
        GROUP BY `{key}`, {BUCKET} HAVING bool_or({MARK})
    ) AS c ON r.{BUCKET} = c.place AND r.`{key}` <=> c.changed AND (r.{SEQUENCE} < c.last OR r.{MARK})"""


def _write(df: DataFrame, version: str, key: str, mode: str) -> None:
    """Few files: those of a bucket come together, sorted by key for the statistics of their pages."""
    placed = df.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, key)
    placed.write.mode(mode).format("parquet").partitionBy(BUCKET).saveAsTable(version)


def _publish(rows: DataFrame, table: str, key: str, buckets: int, columns: list[str]) -> None:
    spark = rows.sparkSession
    version = next_version(spark, table)
    fresh = with_bucket(rows.select(*columns), key, buckets).withColumns({
        SEQUENCE: F.lit(0).cast("long"), MARK: F.lit(False)})
    _write(fresh, version, key, "error")
    point_to(spark, table, version, _shown(version, key, columns), {BUCKETS: str(buckets), KEY: key})


def create_keyed_table(rows: DataFrame, table: str, key: str, buckets: int = 256) -> None:
    """A keyed table with these rows. The number of buckets stays a property of the table."""
    _publish(rows, table, key, buckets, rows.columns)
    drop_old_versions(rows.sparkSession, table)


def create_keyed_if_absent(
    spark: SparkSession, table: str, schema: StructType, key: str, buckets: int
) -> bool:
    """An empty keyed table, if there is none; tells whether it made one."""
    if spark.catalog.tableExists(table):
        return False
    create_keyed_table(spark.createDataFrame([], schema), table, key, buckets)
    return True


def _noted(spark: SparkSession, table: str, key: str | None = None, buckets: int | None = None
           ) -> tuple[str, str, int]:
    """Version, key and number of buckets of a keyed table; other ones would scatter its keys."""
    known = properties(spark, table)
    if BUCKETS not in known:
        raise ValueError(f"{table} is no keyed table: it has no property {BUCKETS}")
    if key is not None and key != known[KEY]:
        raise ValueError(f"{table} has the key {known[KEY]}, not {key}")
    if buckets is not None and buckets != int(known[BUCKETS]):
        raise ValueError(f"{table} has {known[BUCKETS]} buckets, not {buckets}")
    return known[VERSION], known[KEY], int(known[BUCKETS])


def replace_keys(new: DataFrame, processed: DataFrame, table: str, buckets: int | None = None) -> None:
    """From now on the rows of the ``processed`` keys are those in ``new``. A key of ``new`` that was
    not processed raises an error before anything is written."""
    spark = new.sparkSession
    version, key, count = _noted(spark, table, buckets=buckets)
    columns = [c for c in spark.read.table(table).columns if c != BUCKET]
    keys, rows = stage(processed.select(key).distinct()), stage(new.select(*columns))
    strange = rows.select(key).alias("n").join(
        keys.alias("k"), F.expr(f"n.`{key}` <=> k.`{key}`"), "left_anti").first()
    if strange is not None:
        raise ValueError(f"rows of a key that was not processed: {strange[0]}")
    last = spark.read.table(version).agg(F.coalesce(F.max(SEQUENCE), F.lit(0))).first()[0]
    both = rows.withColumn(MARK, F.lit(False)).unionByName(
        keys.withColumn(MARK, F.lit(True)), allowMissingColumns=True)
    change = with_bucket(both, key, count).withColumn(SEQUENCE, F.lit(last + 1).cast("long"))
    _write(change.select(*spark.read.table(version).columns), version, key, "append")


def compact(spark: SparkSession, table: str, keep: int = 0) -> None:
    """Write what the table shows as a version of its own, a few files to a bucket. Readers of the
    version before may go on if ``keep`` is 1 or more."""
    _, key, buckets = _noted(spark, table)
    shown = spark.read.table(table)
    _publish(shown.drop(BUCKET), table, key, buckets, [c for c in shown.columns if c != BUCKET])
    drop_old_versions(spark, table, keep)


def rows_of_keys(spark: SparkSession, table: str, keys: DataFrame) -> DataFrame:
    """The rows of some keys, out of the partitions of these keys only. What comes to the driver are
    numbers of buckets."""
    _, key, buckets = _noted(spark, table)
    wanted = with_bucket(keys.select(key).distinct(), key, buckets)
    numbers = sorted(r[0] for r in wanted.select(BUCKET).distinct().collect())
    inside = spark.read.table(table).filter(F.col(BUCKET).isin(numbers))
    return inside.join(wanted, [key, BUCKET], "left_semi").drop(BUCKET)
