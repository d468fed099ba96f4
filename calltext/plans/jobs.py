"""The two feature jobs: find unprocessed calls, compute their passages, replace their rows.

Each keeps the keys it has worked on in a table of its own, ``<table>_done``: a call without passages
leaves no row in the feature table, and would otherwise be taken again by every run. Passages given as
the name of a keyed table are read out of the partitions of the batch's files only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructType

from calltext.operators.incremental import of_todo_files, todo
from calltext.operators.staging import stage
from calltext.plans.features import passage_features, syllable_features, tone_levels
from calltext.schemas import LINGUISTIC_FEATURES, SYLLABLE_DATA, TONE_CATEGORIES
from calltext.sources.keyed import create_keyed_if_absent, replace_keys, rows_of_keys
from calltext.sources.writers import append_table, create_if_absent

BUCKETS = 1024
EARNINGS_CALL = 1


KEYS = ["file_name", "last_update"]


def _passages(speaker_data: DataFrame | str, work: DataFrame) -> DataFrame:
    """Passages of the files of a batch."""
    if isinstance(speaker_data, str):
        return rows_of_keys(work.sparkSession, speaker_data, work)
    return of_todo_files(speaker_data, work)


def _run(
    wanted: DataFrame, table: str, schema: StructType, features, excluded: list[DataFrame],
    first_keys: DataFrame, limit: int | None, buckets: int | None,
) -> DataFrame:
    spark = wanted.sparkSession
    first = create_keyed_if_absent(spark, table, schema, "file_name", buckets or BUCKETS)
    record = f"{table}_done"
    if create_if_absent(spark, record, wanted.select(*KEYS).schema) and not first:
        # A table older than its record: its keys are read once, and are in the record from then on.
        append_table(spark.read.table(table).select(*KEYS).distinct(), record)
    work = stage(
        todo(first_keys, None, limit=limit) if first
        else todo(wanted, spark.read.table(record), *excluded, limit=limit))
    replace_keys(features(work), work, table, buckets)
    append_table(work, record)
    return work


def run_linguistic_features(
    calls: DataFrame, speaker_data: DataFrame | str, lexicon: DataFrame, table: str,
    limit: int | None = None, buckets: int | None = None,
) -> DataFrame:
    """Bring ``table`` up to date with the earnings calls, at most ``limit`` of them; returns the
    keys worked on. Works by file, so every version of a file is computed. ``buckets`` is for the
    first run; later runs read the number from the table."""
    carry = [c for c in LINGUISTIC_FEATURES.names if c not in (*TONE_CATEGORIES, "num_count")]
    wanted = calls.filter(F.col("event_type") == EARNINGS_CALL)

    def features(work: DataFrame) -> DataFrame:
        waiting = _passages(speaker_data, work)
        return passage_features(waiting.select(*carry, "speaker_text"), lexicon)

    return _run(wanted, table, LINGUISTIC_FEATURES, features, [], wanted, limit, buckets)


def run_syllables(
    calls: DataFrame, dupes: DataFrame, first_keys: DataFrame, speaker_data: DataFrame | str,
    lexicon: DataFrame, table: str, limit: int | None = None, buckets: int | None = None,
) -> DataFrame:
    """The same for syllable records, leaving out the duplicate transcripts. The first run takes
    its calls from ``first_keys`` (the question-and-answer table) instead."""
    carry = [c for c in SYLLABLE_DATA.names if c != "syllable_data"]
    wanted = calls.filter(F.col("event_type") == EARNINGS_CALL)

    def features(work: DataFrame) -> DataFrame:
        waiting = _passages(speaker_data, work)
        return syllable_features(waiting.select(*carry, "speaker_text"), lexicon)

    return _run(wanted, table, SYLLABLE_DATA, features, [dupes], first_keys, limit, buckets)


# -- the same as a stream ----------------------------------------------------------------------------

BATCHES = StructType().add("stream", StringType()).add("batch", LongType())


def once_per_batch(
    work: Callable[[DataFrame], object], table: str, stream: str
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that does ``work`` and notes the batch in ``<table>_batches``.
    A batch that comes again, as after a failure before its offsets were kept, is left alone."""
    record = f"{table}_batches"

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        create_if_absent(spark, record, BATCHES)
        mine = (F.col("stream") == stream) & (F.col("batch") == number)
        if not spark.read.table(record).filter(mine).limit(1).count():
            work(batch)
            append_table(spark.createDataFrame([(stream, number)], BATCHES), record)

    return each


def read_arriving(spark: SparkSession, folder: str, schema: StructType, files: int | None = None
                  ) -> DataFrame:
    """A stream of the parquet files that arrive in a folder, ``files`` of them to a batch."""
    reader = spark.readStream.schema(schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(folder)


def stream_linguistic_features(
    calls: DataFrame, speaker_data: DataFrame | str, lexicon: DataFrame, table: str, checkpoint: str,
    stream: str = "calls", buckets: int | None = None,
) -> StreamingQuery:
    """Work through the calls of a stream that have arrived by now, then stop; the next start goes on
    from there. ``checkpoint`` is a folder that all executors see. The table is the one that
    ``run_linguistic_features`` makes of the same calls: the files of a batch are computed whole,
    and one that an earlier batch worked on is not taken again."""
    levels = tone_levels(lexicon)

    def work(batch: DataFrame) -> None:
        run_linguistic_features(batch, speaker_data, levels, table, buckets=buckets)

    return (
        calls.writeStream.foreachBatch(once_per_batch(work, table, stream))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
