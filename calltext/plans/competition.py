"""The table of competition mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltext.functions.passages import competition_mentions
from calltext.operators.relational import natural_join
from calltext.operators.staging import stage

PASSAGE_KEY = ("file_name", "last_update", "section", "context", "speaker_number")


def competition_table(
    passages: DataFrame, keys: Sequence[str] = PASSAGE_KEY, text: str = "speaker_text",
    unique_keys: bool = False, **patterns,
) -> DataFrame:
    """Mentions with their exclusion flag.

    The flag belongs to the passage key: where a key occurs more than once every mention meets every
    flagged one of the same key, and a NULL in the key is never flagged. ``unique_keys`` promises
    keys that are unique and not NULL and saves the join.
    """
    found = competition_mentions(passages, text, **patterns).select(
        *keys, "preceding_words", "competition_word", "exclude_matches", "exclude")
    if unique_keys:
        return found
    found = stage(found)  # the texts are read once
    flagged = found.filter("exclude").select(*keys, "exclude_matches", "exclude")
    return natural_join(found.drop("exclude_matches", "exclude"), flagged, "left").withColumn(
        "exclude", F.coalesce("exclude", F.lit(False)))
