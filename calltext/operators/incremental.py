"""Working through a growing set of calls a batch at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def todo(
    wanted: DataFrame, done: DataFrame | None, *excluded: DataFrame,
    keys: Sequence[str] = ("file_name", "last_update"), limit: int | None = None,
) -> DataFrame:
    """Distinct wanted keys that are neither excluded nor done, NULL equal to NULL.

    ``done=None`` is the first run. ``limit`` takes that many keys in key order.
    """
    left = wanted.select(*keys).distinct()
    for other in (*excluded, *([] if done is None else [done])):
        left = left.subtract(other.select(*keys))
    return left if limit is None else left.orderBy(*keys).limit(limit)


def replace_by_key(
    old: DataFrame, new: DataFrame, key: str, processed: DataFrame | None = None
) -> DataFrame:
    """``old`` without the rows of the processed keys, plus ``new``.

    ``processed`` names the keys worked on, which may include some that gave no new rows.
    """
    gone = (new if processed is None else processed).select(key).distinct()
    return old.join(gone, key, "left_anti").unionByName(new)


def of_todo_files(passages: DataFrame, todo_keys: DataFrame) -> DataFrame:
    """Passages of the files to do. Work is by file, so every version of a file is included."""
    return passages.join(todo_keys.select("file_name").distinct(), "file_name", "left_semi")


