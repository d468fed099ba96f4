"""Line dedup by content-defined chunks of lines.

A line's hash decides whether a chunk ends with it, so a passage is cut alike wherever it stands and
however many lines were put in before it. Chunks that repeat are found by digest; each is then grown
over the lines before and after it as long as they equal those around its first copy, so that what is
removed does not depend on where the cuts fell. Runs of several lines whose bytes equal those of the
first copy, by their SHA-256, go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.operators.staging import stage

# A chunk ends with a line unless the hash of its last ROLL lines leaves no remainder by DIVISOR: short
# chunks, as a chunk must lie within a repeated run to find it. LAWS ways of cutting, each with hashes
# of its own, find runs that another one cuts badly.
ROLL = 1
DIVISOR = 4
LAWS = 2
LEAST_LINES = 2
SPLIT = "\n"
LAST_ID = 2**63 - 1


def _with_chunks(hashed: DataFrame, roll: int, divisor: int, laws: int) -> DataFrame:
    """``(_key, _hash, from, digest, before)`` for the chunks of ``hashed (_key, _hash, _h)``: where each
    begins and where the same chunk began the time before in its text, NULL at the first."""
    n = F.size("_h")

    def ends(law: int) -> Column:
        def cut(i: Column) -> Column:
            rolled = F.xxhash64(F.lit(law), *(F.get("_h", i - j) for j in range(roll)))
            return (F.pmod(rolled, F.lit(divisor)) != 0) | (i == n - 1)

        return F.filter(F.sequence(F.lit(0), n - 1), cut)

    def chunks(law: int) -> Column:
        e = F.col(f"_e{law}")
        return F.transform(e, lambda end, i: F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get(e, i - 1) + 1).alias("from"), end.alias("last")))

    cut = hashed.filter(n > 0).withColumns({f"_e{law}": ends(law) for law in range(laws)}).withColumn(
        "_c", F.flatten(F.array(*(chunks(law) for law in range(laws)))))
    digests = cut.withColumn("_d", F.transform("_c", lambda c: F.aggregate(
        F.slice("_h", c["from"] + 1, c["last"] - c["from"] + 1), F.lit(0).cast("long"),
        lambda a, h: F.xxhash64(a, h))))
    exploded = digests.select("_key", "_hash", F.explode(F.arrays_zip(
        F.col("_c.from").alias("from"), F.col("_d").alias("digest"))).alias("c"))
    return exploded.groupBy("_key", "_hash", "c.digest").agg(
        F.array_sort(F.collect_set("c.from")).alias("_all")).select(
            "_key", "_hash", "digest", F.explode(F.transform("_all", lambda at, i: F.struct(
                at.alias("from"), F.get("_all", i - 1).alias("before")))).alias("c")).select(
                    "_key", "_hash", "digest", "c.*")


def _grown(pairs: DataFrame, hashed: DataFrame, least: int) -> DataFrame:
    """``(_key, _hash, from, to, f_key, f_hash, f_from)``: for ``pairs (_key, _hash, f_key, f_hash,
    shift, starts)``, chunks that begin ``shift`` lines further on in another copy, the runs of
    ``least`` or more equal lines around them. A run that goes on into its own copy is a text that
    repeats itself; it stays once, with ``least`` lines at least."""
    first = hashed.select(F.col("_key").alias("f_key"), F.col("_hash").alias("f_hash"),
                          F.col("_h").alias("_f"))
    both = pairs.join(hashed, ["_key", "_hash"]).join(first, ["f_key", "f_hash"])
    n, shift = F.size("_h"), F.col("shift")
    differ = F.filter(F.sequence(F.lit(-1), n), lambda i: F.coalesce(
        F.get("_h", i) != F.get("_f", i + shift), F.lit(True)))
    same = (F.col("_key") == F.col("f_key")) & (F.col("_hash") == F.col("f_hash"))

    # In a text that repeats itself every so many lines, what is compared is a whole number of those
    # repeats back, enough for ``least`` lines.
    back = F.when(same, F.ceil(F.lit(least) / -shift).cast("int") * -shift).otherwise(-shift)

    def run(at: Column) -> Column:
        low = F.array_max(F.filter("_x", lambda i: i < at)) + 1
        high = F.array_min(F.filter("_x", lambda i: i > at))
        return F.struct(F.when(same, low + shift + back).otherwise(low).alias("from"), high.alias("to"))

    # A place before the first line, and the one after the last, differ from all.
    grown = both.withColumn("_x", differ).select(
        "_key", "_hash", "f_key", "f_hash", back.alias("back"),
        F.explode(F.array_distinct(F.transform(F.filter(
            "starts", lambda at: ~F.array_contains("_x", at)), run))).alias("r"))
    return grown.select(
        "_key", "_hash", "r.from", "r.to", "f_key", "f_hash", (F.col("r.from") - F.col("back")).alias("f_from")
    ).filter(F.col("to") - F.col("from") >= least).distinct()


def _texts_of(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """``(_key, _hash, from, to, bytes)`` of the lines of ``spans``, ``bytes`` being the SHA-256 of what
    stands there: runs overlap, so their bytes may be many times the text."""
    places = spans.groupBy("_key", "_hash").agg(F.collect_set(F.struct("from", "to")).alias("_places"))
    # Texts are split once: a column that is read twice is not put in where it is used. Rows with one key
    # and text give the same digests, so they are made distinct without their text.
    parted = rows.join(places, ["_key", "_hash"]).withColumn("_lines", F.split("_text", SPLIT, -1))
    return parted.select("_key", "_hash", F.explode(F.transform("_places", lambda c: F.struct(
        c["from"].alias("from"), c["to"].alias("to"), F.unhex(F.sha2(F.array_join(F.slice(
            "_lines", c["from"] + 1, c["to"] - c["from"]), SPLIT), 256)).alias("bytes")))).alias("c")).select(
                "_key", "_hash", "c.*").distinct()


def _union(spans: Column) -> Column:
    """Sorted (from, to) without overlap: of each, what lies behind the ends of those before it."""
    ends = F.transform(spans, lambda s, i: F.struct(
        s["from"].alias("from"), s["to"].alias("to"),
        F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda p: p["to"])),
                   F.lit(0)).alias("before")))
    return F.filter(F.transform(ends, lambda s: F.struct(
        F.greatest(s["from"], s["before"]).alias("from"), s["to"].alias("to"))),
        lambda s: s["from"] < s["to"])


def without_repeated_chunks(
    docs: DataFrame, key: str = "doc_id", text: str = "text", roll: int = ROLL,
    divisor: int = DIVISOR, laws: int = LAWS, least: int = LEAST_LINES,
) -> DataFrame:
    """``(key, n_lines, n_removed, kept)`` for every row of ``docs``: its text without the runs of
    ``least`` or more lines around a chunk that stands earlier in it or in a row with a smaller key.

    Chunks travel as a digest of their line hashes and their place. Of those that repeat, each meets
    the line hashes of its own text and of its first copy, and grows over equal neighbours; then the
    SHA-256 of grown runs and of their first copies are compared. Frequent chunks are summed by each task
    first, and what many rows are joined with is staged, so that adaptive execution can split them.

    Keys are whole numbers; a null key comes after all others. Rows with one key do not remove each
    other's chunks. A null text has no lines and stays null, an empty one has one empty line; an
    empty table gives no rows. A text is held whole by a task, with its line hashes and chunks.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{key}`"), F.lit(LAST_ID)).cast("long").alias("_key"),
        F.xxhash64(f"`{text}`").alias("_hash"), F.col(f"`{text}`").alias("_text"))
    with_text = rows.filter("_text IS NOT NULL")
    hashed = stage(with_text.select("_key", "_hash", F.transform(
        F.split("_text", SPLIT, -1), lambda line: F.xxhash64(line)).alias("_h")).dropDuplicates(
            ["_key", "_hash"]))
    chunks = stage(_with_chunks(hashed, roll, divisor, laws))
    # Within a text a copy is compared with the one before it, and only the first one with other texts:
    # so a line that fills a text gives a few distances, not one for each of its places.
    own = chunks.filter("before IS NULL")
    firsts = stage(own.groupBy("digest").agg(
        F.min(F.struct("_key", "_hash", "from")).alias("first"), F.max("_key").alias("most")
    ).filter("first._key < most").select(
        "digest", F.col("first._key").alias("f_key"), F.col("first._hash").alias("f_hash"),
        F.col("first.from").alias("f_from")))
    earlier = own.join(firsts, "digest").filter("f_key < _key").select(
        "_key", "_hash", "f_key", "f_hash", (F.col("f_from") - F.col("from")).alias("shift"), "from")
    within = chunks.filter("before IS NOT NULL").select(
        "_key", "_hash", F.col("_key").alias("f_key"), F.col("_hash").alias("f_hash"),
        (F.col("before") - F.col("from")).alias("shift"), "from")
    pairs = earlier.unionByName(within).groupBy("_key", "_hash", "f_key", "f_hash", "shift").agg(
        F.collect_set("from").alias("starts"))
    runs = stage(_grown(pairs, hashed, least))
    sources = runs.select(F.col("f_key").alias("_key"), F.col("f_hash").alias("_hash"),
                          F.col("f_from").alias("from"),
                          (F.col("f_from") + F.col("to") - F.col("from")).alias("to"))
    content = stage(_texts_of(runs.select("_key", "_hash", "from", "to").unionByName(sources), with_text))
    held = content.select(F.col("_key").alias("f_key"), F.col("_hash").alias("f_hash"),
                          F.col("from").alias("f_from"), F.col("to").alias("f_to"),
                          F.col("bytes").alias("f_bytes"))
    copies = runs.withColumn("f_to", F.col("f_from") + F.col("to") - F.col("from")).join(
        content, ["_key", "_hash", "from", "to"]).join(
        held, ["f_key", "f_hash", "f_from", "f_to"]).filter("bytes = f_bytes")
    removed = copies.groupBy("_key", "_hash").agg(
        F.array_sort(F.collect_set(F.struct("from", "to"))).alias("_spans")).select(
            "_key", "_hash", _union(F.col("_spans")).alias("_removed"))
    joined = rows.join(removed, ["_key", "_hash"], "left").withColumn(
        "_lines", F.split("_text", SPLIT, -1)).withColumn(
            "_removed", F.coalesce("_removed", F.array().cast("array<struct<from:int,to:int>>")))
    n = F.size("_lines")
    left = F.flatten(F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("_removed", lambda s: s["to"])),
        F.concat(F.transform("_removed", lambda s: s["from"]), F.array(n)),
        lambda a, b: F.slice("_lines", a + 1, b - a)))
    gone = F.aggregate("_removed", F.lit(0), lambda a, s: a + s["to"] - s["from"])
    kind = docs.schema[key].dataType
    known = F.col("_text").isNotNull()
    return joined.select(
        F.when(F.col("_key") != LAST_ID, F.col("_key")).cast(kind).alias(key),
        F.when(known, n).otherwise(0).cast("long").alias("n_lines"),
        F.when(known, gone).otherwise(0).cast("long").alias("n_removed"),
        F.when(F.size("_removed") == 0, F.col("_text")).otherwise(
            F.array_join(left, SPLIT)).alias("kept"))
