"""Review lists, deny lists, override tables and checks around the links."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltext.functions.names import PREFIX, is_person, parse_speaker_names
from calltext.functions.titles import parse_event_title
from calltext.operators.relational import (
    group_max_rows,
    groups_larger_than,
    natural_join,
    suffix_join,
    with_group_size,
)
from calltext.operators.staging import stage

EARNINGS_CALL = 1


# -- calls that share a quarter --------------------------------------------------------------------

def linked_files(link: DataFrame) -> DataFrame:
    """Distinct files and securities of the calls that have one."""
    return link.filter(F.col("permno").isNotNull()).select("file_name", "permno").distinct()


def parsed_earnings_calls(calls: DataFrame) -> DataFrame:
    """Earnings calls with their parsed title."""
    return parse_event_title(
        calls.filter(F.col("event_type") == EARNINGS_CALL)
        .select("file_name", "cusip", "start_date", "event_title").distinct())


def duplicate_quarters(parsed: DataFrame, link: DataFrame) -> DataFrame:
    """Parsed calls that share security and fiscal quarter with another one."""
    return groups_larger_than(natural_join(parsed, linked_files(link)), ["permno", "fisc_qtr_data"])


def duplicate_counts(dupes: DataFrame) -> DataFrame:
    """Number of such calls per security, largest first."""
    return dupes.groupBy("permno").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "permno")


def duplicate_totals(dupes: DataFrame) -> DataFrame:
    """Number of such calls and of their securities."""
    return dupes.agg(F.count("*").alias("n_calls"), F.countDistinct("permno").alias("n_permnos"))


def names_per_id(stocknames: DataFrame) -> DataFrame:
    """All names a security has had, as a sorted array; a missing name stays in, last."""
    names = stocknames.select("permno", "comnam").distinct()
    listed = F.array_sort(F.collect_list(F.struct("comnam")))
    return names.groupBy("permno").agg(
        F.transform(F.filter(listed, lambda e: e["comnam"].isNotNull()), lambda e: e["comnam"])
        .alias("__names"),
        F.transform(F.filter(listed, lambda e: e["comnam"].isNull()), lambda e: e["comnam"])
        .alias("__missing"),
    ).select("permno", F.concat("__names", "__missing").alias("comnams"))


def names_to_review(dupes: DataFrame, stocknames: DataFrame, checks: DataFrame) -> DataFrame:
    """Company and security names of the duplicates that nobody has reviewed yet."""
    return (
        dupes.select("event_co_name", "permno").distinct()
        .join(checks.select("event_co_name", "permno"), ["event_co_name", "permno"], "left_anti")
        .join(names_per_id(stocknames), "permno")
        .select("event_co_name", "permno", "comnams")
    )


def parsed_linked_calls(calls: DataFrame, link: DataFrame) -> DataFrame:
    """Distinct titles and company names of linked calls."""
    return (
        parse_event_title(calls).select("file_name", "event_title", "event_co_name")
        .join(link.filter(F.col("permno").isNotNull()).select("file_name", "permno"), "file_name")
        .distinct()
    )


def build_deny_list(checks: DataFrame, parsed_linked: DataFrame, old: DataFrame) -> DataFrame:
    """Calls whose name pair was reviewed as wrong, and the old deny list."""
    columns = ["file_name", "permno", "valid", "event_co_name", "comnams", "event_title"]
    wrong = checks.filter(F.col("valid") == F.lit(False))
    return (
        parsed_linked.join(wrong, ["event_co_name", "permno"]).select(*columns)
        .unionByName(old.select(*columns)).distinct()
    )


# -- overrides -------------------------------------------------------------------------------------

def repaired_overrides(sheet: DataFrame, comment: str) -> DataFrame:
    """Rows of the repair sheet that changed company, as overrides with a fixed comment."""
    return sheet.filter(~F.col("same_permco")).select(
        "file_name", "permno", "co_name", F.lit(comment).alias("comment"))


def consolidate_overrides(a: DataFrame, b: DataFrame, exempt_comment: str) -> DataFrame:
    """Both override tables without the files that have several permnos.

    Rows with the exempt comment stay, and so do rows without a comment.
    """
    rows = a.unionByName(b).distinct()
    conflicting = (
        rows.groupBy("file_name").agg(F.countDistinct("permno").alias("__n"))
        .filter(F.col("__n") > 1).select("file_name", F.lit(True).alias("__conflict"))
    )
    dropped = F.coalesce(
        F.col("__conflict") & (F.col("comment") != exempt_comment), F.lit(False))
    return rows.join(conflicting, "file_name", "left").filter(~dropped).drop("__conflict")


# -- names -----------------------------------------------------------------------------------------

def speaker_names(speaker_data: DataFrame) -> DataFrame:
    """Distinct speakers that are neither operator nor analyst, with their name parts."""
    names = speaker_data.filter(is_person()).select("speaker_name").distinct()
    return parse_speaker_names(names, "speaker_name").select(
        "speaker_name", "prefix", "first_name", "middle_name", "last_name")


def prefix_only_names(names: DataFrame) -> DataFrame:
    """First names that are only a prefix, with their number, most frequent first."""
    return (
        names.filter(F.col("first_name").rlike(f"^{PREFIX}$"))
        .groupBy("prefix", "first_name").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "prefix", "first_name")
    )


def nickname_pairs(pairs: DataFrame) -> DataFrame:
    """Nicknames and first names that were marked as valid."""
    return pairs.filter(F.col("valid")).select("fname_alt", "first_name")


# -- checks and reports ----------------------------------------------------------------------------

def link_integrity(call_link: DataFrame, exec_link: DataFrame) -> DataFrame:
    """Rows that break a rule, as ``check, violations``; all should be zero."""

    def repeated(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        groups = df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)
        return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(name).alias("check"), "violations")

    missing = F.col("company_id").isNull() | F.col("executive_id").isNull() | F.col(
        "file_name").isNull()
    return reduce(DataFrame.unionByName, [
        repeated(call_link, ["file_name", "company_id"], "call link: file and company unique"),
        repeated(call_link, ["file_name"], "call link: file unique"),
        exec_link.agg(F.count(F.when(missing, 1)).alias("violations")).select(
            F.lit("executive link: keys present").alias("check"), "violations"),
        repeated(exec_link.select("company_id", "file_name").distinct(), ["file_name"],
                 "executive link: one company per file"),
        repeated(exec_link, ["file_name", "speaker_name"],
                 "executive link: one executive per speaker"),
    ])


def latest_titles(calls: DataFrame) -> DataFrame:
    """Title and date of each file's latest version."""
    return group_max_rows(
        calls.select("file_name", "event_title", "start_date", "last_update").distinct(),
        ["file_name"], "last_update",
    ).drop("last_update")


def crowded_firm_years(
    call_link: DataFrame, calls: DataFrame, companies: DataFrame, more_than: int = 5
) -> DataFrame:
    """Links of firm-years with many calls, with title, company name and parsed title."""
    crowded = with_group_size(call_link, ["company_id", "fy_end"], "cnt").filter(
        F.col("cnt") > more_than)
    problem = stage(
        crowded.join(latest_titles(calls), "file_name", "left")
        .join(companies.select("company_id", "company_name").distinct(), "company_id"))
    parsed = parse_event_title(problem, period_parts=True).drop("event_desc")
    return natural_join(parsed, problem, "right")


def ambiguous_speakers(
    exec_link: DataFrame, speaker_data: DataFrame, management: DataFrame
) -> DataFrame:
    """Speakers linked to several executives, with their roles and the executives' titles."""
    return (
        groups_larger_than(exec_link, ["file_name", "speaker_name"])
        .join(speaker_data.select("file_name", "speaker_name", "role").distinct(),
              ["file_name", "speaker_name"], "left")
        .join(management.select("company_id", "executive_id", "title", "bio").distinct(),
              ["company_id", "executive_id"], "left")
    )


def single_section_files(passages: DataFrame) -> DataFrame:
    """File versions in which no passage number occurs more than once."""
    return (
        passages.groupBy("file_name", "last_update", "context", "speaker_number")
        .agg(F.count("*").alias("n"))
        .groupBy("file_name", "last_update").agg(F.max("n").alias("num_sections"))
        .filter(F.col("num_sections") == 1)
    )


def compare_transcripts(old: DataFrame, alt: DataFrame, calls: DataFrame) -> DataFrame:
    """Passages of the re-parsed transcripts beside the old ones, for single-section files."""
    new = natural_join(alt, calls.select("file_path", "file_name", "last_update")).drop("file_path")
    clean = natural_join(new, single_section_files(new), "left_semi")
    return suffix_join(clean, old, ["file_name", "last_update", "context", "speaker_number"])
