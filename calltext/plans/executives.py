"""Linking speakers to executives, and moving old manual links to the newer executive ids."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.functions.names import parse_name, parse_speaker_names
from calltext.operators.relational import natural_join, not_in, suffix_join
from calltext.operators.staging import stage

# Speakers that are no persons, and the roles that are linked.
NOT_A_NAME = "(?i)^(Unident|Operator)"
EXECUTIVE_ROLE = r"C\.?E\.?O|Chief Executive|Chair"

SPEAKER = ["file_name", "speaker_name"]
MATCH_COLUMNS = [
    "file_name", "speaker_name", "executive", "equilar_id", "fy_end", "equilar_executive_id",
    "match_type",
]


def firm_year_ids(firm_years: DataFrame, stocknames: DataFrame) -> DataFrame:
    """Firm-years with the permno of the security that shares the first eight cusip characters."""
    cusips = stocknames.select(F.col("cusip").alias("__cusip"), F.col("permno").cast("int"))
    return firm_years.join(
        cusips, F.substring("cusip", 1, 8) == F.col("__cusip"), "left"
    ).select("equilar_id", "cusip", "permno", "fy_end").distinct()


def calls_in_firm_years(calls: DataFrame, link: DataFrame, firm_ids: DataFrame) -> DataFrame:
    """Linked calls with the firm-years that end within twelve months of them."""
    year = F.col("start_date").between(F.add_months("fy_end", -12), F.add_months("fy_end", 12))
    return (
        calls.select("file_name", "start_date")
        .join(link.select("file_name", "permno"), "file_name")
        .join(firm_ids.filter(F.col("equilar_id").isNotNull()), "permno")
        .filter(year)
        .select("file_name", "start_date", "equilar_id", "fy_end").distinct()
    )


def is_executive_role(role: str = "role") -> Column:
    """Chief executives and chairs; NULL roles are not known to be."""
    return (F.col(role) != "Analyst") & F.col(role).rlike(EXECUTIVE_ROLE)


def executive_speakers(speaker_data: DataFrame, overrides: DataFrame) -> DataFrame:
    """Distinct executive speakers of each call that have no manual match."""
    speakers = (
        speaker_data.filter(~F.col("speaker_name").rlike(NOT_A_NAME) & is_executive_role())
        .select("file_name", "speaker_name", "role", "employer").distinct()
    )
    return not_in(speakers, overrides.select(*SPEAKER), SPEAKER)


def staff_classes(executives: DataFrame) -> DataFrame:
    """Executives of one firm-year with one name, as a row: ``staff_id, equilar_id, fy_end, executive,
    last_name, first_name`` (upper case), ``later, rivals, people, n``. It is staged, which fixes the
    ids, and names are taken apart once a row, after the rows are made.

    An executive of a firm counts in the latest firm-year that fits a call: ``later`` are the years
    in which the firm has the executive again, under whatever name. One who is with several firms in
    a year counts for the first of those on a call; ``rivals`` are the firms before this one.
    """
    ids = ["equilar_id", "equilar_executive_id"]
    known = executives.dropna(subset=[*ids, "fy_end"])
    name = parse_name("executive")
    years = known.groupBy(*ids).agg(F.collect_set("fy_end").alias("__years"))
    held = known.join(years, ids).withColumn(
        "later", F.array_sort(F.filter("__years", lambda year: year > F.col("fy_end"))))
    person = ["equilar_executive_id", "executive", "fy_end"]
    firms = held.groupBy(*person).agg(
        F.collect_set(F.struct("equilar_id", "later")).alias("__firms"))
    rivals = F.filter("__firms", lambda firm: firm["equilar_id"] < F.col("equilar_id"))
    classes = held.join(firms, person).withColumn("rivals", F.array_sort(rivals)).groupBy(
        "equilar_id", "fy_end", "executive", "later", "rivals").agg(
            F.collect_list("equilar_executive_id").alias("people"))
    # The filter comes after the staging, or it would take apart the name of every row read.
    return stage(classes.withColumns({
        "first_name": F.upper(name["first_name"]), "last_name": F.upper(name["last_name"]),
        "n": F.size("people"), "staff_id": F.monotonically_increasing_id(),
    })).filter(F.col("last_name").isNotNull())


def staff_on_calls(speakers: DataFrame, matched_calls: DataFrame, staff: DataFrame) -> DataFrame:
    """Which classes of ``staff`` each speaker is: ``file_name, speaker_name, fy_end, staff_id, n,
    match_type``. Those of the full name, or else of the last name, in any firm of the call.

    ``speakers`` holds ``file_name, speaker_name, first_name, last_name, fy_end``. The last name is a
    hash key of the join, so the full staff of a firm is never listed for each of its calls.
    """
    years = matched_calls.groupBy("file_name", "equilar_id").agg(
        F.collect_set("fy_end").alias("years"))
    on_call = years.groupBy("file_name").agg(
        F.collect_list(F.struct("equilar_id", "years")).alias("firms"))
    asked = speakers.join(on_call, "file_name").select(
        *SPEAKER, "fy_end", "last_name", F.col("first_name").alias("__first"), "firms",
        F.explode("firms").alias("__firm")).select(
            "*", F.col("__firm.equilar_id").alias("equilar_id"),
            F.col("__firm.years").alias("years")).filter(F.array_contains("years", F.col("fy_end")))

    def counted(firm: Column) -> Column:
        return F.exists("firms", lambda f: (f["equilar_id"] == firm["equilar_id"])
                        & F.array_contains(f["years"], F.col("fy_end"))
                        & ~F.arrays_overlap(f["years"], firm["later"]))

    found = asked.join(staff.drop("executive", "people").hint("merge"), ["equilar_id", "fy_end", "last_name"]).filter(
        ~F.arrays_overlap("years", "later") & ~F.exists("rivals", counted)).select(
            *SPEAKER, "fy_end", "staff_id", "n",
            F.coalesce(F.col("first_name") == F.col("__first"), F.lit(False)).alias("__full"))
    found = stage(found)
    best = found.groupBy(*SPEAKER, "fy_end").agg(F.max("__full").alias("__full"))
    return found.join(best, [*SPEAKER, "fy_end", "__full"]).select(
        *SPEAKER, "fy_end", "staff_id", "n",
        F.when(F.col("__full"), "full name").otherwise("last name").alias("match_type"))


# Rows of a result that a task lists, and the tasks up to which that holds.
LISTED_ROWS = 2_000_000
LISTING_TASKS = 4_096


def list_staff(rows: DataFrame, staff: DataFrame) -> DataFrame:
    """``rows``, which are staged, once for each of the ``n`` executives of their class ``staff_id``.

    Spark deals a join out by the bytes it reads, which say nothing of the rows that lists make. So the
    tasks are as many as the result asks for, and a class that lists more than one task's rows has them
    dealt out in slices, each beside a copy of its list. Such classes are at most as many as tasks.
    """
    session = rows.sparkSession
    weights = stage(rows.groupBy("staff_id").agg((F.count("*") * F.max("n")).alias("weight")))
    total = weights.agg(F.sum("weight")).first()[0] or 0
    most = max(LISTING_TASKS, int(session.conf.get("spark.sql.shuffle.partitions")))
    share = max(LISTED_ROWS, ceil(total / most))
    tasks = max(1, ceil(total / share))
    heavy = F.broadcast(weights.filter(F.col("weight") > share).select(
        "staff_id", F.ceil(F.col("weight") / share).cast("int").alias("__slices")))
    key = ["staff_id", "__slice"]
    slices = F.coalesce("__slices", F.lit(1))
    dealt = rows.join(heavy, "staff_id", "left").withColumn(
        "__slice", F.pmod(F.hash(*SPEAKER), slices).cast("int"))
    lists = staff.select("staff_id", "executive", "people").join(heavy, "staff_id", "left").select(
        "staff_id", "executive", "people",
        F.explode(F.sequence(F.lit(0), slices - 1)).alias("__slice"))
    return dealt.drop("__slices").repartition(tasks, *key).join(
        lists.repartition(tasks, *key).hint("merge"), key).select(
            "*", F.explode("people").alias("equilar_executive_id")).drop("people", "__slice")


def link_executives(
    calls: DataFrame, link: DataFrame, firm_years: DataFrame, stocknames: DataFrame,
    executives: DataFrame, executives_nd: DataFrame, speaker_data: DataFrame, overrides: DataFrame,
) -> DataFrame:
    """Every executive speaker with manual, full-name, last-name or no match.

    ``ambiguous`` marks speakers with more than one row; every version of a call repeats its rows.
    Speakers travel with classes of executives, which the last join lists.
    """
    speaker = parse_name("speaker_name")
    speakers = stage(
        executive_speakers(speaker_data, overrides)
        .withColumns({"first_name": F.upper(speaker["first_name"]),
                      "last_name": F.upper(speaker["last_name"])}))
    with_speakers = calls.join(speakers.select("file_name").distinct(), "file_name", "left_semi")
    matched_calls = stage(
        calls_in_firm_years(with_speakers, link, firm_year_ids(firm_years, stocknames)))
    columns = ["equilar_executive_id", "equilar_id", "executive", "fy_end"]
    everyone = executives.select(*columns).unionByName(executives_nd.select(*columns)).distinct()
    staff = staff_classes(everyone)
    names = ["first_name", "last_name"]
    rows = stage(speakers.select(*SPEAKER, *names).join(matched_calls, "file_name").select(
        *SPEAKER, *names, "equilar_id", "fy_end").distinct())
    found = stage(staff_on_calls(
        rows.drop("equilar_id").distinct(), matched_calls, staff))

    unmatched = rows.select(*SPEAKER, "equilar_id", "fy_end").join(
        found.select(*SPEAKER).distinct(), SPEAKER, "left_anti")
    latest = unmatched.groupBy(*SPEAKER).agg(F.max("fy_end").alias("fy_end"))

    manual = overrides.select(
        *SPEAKER, "executive", F.col("equilar_id").cast("int").alias("equilar_id"),
        F.lit(None).cast("date").alias("fy_end"),
        F.col("equilar_executive_id").cast("int").alias("equilar_executive_id"),
        F.lit("manual").alias("match_type")).distinct()
    none = unmatched.drop("fy_end").distinct().join(latest, SPEAKER).withColumn(
        "match_type", F.lit("no match"))
    matched = rows.select(*SPEAKER, "equilar_id", "fy_end").join(found, [*SPEAKER, "fy_end"])
    one = F.lit(1).alias("n")
    matches = stage(
        manual.select("*", one)
        .unionByName(none.select("*", one), allowMissingColumns=True)
        .unionByName(matched, allowMissingColumns=True))
    ambiguous = matches.groupBy(*SPEAKER).agg((F.sum("n") > 1).alias("ambiguous"))
    known = stage(matches.join(ambiguous, SPEAKER).join(
        calls.select("file_name", "event_type"), "file_name"))
    result = [*MATCH_COLUMNS, "ambiguous", "event_type"]
    of_staff = known.filter(F.col("staff_id").isNotNull()).drop("executive", "equilar_executive_id")
    return known.filter(F.col("staff_id").isNull()).select(*result).unionByName(
        list_staff(of_staff, staff).select(*result))


def ambiguous_speakers_of(matches: DataFrame) -> DataFrame:
    """Whether a speaker of a call has more than one match."""
    return matches.groupBy(*SPEAKER).agg((F.count("*") > 1).alias("ambiguous"))


# -- newer executive ids ---------------------------------------------------------------------------

# How a newer id was found.
BY_MANAGEMENT_ID = "(company_id, management_id)"
BY_SHEET = "from gs: (manual_add_executive_id)"
BY_FULL_NAME = "(company_id, fname, lname)"
BY_LAST_NAME = "(company_id, lname)"


def _management_names(management: DataFrame) -> DataFrame:
    ids = ["company_id", "management_id", "executive_id"]
    named = management.select(*ids, F.concat("fname", F.lit(" "), "lname").alias("full_name"))
    return parse_speaker_names(
        named.distinct(), "full_name", suffixes=True, keep_unparsed=True
    ).select(*ids, "first_name", "last_name")


def _good(overrides: DataFrame) -> DataFrame:
    return overrides.filter(F.col("good_match")).withColumnsRenamed(
        {"equilar_id": "company_id", "equilar_executive_id": "management_id"})


def _unlinked(overrides: DataFrame, sheet: DataFrame, names: DataFrame):
    """The manual matches joined on the management id, and the rest joined with the sheet."""
    manual = parse_speaker_names(
        _good(overrides).select(*SPEAKER, "company_id", "management_id"),
        "speaker_name", suffixes=True, keep_unparsed=True,
    ).drop("prefix", "middle_name")
    by_id = stage(suffix_join(manual, names, ["company_id", "management_id"], "left"))
    rest = by_id.filter(F.col("executive_id").isNull()).select(
        *SPEAKER, "company_id", F.upper("first_name_x").alias("first_name"),
        F.upper("last_name_x").alias("last_name")).distinct()
    sheet = sheet.select(*SPEAKER, "company_id", "management_id", "executive_id")
    return by_id, stage(rest.join(sheet, [*SPEAKER, "company_id"], "left"))


def _ids_by(names: DataFrame, *keys: str) -> DataFrame:
    """The newer ids of the executives with equal keys, and whether all of these have one."""
    return stage(names.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.collect_set("executive_id").alias("ids"),
        F.bool_and(F.col("executive_id").isNotNull()).alias("all_known")))


def backfill_executive_ids(
    overrides: DataFrame, sheet: DataFrame, management: DataFrame
) -> DataFrame:
    """Manual matches with the newer executive id, by the first of four rules that finds one:
    same management id, manual sheet, first and last name, last name.

    A person who also meets an executive without a newer id goes on to the next rule. By name, persons
    travel once each, and the ids of a name are listed by the last join.
    """
    names = stage(_management_names(management))
    by_id, by_sheet = _unlinked(overrides, sheet, names)
    person = [*SPEAKER, "company_id"]
    full_name, last_name = ["company_id", "first_name", "last_name"], ["company_id", "last_name"]
    of_full, of_last = _ids_by(names, *full_name), _ids_by(names, *last_name)

    by_name = stage(
        by_sheet.filter(F.col("executive_id").isNull())
        .select(*person, "first_name", "last_name").distinct()
        .join(of_full.drop("ids").hint("merge"), full_name, "left"))
    by_last = by_name.filter(~F.coalesce("all_known", F.lit(False)))

    # The management id is the one the manual match came with.
    result = [*SPEAKER, "executive", "company_id", "management_id", "executive_id", "match_type",
              "good_match", "comments", "exe_id_match"]
    good = stage(_good(overrides).select(
        *[c for c in result if c not in ("executive_id", "exe_id_match")]).distinct())

    def found(df: DataFrame, label: str) -> DataFrame:
        return df.filter(F.col("executive_id").isNotNull()).select(
            *person, "executive_id", F.lit(label).alias("exe_id_match")).distinct().join(
                good, person, "left").select(*result)

    def listed(df: DataFrame, names: DataFrame, keys: list[str], label: str) -> DataFrame:
        met = df.drop("all_known").join(good, person, "left").join(
            names.filter(F.size("ids") > 0).hint("merge"), keys)
        return met.select("*", F.explode("ids").alias("executive_id")).withColumn(
            "exe_id_match", F.lit(label)).select(*result)

    return reduce(DataFrame.unionByName, [
        found(by_id, BY_MANAGEMENT_ID), found(by_sheet, BY_SHEET),
        listed(by_name, of_full, full_name, BY_FULL_NAME),
        listed(by_last, of_last, last_name, BY_LAST_NAME)])


def backfill_residue(overrides: DataFrame, sheet: DataFrame, management: DataFrame) -> DataFrame:
    """Counts of what the first two rules leave: rows, companies, companies with any newer
    executive, and candidate rows of these, as ``measure, n``."""
    names = stage(_management_names(management))
    _, by_sheet = _unlinked(overrides, sheet, names)
    rest = by_sheet.filter(F.col("executive_id").isNull()).select(*SPEAKER, "company_id")
    companies = rest.select("company_id").distinct()

    def measure(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("measure"), "n")

    # Each company's executives are counted, not listed, before they meet the open rows.
    staff = names.groupBy("company_id").agg(F.count("*").alias("n_staff"))
    candidates = rest.join(staff, "company_id").agg(
        F.coalesce(F.sum("n_staff"), F.lit(0)).alias("n"))
    return reduce(DataFrame.unionByName, [
        measure(rest, "rows without id"),
        measure(companies, "companies without id"),
        measure(natural_join(companies, names.select("company_id").distinct()),
                "companies without id that have executives"),
        candidates.select(F.lit("candidate rows").alias("measure"), "n"),
    ])
