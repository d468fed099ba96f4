from datetime import date, datetime

import pytest

from calltext.plans import executives, quality
from calltext.schemas import (
    CALLS,
    EXECUTIVE_MANUAL_MATCHES,
    EXECUTIVES,
    FIRM_YEARS,
    MANUAL_ADD_EXECUTIVE_ID,
    PROXY_MANAGEMENT,
    SPEAKER_DATA,
    STOCKNAMES,
)
from tests.conftest import rows

FY4, FY5 = date(2004, 12, 31), date(2005, 12, 31)
V1, V2 = datetime(2005, 6, 1), datetime(2005, 7, 1)


def call(f, version, event_type=1, title=None, start=datetime(2005, 6, 1, 9)):
    return (f, version, start, None, None, event_type, title, None, "path/" + f)


def spoken(f, name, role, number=1, context="qa"):
    return (f, V1, name, "Acme", role, number, context, 1, "text", "en")


@pytest.fixture(scope="module")
def linked(spark):
    calls = spark.createDataFrame([call("f", V1), call("f", V2), call("g", V1)], CALLS)
    link = spark.createDataFrame([("f", 1, 1, "x"), ("g", None, 11, "x")],
                                 "file_name string, permno int, match_type int, d string")
    firm_years = spark.createDataFrame(
        [(10, "12345678X", FY4), (10, "12345678X", FY5), (11, "none", FY4)], FIRM_YEARS)
    stocks = spark.createDataFrame(
        [(1, "A", "A", "12345678", None, None, None, None)], STOCKNAMES)
    people = spark.createDataFrame([
        (100, 10, "Ann Lee", FY4), (100, 10, "Ann Lee", FY5), (101, 10, "Bob Roy", FY5),
        (102, 10, "Bea Roy", FY5), (103, 10, "Old Timer", FY4), (104, 11, "Far Away", FY4)],
        EXECUTIVES)
    speakers = spark.createDataFrame([
        spoken("f", "Ann Lee", "Chief Executive Officer"), spoken("f", "Ann Lee", "CEO", 2),
        spoken("f", "Dr. Zoe Roy", "C.E.O"), spoken("f", "Cy Nil", "Chairman"),
        spoken("f", "Old Timer", "CEO"), spoken("f", "Man Ual", "CEO"),
        spoken("f", "Una Nalyst", "Analyst"), spoken("f", "Cfo Person", "CFO"),
        spoken("f", "Unidentified Person", "CEO"), spoken("f", "Null Role", None),
        spoken("g", "Ann Lee", "CEO")], SPEAKER_DATA)
    manual = spark.createDataFrame(
        [("f", "Man Ual", "MAN UAL", 10, 109, "m", True, None)], EXECUTIVE_MANUAL_MATCHES)
    return executives.link_executives(
        calls, link, firm_years, stocks, people, people.limit(0), speakers, manual)


def test_executive_link(linked):
    got = rows(linked.distinct(), "speaker_name", "executive", "equilar_executive_id", "fy_end",
               "match_type", "ambiguous")
    assert got == [
        ("Ann Lee", "Ann Lee", 100, FY5, "full name", False),
        ("Cy Nil", None, None, FY5, "no match", False),
        ("Dr. Zoe Roy", "Bea Roy", 102, FY5, "last name", True),
        ("Dr. Zoe Roy", "Bob Roy", 101, FY5, "last name", True),
        ("Man Ual", "MAN UAL", 109, None, "manual", False),
        ("Old Timer", "Old Timer", 103, FY4, "full name", False)]


def test_every_version_of_a_call_repeats_the_match(linked):
    assert linked.filter("speaker_name = 'Cy Nil'").count() == 2


def test_year_window_is_inclusive_and_compares_times(spark):
    calls = spark.createDataFrame([
        call("on", V1, start=datetime(2005, 12, 31)), call("after", V1, start=datetime(
            2005, 12, 31, 9)), call("from", V1, start=datetime(2003, 12, 31))], CALLS)
    link = spark.createDataFrame([("on", 1), ("after", 1), ("from", 1)], "file_name string, permno int")
    ids = spark.createDataFrame([(10, "c", 1, FY4)],
                                "equilar_id int, cusip string, permno int, fy_end date")
    assert rows(executives.calls_in_firm_years(calls, link, ids), "file_name") == [
        ("from",), ("on",)]


def test_backfill_rules_in_order(spark):
    def match(name, management, good=True):
        return ("f", name, "E", 1, management, "m", good, None)

    manual = spark.createDataFrame([
        match("By Id", 50), match("By Sheet", 51), match("Full Name", 52), match("Some Last", 53),
        match("No Body", 54), match("Bad Row", 50, False)], EXECUTIVE_MANUAL_MATCHES)
    sheet = spark.createDataFrame([("f", "By Sheet", 1, 61, 901)], MANUAL_ADD_EXECUTIVE_ID)
    staff = spark.createDataFrame([
        (1, 50, 900, "X", "Y", None, None), (1, 70, 902, "FULL", "NAME", None, None),
        (1, 71, 903, "OTHER", "LAST", None, None), (1, 72, 904, "ANY", "NAME", None, None)],
        PROXY_MANAGEMENT)
    got = executives.backfill_executive_ids(manual, sheet, staff)
    assert rows(got, "speaker_name", "management_id", "executive_id", "exe_id_match") == [
        ("By Id", 50, 900, "(company_id, management_id)"),
        ("By Sheet", 51, 901, "from gs: (manual_add_executive_id)"),
        ("Full Name", 52, 902, "(company_id, fname, lname)"),
        ("Some Last", 53, 903, "(company_id, lname)")]
    assert dict(rows(executives.backfill_residue(manual, sheet, staff))) == {
        "rows without id": 3, "companies without id": 1,
        "companies without id that have executives": 1, "candidate rows": 12}


def test_override_conflicts(spark):
    schema = "file_name string, permno int, comment string"
    a = spark.createDataFrame([
        ("null comment", 1, None), ("null comment", 2, None), ("other", 1, "x"), ("other", 2, "x"),
        ("exempt", 1, "keep"), ("exempt", 2, "x"), ("null permno", None, "x"),
        ("null permno", 1, "x")], schema)
    b = spark.createDataFrame([("null permno", 1, "x"), ("single", 3, "x")], schema)
    assert rows(quality.consolidate_overrides(a, b, "keep")) == [
        ("exempt", 1, "keep"), ("null comment", 1, None), ("null comment", 2, None),
        ("null permno", None, "x"), ("null permno", 1, "x"), ("single", 3, "x")]


def test_repaired_overrides_drop_unknown(spark):
    sheet = spark.createDataFrame(
        [("a", 1, "A", False), ("b", 2, "B", True), ("c", 3, "C", None)],
        "file_name string, permno int, co_name string, same_permco boolean")
    assert rows(quality.repaired_overrides(sheet, "why"), "file_name", "comment") == [("a", "why")]


def test_names_per_id_keeps_missing_names(spark):
    df = spark.createDataFrame([(1, "B"), (1, "A"), (1, "A"), (1, None)], "permno int, comnam string")
    assert rows(quality.names_per_id(df)) == [(1, ["A", "B", None])]


def test_crowded_firm_years(spark):
    title = "Q1 2005 Acme Earnings"
    calls = spark.createDataFrame(
        [call(f"f{i}", v, 1, t) for i in range(4) for v, t in ((V1, "old"), (V2, title))], CALLS)
    link = spark.createDataFrame(
        [(f"f{i}", 1, 10, FY5) for i in range(3)] + [("f3", 1, 11, FY5), ("f9", 1, 10, FY5)],
        "file_name string, permno int, company_id int, fy_end date")
    companies = spark.createDataFrame([(10, "ACME"), (10, "ACME")], "company_id int, company_name string")
    got = rows(quality.crowded_firm_years(link, calls, companies, more_than=3),
               "file_name", "cnt", "event_title", "event_co_name", "company_name")
    assert got == [(f"f{i}", 4, title, "Acme", "ACME") for i in range(3)] + [
        ("f9", 4, None, None, "ACME")]


def test_duplicate_quarters(spark):
    calls = spark.createDataFrame([
        call("a", V1, 1, "Q1 2005 Acme Earnings"), call("b", V1, 1, "Q1 2005 Acme Earnings Call"),
        call("c", V1, 1, "Q2 2005 Acme Earnings"), call("d", V1, 2, "Q2 2005 Acme Earnings")], CALLS)
    link = spark.createDataFrame([(f, 1) for f in "abcd"], "file_name string, permno int")
    dupes = quality.duplicate_quarters(quality.parsed_earnings_calls(calls), link)
    assert rows(dupes, "file_name") == [("a",), ("b",)]


def test_transcripts(spark):
    calls = spark.createDataFrame([call("f", V1), call("g", V1)], CALLS)
    old = spark.createDataFrame(
        [spoken("f", "Old Name", "CEO", 1), spoken("g", "Old Name", "CEO", 1)], SPEAKER_DATA)
    schema = "file_path string, speaker_name string, speaker_number int, context string"
    alt = spark.createDataFrame([
        ("path/f", "New Name", 1, "qa"), ("path/g", "Twice", 1, "qa"), ("path/g", "Twice", 1, "qa")],
        schema)
    assert rows(quality.compare_transcripts(old, alt, calls), "file_name", "speaker_name_x",
                "speaker_name_y") == [("f", "New Name", "Old Name")]


def test_prefix_only_names(spark):
    names = spark.createDataFrame(
        [(None, "Mr"), (None, "Mr"), (None, "Dr."), (None, "Mira")], "prefix string, first_name string")
    got = [tuple(r) for r in quality.prefix_only_names(names).collect()]
    assert got == [(None, "Mr", 2), (None, "Dr.", 1)]


def test_executives_are_listed_after_the_last_exchange(linked):
    plan = linked._jdf.queryExecution().executedPlan().toString()
    before, listed, _ = plan.partition("Generate explode(people")
    above = before.rsplit("ExistingRDD", 1)[-1]  # what stands over it in its own branch of the union
    assert listed and "Exchange" not in above and "Aggregate" not in above


def test_one_person_in_several_firms_and_years(spark):
    """Counted once for each firm-year of the speaker, in the latest year of each firm, whichever firm
    of the call the person is with."""
    calls = spark.createDataFrame([call("f", V1)], CALLS)
    link = spark.createDataFrame([("f", 1), ("f", 2)], "file_name string, permno int")
    firm_years = spark.createDataFrame(
        [(10, "12345678X", FY4), (10, "12345678X", FY5), (11, "87654321X", FY4),
         (11, "87654321X", FY5)], FIRM_YEARS)
    stocks = spark.createDataFrame([(1, "A", "A", "12345678", None, None, None, None),
                                    (2, "B", "B", "87654321", None, None, None, None)], STOCKNAMES)
    people = spark.createDataFrame([
        (100, 10, "Ann Lee", FY4), (100, 10, "Ann Marry", FY5),  # renamed: not Lee any more
        (100, 11, "Ann Lee", FY4), (101, 10, "Bob Roy", FY5), (101, 11, "Bob Roy", FY5),
        (102, 11, "Bea Roy", FY4), (None, 11, "No Id", FY4)], EXECUTIVES)
    speakers = spark.createDataFrame([
        spoken("f", n, "CEO") for n in ("Ann Lee", "Bob Roy", "Zoe Roy", "No Id")], SPEAKER_DATA)
    got = executives.link_executives(
        calls, link, firm_years, stocks, people, people, speakers,
        spark.createDataFrame([], EXECUTIVE_MANUAL_MATCHES))
    got = rows(got, "speaker_name", "equilar_id", "fy_end", "executive", "match_type", "ambiguous")
    assert sorted(got, key=repr) == sorted(
        [("Ann Lee", e, FY4, "Ann Lee", "full name", True) for e in (10, 11)]
        + [("Bob Roy", e, FY5, "Bob Roy", "full name", True) for e in (10, 11)]
        + [("Bob Roy", e, FY4, "Bea Roy", "last name", True) for e in (10, 11)]
        + [("Zoe Roy", e, y, n, "last name", True) for e in (10, 11)
           for y, n in ((FY4, "Bea Roy"), (FY5, "Bob Roy"))]
        + [("No Id", e, FY5, None, "no match", True) for e in (10, 11)], key=repr)


def test_ids_of_a_name_are_listed_after_the_last_exchange(spark):
    """A person who meets executives with and without a newer id goes on to the last name, once."""
    manual = spark.createDataFrame([
        ("f", "Full Name", "E", 1, 52, "m", True, None),
        ("f", "Full Name", "E", 1, 53, "m", True, None)], EXECUTIVE_MANUAL_MATCHES)
    staff = spark.createDataFrame([
        (1, 70, 902, "FULL", "NAME", None, None), (1, 71, None, "FULL", "NAME", None, None),
        (1, 72, None, "FULL", "NAME", None, None), (1, 73, 904, "ANY", "NAME", None, None),
        (1, 74, 904, "ANY", "NAME", None, None)], PROXY_MANAGEMENT)
    got = executives.backfill_executive_ids(
        manual, spark.createDataFrame([], MANUAL_ADD_EXECUTIVE_ID), staff)
    assert rows(got, "management_id", "executive_id", "exe_id_match") == [
        (m, e, rule) for m in (52, 53) for e, rule in (
            (902, "(company_id, fname, lname)"), (902, "(company_id, lname)"),
            (904, "(company_id, lname)"))]
    plan = got._jdf.queryExecution().executedPlan().toString()
    before, listed, _ = plan.partition("Generate explode(ids")
    above = before.rsplit("ExistingRDD", 1)[-1]
    assert listed and "Exchange" not in above and "Aggregate" not in above


def _crowd(spark, people, speakers):
    """A speaker in each call, all with one firm-year, in which all executives have the last name."""
    names = spark.range(people).selectExpr(
        "cast(id AS int) AS equilar_executive_id", "10 AS equilar_id", "'Ann Lee' AS executive",
        f"DATE '{FY5}' AS fy_end")
    calls = spark.createDataFrame([call(f"f{i}", V1) for i in range(speakers)], CALLS)
    link = calls.selectExpr("file_name", "1 AS permno")
    firm_years = spark.createDataFrame([(10, "12345678X", FY5)], FIRM_YEARS)
    stocks = spark.createDataFrame(
        [(1, "A", "A", "12345678", None, None, None, None)], STOCKNAMES)
    said = spark.createDataFrame([spoken(f"f{i}", "Zoe Lee", "CEO") for i in range(speakers)], SPEAKER_DATA)
    manual = spark.createDataFrame([], EXECUTIVE_MANUAL_MATCHES)
    return executives.link_executives(
        calls, link, firm_years, stocks, names, names.limit(0), said, manual)


def test_a_listing_is_dealt_out_by_the_rows_it_makes(spark, monkeypatch):
    """40 calls meet one class of 50: 2,000 rows, of which a task is to list about 100."""
    monkeypatch.setattr(executives, "LISTED_ROWS", 100, raising=False)
    from pyspark.sql import functions as F

    got = _crowd(spark, 50, 40)
    assert got.select("file_name", "equilar_executive_id").distinct().count() == got.count() == 2000
    tasks = got.groupBy(F.spark_partition_id()).count().agg(F.count("*"), F.max("count")).first()
    assert tasks[0] >= 8 and tasks[1] <= 600


def test_names_of_executives_are_taken_apart_after_they_are_gathered(spark, monkeypatch):
    """Not for every row that is read, in the tasks that read them."""
    staged = []

    def kept(df, real=executives.stage):
        staged.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(executives, "stage", kept)
    people = spark.createDataFrame([(100, 10, "Ann Lee", FY4), (101, 10, None, FY4)], EXECUTIVES)
    classes = executives.staff_classes(people.distinct())
    assert rows(classes, "last_name", "n") == [("LEE", 1)]
    (plan,) = staged
    _, gathered, below = plan.partition("Aggregate(")
    assert gathered and "regexp" not in below
