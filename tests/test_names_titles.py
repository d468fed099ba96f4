from calltext.functions.names import is_person, parse_name, parse_speaker_names
from calltext.functions.titles import parse_event_title
from tests.conftest import rows


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "speaker_name string")


def _parsed(spark, name, suffixes=False):
    got = rows(parse_speaker_names(_names(spark, name), "speaker_name", suffixes),
               "prefix", "first_name", "middle_name", "last_name")
    return got[0] if got else None


def test_particle_keeps_the_blank_of_the_split(spark):
    assert _parsed(spark, "Jan van Beek") == (None, "Jan", None, "van  Beek")


def test_middle_name(spark):
    assert _parsed(spark, "John Q. Public") == (None, "John", "Q.", "Public")


def test_one_word_name_vanishes(spark):
    assert _parsed(spark, "Madonna") is None


def test_longest_particle_wins(spark):
    assert _parsed(spark, "Juan de la Cruz") == (None, "Juan", None, "de la  Cruz")


def test_professor_is_no_prefix(spark):
    assert _parsed(spark, "Prof. Ann Lee") == (None, "Prof.", "Ann", "Lee")


def test_prefixes(spark):
    assert _parsed(spark, "Dr. Dr. Hans Maier") == ("Dr. Dr.", "Hans", None, "Maier")
    assert _parsed(spark, "Dr. -Ing. Hans Maier") == ("Dr. -Ing.", "Hans", None, "Maier")
    assert _parsed(spark, "Mr Smith") == (None, "Mr", None, "Smith")
    assert _parsed(spark, "Lcda. Ana Gil") == ("Lcda.", "Ana", None, "Gil")


def test_particle_is_a_separator_inside_words_too(spark):
    assert _parsed(spark, "Jan van Evans") == (None, "Jan", None, "van  E s")


def test_suffixes(spark):
    assert _parsed(spark, "John Q. Smith Jr.", True) == (None, "John", "Q.", "Smith")
    # The empty last name left by the cut is filled from the middle name.
    assert _parsed(spark, "Ann Brown III", True) == (None, "Ann", "", "Brown")
    assert _parsed(spark, "Ann Stone, Phd", True) == (None, "Ann", "Stone,", "Phd")
    # Without a middle name the fill-in is unknown.
    assert _parsed(spark, "Ann ", True) == (None, "Ann", None, None)


def test_suffix_cuts_inside_words_and_commas_end_last_names(spark):
    assert _parsed(spark, "AnnMDx Lee", True) is None
    assert _parsed(spark, "Ann B. Stone,Cfa", True) == (None, "Ann", "B.", "Stone")


def test_unparsed_rows_can_be_kept(spark):
    kept = parse_speaker_names(_names(spark, "Madonna"), "speaker_name", keep_unparsed=True)
    assert rows(kept) == [("Madonna", None, None, None, None)]


def test_person_filter_has_the_misspelling_and_drops_null_roles(spark):
    df = spark.createDataFrame(
        [("Unidentified", "Host"), ("unindented", "Host"), ("Operator", "Host"), ("Ann", None),
         ("Bob", "ANALYST"), ("Eve", "CEO")], "speaker_name string, role string")
    assert rows(df.filter(is_person()), "speaker_name") == [("Eve",), ("Unidentified",)]


def test_parse_name(spark):
    def parse(name):
        return tuple(_names(spark, name).select(parse_name("speaker_name").alias("n")).select(
            "n.prefix", "n.first_name", "n.middle_initial", "n.last_name", "n.suffix").first())

    assert parse("Mr John Q. Public, Jr") == ("Mr", "John", "Q.", "Public", "Jr")
    assert parse("Madonna") == (None, None, None, None, None)
    assert parse(None) == (None, None, None, None, None)
    assert parse("Juan de la Cruz") == (None, "Juan", None, "de la Cruz", None)
    # The prefix lets any one character follow.
    assert parse("Dre Smith") == ("Dre", None, None, None, None)
    assert parse("Ann Lee, ") == (None, "Ann", None, "Lee", "")


def test_event_titles(spark):
    df = spark.createDataFrame(
        [("Q3 2012 Acme Corp Earnings Conference Call",), ("Acme Investor Day",),
         ("Full Year 2011/2012 B Earnings and more",), ("Q1 2012-13 C Analyst Meeting",),
         ("Q5 2012 D Earnings",), ("Q1 2012 E Investor Day",)], "event_title string")
    assert rows(parse_event_title(df), "fisc_qtr_data", "event_co_name", "event_desc") == [
        ("Full Year 2011/2012", "B", "Earnings"),
        ("Q1 2012-13", "C", "Analyst Meeting"),
        ("Q3 2012", "Acme Corp", "Earnings Conference Call")]
    parts = parse_event_title(df.limit(1), period_parts=True).first()["fisc_qtr_data"]
    assert parts == ["Q3", "2012", "Acme Corp Earnings Conference Call"]
