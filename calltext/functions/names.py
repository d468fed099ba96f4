"""Person names: two parsers with different rules, as the name tables were built with both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefixes of speaker names. "Gov." and "Prof." only occur joined, and the dot of
# "Lcda." is open; both are part of the expected results. Longer alternatives come first because
# the source database takes the longest one and Java the first.
PREFIX = (
    r"(?:Sir|Sen\.|Maj\.SEN\.|SIR\.|Rep\.|M[RS]\.|DR\.|MRS\.|Gov\.Prof\.?"
    r"|Dr\.\s?-Ing\.|Dr\.(?: Dr\.)?|Prof\.? Dr\.|Ms\.?|REP\.?|[MD]rs?\.?|Lcda.|Miss\.)"
)
# Particles of last names, longest first.
PARTICLE = r"(?:[Dd]e [Ll]a|[Dd][aeu]|[Vv][ao]n [Dd]e[rn]?|[Vv][ao]n)"
# Suffixes that end a name, also inside a word.
SUFFIX = r"(?:\sJr\.?|II|III|MD)"
# Speakers that are no persons. "Unindent" is spelled so in the source.
NOT_A_NAME = "(?i)^(Unindent|Operator)"
ANALYST = "(?i)Analyst"

NAME_PATTERN = rf"(?s)^(?:({PREFIX})\s)?(.*?)\s(.*)$"
PARTICLES_PATTERN = rf"^(?:({PARTICLE})\s)*"

# Fixed values of the second parser, in Perl syntax. The prefix lets any character follow.
PERL_PREFIX = "[MD]rs?.?"
PERL_PARTICLE = r"(?:(?:[Dd][eu]|[Dd]e la|[Vv]an [Dd]e[rn]?|[Vv]an)\s)"


def _or_null(extracted: Column) -> Column:
    """NULL for a group that took no part; only for groups that cannot match an empty text."""
    return F.nullif(extracted, F.lit(""))


def is_person(name: str = "speaker_name", role: str = "role") -> Column:
    """Neither operator nor analyst; a NULL role is not known to be either and drops out."""
    return ~F.col(name).rlike(NOT_A_NAME) & ~F.col(role).rlike(ANALYST)


def parse_speaker_names(
    df: DataFrame, name: str, suffixes: bool = False, keep_unparsed: bool = False
) -> DataFrame:
    """Split ``name`` into ``prefix, first_name, middle_name, last_name``; one-word names vanish.

    With ``suffixes`` the name is cut at the first suffix, the last name at the first comma, and an
    empty last name is filled from the middle name. ``keep_unparsed`` keeps the rows that would
    vanish, with NULLs.
    """
    full = F.split(F.col(name), SUFFIX, 2)[0] if suffixes else F.col(name)
    fits = F.col("__full").rlike(NAME_PATTERN)
    df = df.withColumn("__full", full)
    if keep_unparsed:
        df = df.withColumn("__full", F.when(fits, F.col("__full")))
    else:
        df = df.filter(fits)
    pieces = F.col("__pieces")
    several = F.size(pieces) > 1
    last = F.when(
        several, F.array_join(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(1))), " ")
    ).otherwise(pieces[0])
    parsed = (
        df.withColumns({
            "prefix": _or_null(F.regexp_extract("__full", NAME_PATTERN, 1)),
            "first_name": F.trim(F.regexp_extract("__full", NAME_PATTERN, 2)),
            "__rest": F.regexp_extract("__full", NAME_PATTERN, 3),
        })
        .withColumn("__particle", _or_null(F.regexp_extract("__rest", PARTICLES_PATTERN, 1)))
        # A particle is used as the separator throughout the rest of the name.
        .withColumn("__pieces", F.split("__rest", F.coalesce("__particle", F.lit(r"\s"))))
        .withColumns({
            "middle_name": F.when(several, _or_null(pieces[0])),
            "last_name": F.trim(
                F.when(F.col("__particle").isNull(), last)
                .otherwise(F.concat(F.col("__particle"), F.lit(" "), last))
            ),
        })
    )
    if suffixes:
        middle, last_name = F.col("middle_name"), F.col("last_name")
        empty = (last_name == "") & (middle != "")
        parsed = (
            parsed.withColumn("last_name", F.split("last_name", ",", 2)[0])
            # An unknown condition (no middle name) gives NULL, not the second branch.
            .withColumn("last_name", F.when(empty, middle).when(~empty, last_name))
            .withColumn(
                "middle_name",
                F.when(middle == last_name, F.lit("")).when(middle != last_name, middle),
            )
        )
    return parsed.drop("__full", "__rest", "__particle", "__pieces")


def parse_name(name: Column | str) -> Column:
    """Struct of ``first_name, middle_initial, last_name, suffix, prefix``; NULLs where absent."""
    text = F.col(name) if isinstance(name, str) else name
    before = F.regexp_extract(text, r"(?d)^(.*?)(?:, (.*))?$", 1)
    suffix = F.when(F.length(text) > F.length(before),
                    F.substring(text, F.length(before) + 3, F.length(text)))
    prefix_pattern = rf"(?d)^({PERL_PREFIX})\s+"
    prefix = _or_null(F.regexp_extract(before, prefix_pattern, 1))
    names = F.regexp_replace(before, prefix_pattern, "")
    split_pattern = rf"(?d)^(.*?)\s({PERL_PARTICLE}?[^\s]+)$"
    given = F.regexp_extract(names, split_pattern, 1)
    given_pattern = r"(?U)([-\w.]+)\s*([\w.]+)?"
    return F.struct(
        _or_null(F.regexp_extract(given, given_pattern, 1)).alias("first_name"),
        _or_null(F.regexp_extract(given, given_pattern, 2)).alias("middle_initial"),
        _or_null(F.regexp_extract(names, split_pattern, 2)).alias("last_name"),
        suffix.alias("suffix"),
        prefix.alias("prefix"),
    )
