"""Measures of one passage of text. NULL text gives NULL, whatever ``spark.sql.ansi.enabled`` says.

Word characters are letters, digits and the underscore of any script, written out as ``W`` because
the short forms differ between regex engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"

# Months in full and by their first three letters.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]
MONTH = "(?:" + "|".join(MONTHS + [month[:3] + r"\.?" for month in MONTHS]) + ")"
# The look-ahead only lets most characters fail at once.
NUMBER = rf"(?=[ADFJMNOS0-9])(?:{MONTH}{SPACE}+)?[0-9][0-9,\.]*"
MONTH_OR_YEAR = rf"^(?:{MONTH}|[0-9]{{4}})"

# Forward-looking stems, and the past forms that cancel them.
FORWARD_STEMS = [
    "will", "should", "can", "could", "may", "might", "expect", "anticipate", "believe", "plan",
    "hope", "intend", "seek", "project", "forecast", "objective", "goal",
]
PAST_AUXILIARIES = ["was", "were", "had", "had been"]
PAST_PARTICIPLES = ["expected", "anticipated", "forecasted", "projected", "believed"]

# Competition words and the words before them that negate.
COMPETITION = "[Cc]ompet(?:(?:it(?:ion|or|ive))|e|ing)s?"
NEGATORS = ["not", "less", "few", "limited"]


def number_count(text: Column | str) -> Column:
    """Numbers in the text, leaving out those after a month and those starting with four digits."""
    return F.array_size(
        F.filter(F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0)),
                 lambda number: ~number.rlike(MONTH_OR_YEAR))
    )


def tone_pattern_count(text: Column | str, words: Sequence[str]) -> Column:
    """Whole-word hits of a short word list, matched as one pattern with the words unescaped.

    For word lists held as a table use ``plans.features.tone_counts``.
    """
    return F.regexp_count(text, F.lit(rf"(?<!{W})(?:{'|'.join(words)})(?!{W})"))


def sentences(text: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Sentences, ended by ``. ! ?`` and white space, but not after a listed abbreviation such as
    ``Mr`` (written without its full stop)."""
    if abbreviations:
        known = rf"(?<!{W})({'|'.join(abbreviations)})\.(?={SPACE})"
        text = F.regexp_replace(text, known, "$1\u0002")
    marked = F.regexp_replace(text, rf"([.!?]){SPACE}+", "$1\u0001")
    parts = F.filter(F.split(marked, "\u0001"), lambda sentence: sentence != "")
    return F.transform(parts, lambda s: F.translate(s, "\u0002", ".")) if abbreviations else parts


def forward_looking_share(
    text: Column | str, stems: Sequence[str] = FORWARD_STEMS,
    auxiliaries: Sequence[str] = PAST_AUXILIARIES, participles: Sequence[str] = PAST_PARTICIPLES,
) -> Column:
    """Share of sentences with a word that starts with a stem and no past form; NULL without any."""
    forward = rf"(?iu)(?<!{W})(?:{'|'.join(stems)})"
    past = rf"(?iu)(?<!{W})(?:{'|'.join(auxiliaries)}){SPACE}(?:{'|'.join(participles)})"
    parts = sentences(text)
    hits = F.filter(parts, lambda s: s.rlike(forward) & ~s.rlike(past))
    return F.array_size(hits) / F.nullif(F.array_size(parts), F.lit(0))


# A number with thousands separators, or a run of word characters that may hold . ' - / inside.
WORD = rf"[0-9][0-9.,]*,[0-9]+(?:\.[0-9]+)?|{W}(?:[\p{{L}}\p{{N}}_.'’/-]*{W})?"
APOSTROPHE = "['’]"
# Where a negation is cut off from its verb, and the endings that are left out.
CUT = (rf"(?i)(?=n['’]t(?:{NOT_W}|$))(?<=\p{{L}})"
       rf"|['’](?:s|m|d|ll|re|ve)(?={NOT_W}|$)")


def words(text: Column | str) -> Column:
    """Words in order: ``don't`` gives ``do`` and ``n't``, endings such as ``'s`` are dropped."""
    text = F.col(text) if isinstance(text, str) else text
    apart = F.when(text.rlike(APOSTROPHE), F.regexp_replace(text, CUT, " ")).otherwise(text)
    return F.regexp_extract_all(apart, F.lit(WORD), F.lit(0))


def tokens(text: Column | str) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_extract_all(text, F.lit(f"{W}+"), F.lit(0))


def led_tokens(text: Column | str) -> Column:
    """The tokens, each with what stands between it and the one before."""
    return F.regexp_extract_all(text, F.lit(f"{NOT_W}*+{W}++"), F.lit(0))


def competition_mentions(
    passages: DataFrame, text: str = "speaker_text", word: str = COMPETITION,
    negators: Sequence[str] = NEGATORS,
) -> DataFrame:
    """First competition word of each passage with up to three words before it.

    ``exclude_matches`` holds the first negator among them with a non-word character on both sides,
    ``exclude`` tells whether there is one. Passages without a mention vanish.
    """
    # The word alone decides whether there is a match; the costlier pattern runs on those rows only.
    # Words before it begin where a word begins and are not tried again in part.
    pattern = rf"((?:(?<!{W})(?:{W}++{NOT_W}++){{1,3}})?)({word})"
    negated = rf"{NOT_W}(?:{'|'.join(negators)}){NOT_W}"
    found = passages.filter(F.col(text).rlike(word)).withColumn(
        "__found", F.regexp_extract(text, pattern, 0))
    # The match is a few words, so both parts are taken from it and not from the text again.
    return (
        found.withColumns({
            "preceding_words": F.regexp_extract("__found", pattern, 1),
            "competition_word": F.regexp_extract("__found", pattern, 2),
        })
        .drop("__found")
        .withColumn(
            "exclude_matches",
            F.when(F.col("preceding_words").rlike(negated),
                   F.array(F.regexp_extract("preceding_words", negated, 0))),
        )
        .withColumn("exclude", F.col("exclude_matches").isNotNull())
    )
