"""Event titles such as ``Q3 2012 Acme Corp Earnings Conference Call``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Period and event wording.
QUARTER = "(Preliminary Half Year|Full Year|Q[1-4])"
YEAR = "(20[0-9]{2}(?:-[0-9]{2}|/20[0-9]{2})?)"
EVENT = (
    "(Earnings(?: Conference Call)?|Financial and Operating Results|Financial Results Call|"
    "Results Conference Call|Analyst Meeting)"
)
PERIOD_PATTERN = f"(?s)^{QUARTER} {YEAR} (.*)"
COMPANY_PATTERN = f"(?s)^(.*) {EVENT}"


def parse_event_title(
    df: DataFrame, title: str = "event_title", period_parts: bool = False
) -> DataFrame:
    """Add ``fisc_qtr_data``, ``event_co_name`` and ``event_desc``; titles that do not fit vanish.

    ``fisc_qtr_data`` is quarter and year as a text, or with ``period_parts`` an array of quarter,
    year and the rest of the title.
    """
    quarter, year, rest = [F.regexp_extract(title, PERIOD_PATTERN, i) for i in (1, 2, 3)]
    return (
        df.filter(F.col(title).rlike(PERIOD_PATTERN) & rest.rlike(COMPANY_PATTERN))
        .withColumns({
            "fisc_qtr_data": F.array(quarter, year, rest) if period_parts
            else F.concat(quarter, F.lit(" "), year),
            "event_co_name": F.regexp_extract(rest, COMPANY_PATTERN, 1),
            "event_desc": F.regexp_extract(rest, COMPANY_PATTERN, 2),
        })
    )
