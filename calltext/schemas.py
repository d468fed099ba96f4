"""Schemas of the tables that are read from exports or created empty."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


_text, _int, _long, _bool = StringType(), IntegerType(), LongType(), BooleanType()
_date, _time = DateType(), TimestampType()

CALLS = _schema(
    file_name=_text, last_update=_time, start_date=_time, company_name=_text, company_ticker=_text,
    event_type=_int, event_title=_text, cusip=_text, file_path=_text,
)
CALLS_HBS = _schema(
    file_name=_text, last_update=_time, start_date=_time, company_name=_text, company_ticker=_text,
)
SPEAKER_DATA = _schema(
    file_name=_text, last_update=_time, speaker_name=_text, employer=_text, role=_text,
    speaker_number=_int, context=_text, section=_int, speaker_text=_text, language=_text,
)
STOCKNAMES = _schema(
    permno=_int, ticker=_text, comnam=_text, cusip=_text,
    namedt=_date, nameenddt=_date, st_date=_date, end_date=_date,
)
MANUAL_PERMNO_MATCHES = _schema(file_name=_text, co_name=_text, permno=_int, comment=_text)
NAME_CHECKS = _schema(event_co_name=_text, permno=_int, comnams=_text, valid=_bool)
BAD_MATCHES = _schema(
    file_name=_text, permno=_int, valid=_bool, event_co_name=_text, comnams=_text, event_title=_text,
)
FIRM_YEARS = _schema(equilar_id=_int, cusip=_text, fy_end=_date)
EXECUTIVES = _schema(equilar_executive_id=_int, equilar_id=_int, executive=_text, fy_end=_date)
EXECUTIVE_MANUAL_MATCHES = _schema(
    file_name=_text, speaker_name=_text, executive=_text, equilar_id=_long,
    equilar_executive_id=_long, match_type=_text, good_match=_bool, comments=_text,
)
MANUAL_ADD_EXECUTIVE_ID = _schema(
    file_name=_text, speaker_name=_text, company_id=_long, management_id=_long, executive_id=_long,
)
PROXY_MANAGEMENT = _schema(
    company_id=_long, management_id=_long, executive_id=_long, fname=_text, lname=_text,
    title=_text, bio=_text,
)
FIRST_NAME_PAIRS = _schema(fname_alt=_text, first_name=_text, valid=_bool)
PRONUNCIATIONS = _schema(word=_text, phones=ArrayType(_text))
LEXICON = _schema(category=_text, word=_text)

# The categories of the tone word lists.
TONE_CATEGORIES = [
    "positive", "negative", "uncertainty", "litigious", "modal_strong", "modal_weak",
]

LINGUISTIC_FEATURES = _schema(
    file_name=_text, last_update=_time, speaker_name=_text, employer=_text, role=_text,
    speaker_number=_int, context=_text, language=_text,
    **{category: _int for category in TONE_CATEGORIES}, num_count=_int,
)
SYLLABLE_DATA = _schema(
    file_name=_text, last_update=_time, context=_text, section=_int, speaker_number=_int,
    syllable_data=_schema(
        sent_count=_int, word_count=_int, word_7_count=_int, num_syllables=_int,
        syllable_counts=MapType(_int, _int),
    ),
)
