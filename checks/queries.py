"""The registered queries, on the tables and views of ``checks.views``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltext.functions import names, passages, tickers
from calltext.functions.phonetic import soundex_code, soundex_difference
from calltext.functions.titles import parse_event_title
from calltext.operators.incremental import replace_by_key, todo
from calltext.operators.relational import natural_join, not_in
from calltext.operators.staging import remove_folder, shared_folder, stage
from calltext.plans import executives, features, jobs, link, quality, sentences
from calltext.plans.competition import competition_table
from calltext.plans.qa import qa_pairs
from calltext.sources import keyed, transcripts
from calltext.sources.writers import versions
from checks.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Words that occur in the given texts, for the patterns whose own words do not.
STEMS = ["th", "le", "que", "un"]
AUXILIARIES = ["the", "de", "la", "der"]
PARTICIPLES = ["for", "on", "en", "une"]
MENTION = "[Tt](?:(?:h(?:at|e))|re)s?"
NEGATORS = ["the", "of", "la", "de", "by"]

PASSAGE = ["file_name", "speaker_number", "section"]


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
    return build


def _day(column: str):
    return F.to_date(column).alias(column)


# -- tickers and calls -----------------------------------------------------------------------------

@query
def clean_tickers(t):
    clean = tickers.clean_ticker("company_ticker")
    return t["calls"].select(
        "file_path", "company_ticker", clean.alias("ticker"),
        tickers.strip_trailing_q(clean).alias("stripped"))


@query
def us_ticker_filter(t):
    return t["calls"].filter(tickers.is_us_ticker("company_ticker")).select(
        "file_path", "company_ticker")


@query
def calls_merged(t):
    return link.merge_feeds(t["calls"], t["calls_hbs"]).select(
        "file_name", _day("last_update"), "company_name", _day("start_date"), "company_ticker")


@query
def call_cutoff(t):
    return link.within_coverage(t["calls"], t["stocknames"]).select("file_path", _day("start_date"))


def _prepared(t):
    return link.prepare_calls(t["calls"], t["calls_hbs"], t["stocknames"])


@query
def earliest_call(t):
    return _prepared(t)


@query
def manual_override(t):
    return link.apply_overrides(_prepared(t), t["overrides"])


@query
def soundex_difference_of_names(t):
    pairs = t["calls"].select("file_path", "company_name", "cusip").join(
        t["stocknames"].select("comnam", "cusip"), "cusip")
    return pairs.select(
        "file_path", "company_name", "comnam", soundex_code("company_name").alias("code"),
        soundex_difference("company_name", "comnam").alias("difference"))


QUERIES["soundex_difference"] = QUERIES.pop("soundex_difference_of_names")


@query
def link_ticker_soundex(t):
    return link.match_on_soundex(_prepared(t), t["stocknames"])


@query
def link_company_soundex(t):
    return link.match_on_soundex(_prepared(t), t["stocknames"], link.COMPANY_DATES)


@query
def link_fuzzy_soundex(t):
    return link.match_on_fuzzy_soundex(_prepared(t), t["stocknames"])


@query
def link_edit_distance(t):
    return link.match_on_edit_distance(_prepared(t), t["stocknames"])


@query
def link_roll(t):
    return link.roll_on_soundex(_prepared(t), t["stocknames"])


@query
def link_cascade(t):
    return link.link_calls(_prepared(t), t["stocknames"], t["overrides"], t["deny_list"])


@query
def deny_list_not_in(t):
    return not_in(t["link"].select("file_name", "permno"), t["deny_list"], ["file_name", "permno"])


@query
def distinct_link(t):
    return quality.linked_files(t["link"])


# -- review loop -----------------------------------------------------------------------------------

def _joined(column: str):
    return F.array_join(column, "|").alias(column)


def _dupes(t):
    return quality.duplicate_quarters(quality.parsed_earnings_calls(t["calls"]), t["link"])


@query
def event_title_parse(t):
    return parse_event_title(t["calls"]).select(
        "file_path", "event_title", "fisc_qtr_data", "event_co_name", "event_desc")


@query
def dupe_calls(t):
    return _dupes(t).withColumn("start_date", F.to_date("start_date"))


@query
def dupe_counts(t):
    return quality.duplicate_counts(_dupes(t))


@query
def dupe_totals(t):
    return quality.duplicate_totals(_dupes(t))


@query
def names_per_id(t):
    return quality.names_per_id(t["stocknames"]).select("permno", _joined("comnams"))


@query
def anti_join_reviewed(t):
    return quality.names_to_review(_dupes(t), t["stocknames"], t["name_checks"]).select(
        "event_co_name", "permno", _joined("comnams"))


@query
def bad_matches_build(t):
    return quality.build_deny_list(
        t["name_checks"], quality.parsed_linked_calls(t["calls"], t["link"]), t["deny_list"])


@query
def conflicting_overrides(t):
    repaired = quality.repaired_overrides(t["repair_sheet"], "resolved by name")
    return quality.consolidate_overrides(t["overrides"], repaired, "checked twice")


@query
def natural_right_join(t):
    calls = t["calls"].select("file_path", "file_name", "event_title")
    return natural_join(parse_event_title(calls), calls, "right").select(
        "file_path", "file_name", "event_title", "fisc_qtr_data", "event_co_name")


@query
def latest_version(t):
    return quality.latest_titles(t["calls"]).withColumn("start_date", F.to_date("start_date"))


@query
def crowded_firm_years(t):
    return quality.crowded_firm_years(t["call_link"], t["calls"], t["companies"]).select(
        "file_name", "permno", "company_id", "fy_end", "cnt", "event_title", _day("start_date"),
        "company_name", _joined("fisc_qtr_data"), "event_co_name")


# -- names -----------------------------------------------------------------------------------------

@query
def speaker_filter(t):
    return t["speaker_data"].filter(names.is_person()).select(
        *PASSAGE, "context", "speaker_name", "role")


@query
def exec_role_filter(t):
    return t["speaker_data"].filter(executives.is_executive_role()).select(
        *PASSAGE, "context", "speaker_name", "role")


@query
def name_parse(t):
    return quality.speaker_names(t["speaker_data"])


@query
def name_parse_full(t):
    speakers = t["speaker_data"].select("speaker_name").distinct()
    return names.parse_speaker_names(speakers, "speaker_name", suffixes=True)


@query
def parse_name_struct(t):
    speakers = t["speaker_data"].select("speaker_name").distinct()
    return speakers.withColumn("name", names.parse_name("speaker_name")).select(
        "speaker_name", "name.*")


@query
def prefix_only_names(t):
    return quality.prefix_only_names(quality.speaker_names(t["speaker_data"]))


@query
def nickname_pairs(t):
    return quality.nickname_pairs(t["name_pairs"])


# -- executives ------------------------------------------------------------------------------------

@query
def cusip8_join(t):
    return executives.firm_year_ids(t["firm_years"], t["stocknames"])


@query
def firm_year_window(t):
    ids = executives.firm_year_ids(t["firm_years"], t["stocknames"])
    return executives.calls_in_firm_years(t["calls"], t["link"], ids).withColumn(
        "start_date", F.to_date("start_date"))


@query
def exec_link(t):
    return executives.link_executives(
        t["calls"], t["link"], t["firm_years"], t["stocknames"], t["executives"],
        t["executives_nd"], t["speaker_data"], t["exec_overrides"])


@query
def ambiguous_flag(t):
    return executives.ambiguous_speakers_of(t["exec_link"])


@query
def exec_id_backfill(t):
    return executives.backfill_executive_ids(t["exec_overrides"], t["id_sheet"], t["management"])


@query
def backfill_residue(t):
    return executives.backfill_residue(t["exec_overrides"], t["id_sheet"], t["management"])


@query
def ambiguous_speakers(t):
    return quality.ambiguous_speakers(t["exec_link"], t["speaker_data"], t["management"])


@query
def link_integrity(t):
    return quality.link_integrity(t["call_link"], t["exec_link"])


# -- passages --------------------------------------------------------------------------------------

@query
def clean_files_semi(t):
    new = natural_join(
        t["speaker_data_alt"], t["calls"].select("file_path", "file_name", "last_update"))
    return natural_join(new, quality.single_section_files(new), "left_semi").select(
        *PASSAGE, "context", "speaker_name", "speaker_text")


@query
def transcript_compare(t):
    return quality.compare_transcripts(
        t["speaker_data"], t["speaker_data_alt"], t["calls"]
    ).withColumn("last_update", F.to_date("last_update"))


@query
def qa_pairs_of_calls(t):
    return qa_pairs(t["speaker_data"], ["file_name", "section"])


QUERIES["qa_pairs"] = QUERIES.pop("qa_pairs_of_calls")


def _wanted(t):
    return t["calls"].filter(F.col("event_type") == 1)


@query
def incremental_todo(t):
    return todo(_wanted(t), t["done_keys"]).select("file_name", _day("last_update"))


@query
def incremental_todo_limited(t):
    """The limit is the feature here: one batch of work."""
    return todo(_wanted(t), t["done_keys"], limit=100).select("file_name", _day("last_update"))


@query
def incremental_todo_chained(t):
    return todo(_wanted(t), t["done_keys"], t["dupe_keys"]).select("file_name", _day("last_update"))


@query
def upsert_by_key(t):
    columns = ["file_name", _day("last_update"), "company_name", "company_ticker"]
    return replace_by_key(
        t["calls"].select(*columns), t["calls_hbs"].select(*columns), "file_name")


FEATURES = ["file_name", "speaker_name", "role", "speaker_number", "context",
            *features.TONE_CATEGORIES, "num_count"]


@query
def linguistic_features(t):
    return features.passage_features(
        t["speaker_data"], t["lexicon"],
        carry=["file_name", "speaker_name", "role", "speaker_number", "context"]).select(*FEATURES)


@query
def feature_update(t):
    columns = [c for c in features.LINGUISTIC_FEATURES.names if c not in FEATURES[5:]]
    previous = t["speaker_data"].filter(F.col("section") == 2).select(
        *columns, *[F.lit(-1).alias(c) for c in FEATURES[5:]])
    work = todo(_wanted(t), t["done_keys"])
    return features.update_features(
        t["speaker_data"], work, t["lexicon"], previous).select(*FEATURES)


def _named(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def _dropped(t, table: str, result):
    """The result, staged, without the tables that were made for it."""
    staged = stage(result)
    for name in [*versions(t.spark, table), f"{table}_done", f"{table}_batches"]:
        t.spark.sql(f"DROP TABLE IF EXISTS {name}")
    t.spark.sql(f"DROP VIEW IF EXISTS {table}")
    return staged


@query
def upsert_keyed(t):
    """Merge on read: the calls of one feed, replaced by those of the other, twice, then compacted."""
    columns = ["file_name", _day("last_update"), "company_name", "company_ticker"]
    first, second = t["calls"].select(*columns), t["calls_hbs"].select(*columns)
    table = _named("upsert")
    keyed.create_keyed_table(first, table, "file_name", buckets=8)
    keyed.replace_keys(second.filter("company_ticker IS NULL"), second, table)
    keyed.replace_keys(second, second, table)
    keyed.compact(t.spark, table)
    return _dropped(t, table, t.spark.table(table).drop(keyed.BUCKET))


@query
def transcript_xml(t):
    """Passages written as one XML document a call and read back from it."""
    columns = [*PASSAGE, _day("last_update"), "context", "speaker_name", "role", "speaker_text"]
    parsed = transcripts.parse_transcripts(transcripts.to_transcripts(t["speaker_data"]))
    return transcripts.accepted(parsed).select(*columns)


@query
def keyed_batch(t):
    """The passages of one limited batch of calls, read from the partitions of its files."""
    work = todo(_wanted(t), t["done_keys"], limit=100)
    table = _named("passages")
    keyed.create_keyed_table(t["speaker_data"], table, "file_name", buckets=64)
    return _dropped(t, table, keyed.rows_of_keys(t.spark, table, work).select(
        *PASSAGE, "context", "speaker_name", "role", "speaker_text"))


@query
def feature_stream(t):
    """The feature table as a stream over arriving calls makes it."""
    folder, table = f"{shared_folder(t.spark)}/{_named('arriving')}", _named("stream")
    t["calls"].write.parquet(f"{folder}/calls")
    calls = jobs.read_arriving(t.spark, f"{folder}/calls", t["calls"].schema, files=4)
    jobs.stream_linguistic_features(
        calls, t["speaker_data"], t["lexicon"], table, f"{folder}/offsets", buckets=16).awaitTermination()
    result = _dropped(t, table, t.spark.table(table).select(*FEATURES))
    remove_folder(t.spark, folder)
    return result


@query
def tone_counts(t):
    return features.tone_counts(
        t["documents"].select("doc_id", "lang", "text"), t["lexicon"], "text")


@query
def number_count(t):
    return t["documents"].select("doc_id", passages.number_count("text").alias("num_count"))


@query
def number_count_default(t):
    return t["documents_default"].select("doc_id", passages.number_count("text").alias("num_count"))


@query
def forward_looking_default(t):
    return t["documents_default"].select(
        "doc_id", passages.forward_looking_share("text").alias("share"))


@query
def comp_intensity_default(t):
    return competition_table(t["documents_default"], ["doc_id"], "text", unique_keys=True).select(
        "doc_id", "preceding_words", "competition_word",
        F.element_at("exclude_matches", 1).alias("exclude_match"), "exclude")


@query
def tone_counts_phrases(t):
    return features.tone_counts(t["documents_null"], t["lexicon_phrases"], "text")


@query
def passage_measures_null(t):
    return t["documents_null"].select(
        "doc_id", passages.number_count("text").alias("num_count"),
        passages.forward_looking_share("text", STEMS, AUXILIARIES, PARTICIPLES).alias("share"),
        *features.word_stats("text"))


@query
def lexicon_table(t):
    return features.lexicon_table(t["lexicon"]).select(
        "category", F.array_join("word_list", ",").alias("word_list"))


@query
def comp_intensity(t):
    return competition_table(
        t["documents"], ["doc_id"], "text", unique_keys=True, word=MENTION, negators=NEGATORS
    ).select("doc_id", "preceding_words", "competition_word",
             F.element_at("exclude_matches", 1).alias("exclude_match"), "exclude")


@query
def comp_intensity_joined(t):
    return competition_table(
        t["speaker_data"], ["file_name", "section", "context", "speaker_number"],
        word=MENTION, negators=NEGATORS,
    ).select(*PASSAGE, "context", "preceding_words", "competition_word",
             F.element_at("exclude_matches", 1).alias("exclude_match"), "exclude")


@query
def sentence_split(t):
    return t["documents"].select(
        "doc_id", F.posexplode_outer(passages.sentences("text")).alias("pos", "sentence")
    ).filter(F.col("pos").isNotNull())


@query
def learned_abbreviations(t):
    """Those with the scores of the shipped limit, and how sure they are to two digits."""
    return sentences.abbreviations(t["documents_default"], "text").select(
        "word", "n_with", "n_without", F.round("score", 2).alias("score"))


@query
def sentence_split_learned(t):
    known = sentences.abbreviations(t["documents_default"], "text")
    return sentences.split_sentences(t["documents_default"], known, ["doc_id"], "text")


@query
def forward_looking_share(t):
    return t["documents"].select("doc_id", passages.forward_looking_share(
        "text", STEMS, AUXILIARIES, PARTICIPLES).alias("share"))


@query
def word_stats(t):
    return t["documents"].select("doc_id", *features.word_stats("text"))


@query
def syllable_lexicon(t):
    return features.syllable_lexicon(t["pronunciations"])


def _syllables(t):
    return features.syllable_lexicon(t["pronunciations"])


@query
def syllable_features(t):
    rows = features.syllable_features(t["documents"].select("doc_id", "text"), _syllables(t), "text")
    record = F.col("syllable_data")
    return rows.select(
        "doc_id", record["sent_count"].alias("sent_count"),
        record["word_count"].alias("word_count"), record["word_7_count"].alias("word_7_count"),
        record["num_syllables"].alias("num_syllables"),
        F.to_json(record["syllable_counts"]).alias("syllable_counts"))


@query
def long_words(t):
    rows = features.long_words(t["documents"].select("doc_id", "text"), _syllables(t), "text")
    return rows.select("doc_id", F.array_join("long_words", " ").alias("long_words"))
