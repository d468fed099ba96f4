"""Call tables derived from the given test tables.

Each view is one SQL text that Spark and DuckDB both read, with its inputs in braces. ``vocabulary``
and ``pronunciations`` need array functions that the two spell differently, so they have two texts.
"""

from __future__ import annotations

import re
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from calltext.operators.staging import stage

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

FIRST_NAMES = ["Jan", "John Q.", "Juan", "Ann", "Lee-Anne", "Hans", "Mary Lou"]
LAST_NAMES = [
    "van Beek", "Public", "de la Cruz", "Lee", "van Evans", "Smith Jr.", "Stone, Jr", "de Souza",
    "Van der Berg", "Ashcraft", "Brown III", "Maddox",
]
PREFIXES = ["", "Dr. ", "Mr ", "Prof. ", "Ms. ", "Dr. Dr. ", "", "Sen. "]

PATTERN_SENTENCES = [
    "We sold 12,500 units on January 15 and 3.5 in Feb. 1998.",
    "We will grow and we could hire 40 people!", "Sales were expected to grow, as we hope.",
    "There is not much competition in 1998.", "Our limited competitive edge may help 7 firms.",
    "Others compete with 1.5 stores on May 4. Should they?", "No competitor had anticipated it.",
    "Competes fewer.",
]
PHRASES = [
    "a well-known, can''t-miss name", "can''t", "far below plan", "well known and far below  plan",
    "unwell-known can''ts", "plan well-known far below plan",
]


def pick(number: str, values: list[str]) -> str:
    """The value at ``number`` modulo their count."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


def person(number: str) -> str:
    return f"{pick(number, FIRST_NAMES)} || ' ' || {pick(number + ' * 7 + 3', LAST_NAMES)}"


YEAR_END = (
    "CASE p_partkey % 4 WHEN 0 THEN DATE '1996-12-31' WHEN 1 THEN DATE '1997-12-31' "
    "WHEN 2 THEN DATE '1998-12-31' ELSE DATE '1999-12-31' END"
)

VIEWS = {
    # -- calls ---------------------------------------------------------------------------------
    "call_rows": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, p_name,
               CAST(floor(o_orderkey / 3) AS BIGINT) AS n,
               (p_partkey % 97) * 7919 % 9973 AS k, ((p_partkey + 1) % 97) * 7919 % 9973 AS k_next,
               'F' || CAST(floor(o_orderkey / 3) AS BIGINT) AS file_name,
               o_orderdate AS last_update
        FROM {orders} JOIN {part} ON p_partkey = o_custkey""",
    "calls": """
        SELECT file_name, last_update, last_update AS start_date, p_name AS company_name,
               CASE o_orderkey % 10 WHEN 0 THEN '**T' || k WHEN 1 THEN 'T' || k || '.A'
                    WHEN 2 THEN 'T' || k || '.TO' WHEN 3 THEN 'T' || k || 'Q' WHEN 4 THEN NULL
                    WHEN 5 THEN 'T' || k_next ELSE 'T' || k END AS company_ticker,
               CAST(1 + o_orderkey % 2 AS INT) AS event_type,
               CASE WHEN o_orderkey % 8 = 0 THEN p_name || ' Investor Day'
                    ELSE 'Q' || (1 + o_orderkey % 4) || ' ' || (year(last_update) + 6) || ' '
                         || p_name || ' Earnings Conference Call' END AS event_title,
               lpad(CAST(o_custkey AS STRING), 8, '0') AS cusip,
               'path/' || o_orderkey AS file_path
        FROM {call_rows}""",
    "calls_hbs": """
        SELECT file_name, last_update, upper(p_name) AS company_name,
               CAST(NULL AS TIMESTAMP) AS start_date, 'T' || k AS company_ticker
        FROM {call_rows} WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT 'H' || n AS file_name, last_update, p_name AS company_name,
               CAST(last_update AS TIMESTAMP) AS start_date, 'T' || k_next AS company_ticker
        FROM {call_rows} WHERE o_orderpriority = '5-LOW'""",
    "stocknames": """
        SELECT CAST(10000 + p_partkey AS INT) AS permno, 'T' || ((p_partkey % 97) * 7919 % 9973) AS ticker,
               upper(CASE p_partkey % 5 WHEN 0 THEN p_name || ' inc'
                     WHEN 1 THEN replace(p_name, 'e', 'a') ELSE p_name END) AS comnam,
               lpad(CAST(p_partkey AS STRING), 8, '0') AS cusip,
               DATE '1995-01-01' + CAST(20 * p_size AS INT) AS namedt,
               DATE '1995-01-01' + CAST(20 * p_size + 900 AS INT) AS nameenddt,
               DATE '1995-01-01' + CAST(20 * p_size - 300 AS INT) AS st_date,
               DATE '1995-01-01' + CAST(20 * p_size + 1200 AS INT) AS end_date
        FROM {part}""",
    "overrides": """
        SELECT DISTINCT file_name, CAST(NULL AS STRING) AS co_name,
               CAST(10000 + o_custkey AS INT) AS permno,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'checked twice' WHEN '2-HIGH' THEN NULL
                    ELSE 'from the sheet' END AS comment
        FROM {call_rows} WHERE o_totalprice > 470000
        UNION ALL
        SELECT DISTINCT file_name, upper(p_name) AS co_name, CAST(NULL AS INT) AS permno,
               'not a match' AS comment
        FROM {call_rows} WHERE o_totalprice < 15000""",
    "repair_sheet": """
        SELECT file_name, CAST(10001 + o_custkey AS INT) AS permno, p_name AS co_name,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS same_permco
        FROM {call_rows} WHERE o_totalprice > 440000""",
    "deny_list": """
        SELECT file_name, CAST(NULL AS INT) AS permno, false AS valid, p_name AS event_co_name,
               upper(p_name) AS comnams, 'none' AS event_title
        FROM {call_rows} WHERE o_totalprice BETWEEN 100000 AND 115000
        UNION ALL
        SELECT file_name, CAST(10000 + o_custkey AS INT) AS permno, false AS valid,
               p_name AS event_co_name, upper(p_name) AS comnams, 'none' AS event_title
        FROM {call_rows} WHERE o_totalprice BETWEEN 200000 AND 225000""",
    "name_checks": """
        SELECT p_name AS event_co_name, CAST(10000 + p_partkey AS INT) AS permno,
               upper(p_name) AS comnams, p_partkey % 7 <> 0 AS valid
        FROM {part} WHERE p_size <= 17""",
    "link": """
        SELECT DISTINCT file_name,
               CASE WHEN o_totalprice >= 30000 THEN CAST(10000 + o_custkey AS INT) END AS permno,
               1 AS match_type, '1. Match' AS match_type_desc
        FROM {call_rows}""",
    "done_keys": """
        SELECT file_name, last_update FROM {call_rows} WHERE o_orderstatus = 'F'""",
    "dupe_keys": """
        SELECT file_name, last_update FROM {call_rows} WHERE o_orderpriority = '3-MEDIUM'""",
    "call_link": """
        SELECT DISTINCT file_name, CAST(10000 + o_custkey AS INT) AS permno,
               CAST(floor(o_custkey / 20) AS BIGINT) AS company_id,
               CAST(year(last_update) || '-12-31' AS DATE) AS fy_end
        FROM {call_rows}""",
    "companies": """
        SELECT s_suppkey AS company_id, s_name AS company_name FROM {supplier}""",
    # -- passages ------------------------------------------------------------------------------
    "speaker_data": f"""
        SELECT 'F' || conv_id AS file_name, o_orderdate AS last_update,
               {pick('conv_id + turn', PREFIXES)} || {pick('conv_id', FIRST_NAMES)} || ' ' ||
               {pick('conv_id * 7 + turn', LAST_NAMES)} AS speaker_name,
               'Employer ' || conv_id % 7 AS employer,
               CASE role WHEN 'user' THEN 'Analyst' WHEN 'assistant' THEN 'Chief Executive Officer'
                    ELSE 'Operator' END AS role,
               CAST(turn AS INT) AS speaker_number,
               CASE WHEN turn <= 1 THEN 'pres' ELSE 'qa' END AS context,
               1 AS section, text AS speaker_text, 'en' AS language
        FROM {{conversations}} JOIN {{orders}} ON o_orderkey = conv_id * 3
        UNION ALL
        SELECT 'F' || conv_id AS file_name, o_orderdate AS last_update,
               CASE role WHEN 'system' THEN 'Unidentified Participant'
                    WHEN 'user' THEN 'Operator' ELSE 'Mr Madonna' END AS speaker_name,
               'Exchange' AS employer, CASE WHEN turn > 2 THEN 'Host' END AS role,
               CAST(turn AS INT) AS speaker_number, 'end' AS context, 2 AS section,
               text AS speaker_text, 'en' AS language
        FROM {{conversations}} JOIN {{orders}} ON o_orderkey = conv_id * 3""",
    "speaker_data_alt": """
        SELECT c.file_path, s.speaker_name, s.employer, s.role, s.speaker_number, s.context,
               s.section, s.speaker_text, s.language
        FROM {speaker_data} AS s JOIN {calls} AS c
        ON s.file_name = c.file_name AND s.last_update = c.last_update
        UNION ALL
        SELECT c.file_path, s.speaker_name, s.employer, s.role, s.speaker_number, s.context,
               2 AS section, s.speaker_text, s.language
        FROM {speaker_data} AS s JOIN {calls} AS c
        ON s.file_name = c.file_name AND s.last_update = c.last_update
        WHERE s.role = 'Operator'""",
    # -- executives ----------------------------------------------------------------------------
    "firm_years": f"""
        SELECT CAST(p_partkey % 50 AS INT) AS equilar_id,
               lpad(CAST(p_partkey AS STRING), 8, '0') || 'X' AS cusip, {YEAR_END} AS fy_end
        FROM {{part}}""",
    "executives": f"""
        SELECT CAST(p_partkey AS INT) AS equilar_executive_id,
               CAST(p_partkey % 50 AS INT) AS equilar_id,
               {person('p_partkey')} AS executive, {YEAR_END} AS fy_end
        FROM {{part}}""",
    "executives_nd": f"""
        SELECT CAST(p_partkey AS INT) AS equilar_executive_id,
               CAST(p_partkey % 50 AS INT) AS equilar_id,
               {person('p_partkey')} AS executive, {YEAR_END} AS fy_end
        FROM {{part}} WHERE p_type = 'PROMO'
        UNION ALL
        SELECT CAST(1000000 + p_partkey AS INT) AS equilar_executive_id,
               CAST(p_partkey % 50 AS INT) AS equilar_id,
               {person('p_partkey + p_size')} AS executive, {YEAR_END} AS fy_end
        FROM {{part}} WHERE p_type <> 'LARGE'""",
    "exec_overrides": """
        SELECT DISTINCT file_name, speaker_name, 'Executive ' || speaker_number AS executive,
               CAST(length(speaker_name) % 50 AS BIGINT) AS equilar_id,
               CAST(length(speaker_name) % 50 + CASE WHEN speaker_number = 3 THEN 100
                    ELSE 10000000 * speaker_number END AS BIGINT) AS equilar_executive_id,
               'manual' AS match_type, length(speaker_name) % 9 <> 0 AS good_match,
               employer AS comments
        FROM {speaker_data} WHERE context = 'qa' AND speaker_number IN (3, 4, 5)""",
    "management": f"""
        SELECT CAST(p_partkey % 50 AS BIGINT) AS company_id,
               CAST(p_partkey AS BIGINT) AS management_id,
               CAST(CASE WHEN p_size > 5 THEN p_partkey + 500000 END AS BIGINT) AS executive_id,
               upper({pick('p_partkey', FIRST_NAMES)}) AS fname,
               upper({pick('p_partkey * 7 + p_size', LAST_NAMES)}) AS lname,
               p_type AS title, p_brand AS bio
        FROM {{part}}""",
    "id_sheet": """
        SELECT file_name, speaker_name, equilar_id AS company_id,
               equilar_executive_id AS management_id,
               CAST(CASE WHEN length(speaker_name) % 3 = 0 THEN 900000 + equilar_executive_id END AS BIGINT)
                   AS executive_id
        FROM {exec_overrides} WHERE executive = 'Executive 4'""",
    "exec_link": """
        SELECT CASE WHEN speaker_number <> 7 THEN CAST(length(speaker_name) % 50 AS BIGINT) END
                   AS company_id,
               CAST(500000 + length(speaker_name) % 50 + 50 * (speaker_number % 3) AS BIGINT)
                   AS executive_id,
               file_name, speaker_name
        FROM {speaker_data} WHERE role = 'Chief Executive Officer'
        UNION ALL
        SELECT CAST(length(speaker_name) % 50 AS BIGINT) AS company_id,
               CAST(500050 + length(speaker_name) % 50 AS BIGINT) AS executive_id,
               file_name, speaker_name
        FROM {speaker_data} WHERE role = 'Chief Executive Officer' AND context = 'pres'""",
    "name_pairs": """
        SELECT substr(p_name, 1, 3) AS fname_alt, p_name AS first_name, p_size > 25 AS valid
        FROM {part}""",
    # Sentences that hold what the shipped patterns look for, at the end of every text.
    "documents_default": f"""
        SELECT doc_id, text || '. ' || {pick('doc_id', PATTERN_SENTENCES)} || ' '
               || {pick('doc_id * 3 + 1', PATTERN_SENTENCES)} AS text
        FROM {{documents}}""",
    "documents_null": f"""
        SELECT doc_id, lang, CASE WHEN doc_id % 5 <> 0
               THEN text || ' ' || {pick('doc_id', PHRASES)} END AS text
        FROM {{documents}}""",
    # -- word lists ----------------------------------------------------------------------------
    "lexicon_phrases": """
        SELECT category, word FROM {lexicon}
        UNION ALL SELECT 'positive' AS category, 'well-known' AS word
        UNION ALL SELECT 'modal_weak' AS category, 'can''t' AS word
        UNION ALL SELECT 'negative' AS category, 'far below plan' AS word""",
    "lexicon": """
        SELECT CASE length(word) WHEN 3 THEN 'positive' WHEN 4 THEN 'negative'
                    WHEN 5 THEN 'uncertainty' WHEN 6 THEN 'litigious' WHEN 7 THEN 'modal_strong'
                    ELSE 'modal_weak' END AS category, word
        FROM {vocabulary} WHERE length(word) BETWEEN 3 AND 8 AND word = lower(word)
        UNION ALL
        SELECT 'uncertainty' AS category, word
        FROM {vocabulary} WHERE length(word) = 3 AND word LIKE 't%'""",
}

SPARK_ONLY = {
    "vocabulary": r"""
        SELECT DISTINCT word FROM (
            SELECT explode_outer(regexp_extract_all(text, r'[\p{{L}}\p{{N}}_]+', 0)) AS word
            FROM {documents})
        WHERE word IS NOT NULL""",
    "pronunciations": """
        WITH plain AS (SELECT DISTINCT lower(word) AS word FROM {vocabulary}),
        first AS (
            SELECT word, transform(regexp_extract_all(word, '.', 0),
                c -> CASE WHEN c IN ('a', 'e', 'i', 'o', 'u') THEN upper(c) || '1'
                          ELSE upper(c) END) AS phones
            FROM plain WHERE word RLIKE '^[a-z]+$')
        SELECT word, phones FROM first
        UNION ALL
        SELECT word, concat(phones, array('AH0')) AS phones FROM first WHERE word LIKE '%e'""",
}
DUCKDB_ONLY = {
    "vocabulary": r"""
        SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS word
        FROM {documents}""",
    "pronunciations": """
        WITH plain AS (SELECT DISTINCT lower(word) AS word FROM {vocabulary}),
        first AS (
            SELECT word, list_transform(string_split(word, ''),
                lambda c: CASE WHEN c IN ('a', 'e', 'i', 'o', 'u') THEN upper(c) || '1'
                               ELSE upper(c) END) AS phones
            FROM plain WHERE regexp_full_match(word, '[a-z]+'))
        SELECT word, phones FROM first
        UNION ALL
        SELECT word, list_append(phones, 'AH0') AS phones FROM first WHERE word LIKE '%e'""",
}


def _inputs(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(sql) if name})


class Tables:
    """The given tables of one folder and the views over them, by name. ``ready`` has views that were
    made before, by folder and name; it is empty unless a bench fills it."""

    ready: dict[tuple[str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            self._known[name] = self._load(name)
        return self._known[name]

    def _load(self, name: str) -> DataFrame:
        if (self.folder, name) in self.ready:
            return self.ready[self.folder, name]
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        sql = SPARK_ONLY[name] if name in SPARK_ONLY else VIEWS[name]
        view = self.spark.sql(sql, **{dep: self[dep] for dep in _inputs(sql)})
        return stage(view) if name == "vocabulary" else view


def with_views(sql: str) -> str:
    """The DuckDB query for ``sql``, whose inputs are in braces, with the views it needs."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _inputs(text):
            if name not in BASE and name not in ordered:
                visit(DUCKDB_ONLY.get(name) or VIEWS[name])
                ordered.append(name)

    def plain(text: str) -> str:
        return text.format(**{name: name for name in _inputs(text)})

    visit(sql)
    views = [f"{name} AS ({plain(DUCKDB_ONLY.get(name) or VIEWS[name])})" for name in ordered]
    body = plain(sql).strip()
    if body.upper().startswith("WITH "):
        views.append(re.sub(r"(?is)^with\s+", "", body, count=1))
        return "WITH " + ",\n".join(views)
    return ("WITH " + ",\n".join(views) + "\n" if views else "") + body
