"""Personal data: base patterns, and terms that disclose the entities they stand beside."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltext.llm.common import marked
from calltext.operators.staging import broadcast_if_small, stage

# The kinds in their order. Possessive loops and the look-behind give the matches of
# the plain patterns in linear time: none of them can give back a character and still match, and a
# match starts at the beginning of its run of characters or where the match before it ended.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# A term is a run of at least three letters outside the emails.
TERM_PATTERN = r"(?<!\p{L})\p{L}{3,}+"
# A term discloses an entity when their pointwise mutual information reaches this share of the
# entity's information content, and both stand together in this many different texts.
DISCLOSURE = 0.8
SUPPORT = 3
# Kinds of entities and tokens of their values are entities too. What stands with them so often by
# chance, over all pairs that were looked at, that this many are expected, is left out.
CHANCE = 0.01
EXACT, TOKEN, WHOLE_KIND = 0, 1, 2
BLOCK = 256


def _luhn(digits: Column) -> Column:
    """The Luhn check over up to 19 digits; zeros put in front change nothing."""
    padded = F.lpad(digits, 19, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = F.lit(0)
    for i in range(19):
        total = total + F.substring(doubled if i % 2 else padded, 19 - i, 1).cast("int")
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _with_sums(rows: DataFrame, n: Column) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``rows`` with matches ``_m`` and pieces ``_p`` between them plus what places are summed from
    (``_l``, ``_b``), and the length of all that lies before piece ``i``."""
    rows = rows.withColumn("_l", F.zip_with(
        F.slice("_p", F.lit(1), n), "_m", lambda p, m: (F.length(p) + F.length(m)).cast("long")))
    sums = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice("_l", b * BLOCK + 1, BLOCK), F.lit(0).cast("long"),
                              lambda a, x: a + x))
    rows = rows.withColumn("_b", F.when(n > 0, F.aggregate(
        sums, F.array(F.lit(0).cast("long")),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))))
    return rows, lambda i: F.get("_b", F.floor(i / BLOCK).cast("int")) + F.aggregate(
        F.slice("_l", F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK),
        F.lit(0).cast("long"), lambda a, x: a + x)


def _with_spans(rows: DataFrame, kind: str, pattern: str, sign: str | None) -> DataFrame:
    """``rows`` plus ``_<kind>``: an array of (kind, start, end, value) of the valid matches.

    Places are sums of the lengths of the matches and of what lies between them. They are summed by
    blocks of matches, so many matches in one text cost little more than as many in several.
    """
    hit = F.col("_text").contains(sign) if sign else F.lit(True)
    found = F.when(hit, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
    n = F.size("_m")
    rows = rows.withColumn("_m", found).withColumn("_p", F.when(n > 0, F.split("_text", pattern, -1)))
    rows, before = _with_sums(rows, n)
    rank = KINDS.index(kind)
    spans = F.filter(F.transform("_m", lambda m, i: F.when(_valid(kind, m), F.struct(
        F.lit(rank).alias("kind"), i.alias("i"), m.alias("value")))), lambda s: s.isNotNull())
    rows = rows.withColumn("_v", spans).withColumn("_v", F.transform("_v", lambda s: F.struct(
        s["kind"].alias("kind"), s["value"].alias("value"),
        (before(s["i"]) + F.length(F.get("_p", s["i"]))).alias("start"))))
    return rows.withColumn(f"_{kind}", F.when(n > 0, F.transform("_v", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"),
        (s["start"] + F.length(s["value"])).alias("end"), s["value"].alias("value")
    )))).drop("_m", "_p", "_l", "_b", "_v")


def base_spans(rows: DataFrame) -> DataFrame:
    """``rows`` with a text ``_text`` plus ``_spans``: the base matches of all kinds as (start, kind
    number, end, value) by start, then kind. Code points, end exclusive."""
    for kind, pattern, sign in zip(KINDS, (EMAIL, IP, CARD, PHONE), ("@", ".", None, "+")):
        rows = _with_spans(rows, kind, pattern, sign)
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")
    return rows.withColumn("_spans", F.array_sort(F.concat(*(
        F.coalesce(F.col(f"_{k}"), none) for k in KINDS)))).drop(*(f"_{k}" for k in KINDS))


def _without_emails(text: Column) -> Column:
    """A text of the same length with blanks for its emails, the only spans that hold letters."""
    blanks = F.zip_with(
        F.split(text, EMAIL, -1), F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0)),
        lambda p, m: F.concat(p, F.coalesce(F.repeat(F.lit(" "), F.length(m)), F.lit(""))))
    return F.when(text.contains("@"), F.array_join(blanks, "")).otherwise(text)


def _entities(spans: Column) -> Column:
    """Exact values, the tokens of three or more letters or digits in them, and their kinds."""
    names = F.array(*(F.lit(k) for k in KINDS))
    entity = lambda level, name: F.struct(
        F.lit(level).alias("level"), name.alias("name"))
    tokens = F.flatten(F.transform(spans, lambda s: F.transform(
        F.regexp_extract_all(F.lower(s["value"]), F.lit("[a-z0-9]{3,}"), F.lit(0)),
        lambda t: entity(TOKEN, F.concat_ws(" ", F.get(names, s["kind"]), t)))))
    return F.array_distinct(F.concat(
        F.transform(spans, lambda s: entity(EXACT, s["value"])), tokens,
        F.transform(spans, lambda s: entity(WHOLE_KIND, F.get(names, s["kind"])))))


def _terms(masked: Column) -> Column:
    return F.array_distinct(F.transform(
        F.regexp_extract_all(masked, F.lit(TERM_PATTERN), F.lit(0)), F.lower))


def _with_held(texts: DataFrame) -> DataFrame:
    """``texts`` plus ``_held``: the entities of each text that stand in ``SUPPORT`` different texts,
    each with its number of rows."""
    entities = stage(texts.select("n", F.explode("_entities").alias("entity")).groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count("*").alias("texts")).filter(
            F.col("texts") >= SUPPORT).drop("texts"))
    held = stage(texts.select("_hash", F.explode("_entities").alias("entity")).join(
        entities, "entity").groupBy("_hash").agg(
            F.collect_set(F.struct("entity", "n_entity")).alias("_held")))
    return texts.join(held, "_hash")


def _pairs(texts: DataFrame, *columns: str) -> DataFrame:
    """``(*columns, entity, n_entity, term)``: each entity held by a text with each of its terms."""
    return texts.select(
        *columns, F.explode("_held").alias("c"), _terms(F.col("_masked")).alias("_t")).select(
            *columns, "c.*", F.explode("_t").alias("term"))


def disclosures(held: DataFrame, texts: DataFrame) -> DataFrame:
    """``(entity, term, share)``: terms whose co-occurrence with an entity over the corpus reveals it.

    ``held`` has each different text that holds entities once, with its number ``n`` of rows;
    ``texts`` has all rows. Empty tables give no rows, and so do texts without terms; a text is split
    whole, in memory that follows it, whatever its length. Both stand together where a text holds both, however far apart. With
    counts of rows, PMI = log(n(t,e) N / (n(t) n(e))) and the information content of e is
    log(N / n(e)); their ratio is 1 for a term that occurs nowhere but in texts of e. Copies of one
    text count once for the support. Pairs are summed by each task first.

    Frequent entities, as kinds are, meet rare terms by chance. For kinds and tokens the number k of
    different texts must exceed what chance gives: with a mean of m = k / exp(PMI) it reaches k with a
    probability of at most exp(k - m - k PMI) (Chernoff), and that times the number of terms and
    entities with enough support is to stay within ``CHANCE``.
    """
    n = texts.count()
    pairs = _pairs(held, "n").groupBy("entity", "n_entity", "term").agg(
        F.sum("n").alias("both"), F.count("*").alias("support")).filter(F.col("support") >= SUPPORT)
    terms = stage(texts.select(F.explode(_terms(_without_emails(F.col("_text")))).alias(
        "term")).groupBy("term").agg(F.count("*").alias("n_term")).filter(F.col("n_term") >= SUPPORT))
    entities = held.select(F.explode("_held.entity").alias("entity")).filter(
        F.col("entity.level") > EXACT).distinct().count()
    looked_at = math.log(max(terms.count() * entities, 1) / CHANCE)
    pmi = F.log(F.col("both") * n / (F.col("n_term") * F.col("n_entity")))
    share = pmi / F.nullif(F.log(F.lit(float(n)) / F.col("n_entity")), F.lit(0.0))
    rare = F.col("support") * (pmi - 1 + F.exp(-pmi)) >= looked_at
    return pairs.join(terms, "term").select(
        "entity", "term", share.alias("share"), rare.alias("rare")).filter(
            (F.col("share") >= DISCLOSURE) & ((F.col("entity.level") == EXACT) | F.col("rare"))
    ).drop("rare")


def _term_spans(texts: DataFrame) -> DataFrame:
    """``(_hash, _terms)``: where the terms ``_marks`` (term to share) stand in the texts."""
    rows = texts.withColumn("_m", F.regexp_extract_all("_masked", F.lit(TERM_PATTERN), F.lit(0)))
    rows = rows.withColumn("_p", F.split("_masked", TERM_PATTERN, -1))
    rows, before = _with_sums(rows, F.size("_m"))
    found = F.filter(F.transform("_m", lambda m, i: F.struct(
        i.alias("i"), m.alias("m"), F.try_element_at("_marks", F.lower(m)).alias("share"))),
        lambda s: s["share"].isNotNull())
    rows = rows.withColumn("_f", F.transform(found, lambda s: F.struct(
        (before(s["i"]) + F.length(F.get("_p", s["i"]))).alias("start"), s["m"].alias("m"),
        s["share"].alias("share"))))
    return rows.select("_hash", F.transform("_f", lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"),
        (s["start"] + F.length(s["m"])).alias("end"), F.lower(s["m"]).alias("value"),
        s["share"].alias("share"))).alias("_terms"))


def sensitive_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_key, _hash, spans)`` for every row of ``docs``: base spans and disclosing terms as
    (start, kind, end, value, share), kind numbers being those of ``KINDS`` and then the term.

    A null text is empty and has no span. Equal rows get equal spans; spans of different kinds may
    overlap; an empty table gives no rows. A text of any length is read whole, in memory that follows
    it. A term is marked wherever it stands in a text of its
    entity, with its largest share there. Only texts with base spans travel, each different one once.
    """
    texts = docs.select(
        F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
        F.xxhash64(text).alias("_hash"))
    rows = stage(base_spans(texts).withColumn("_masked", F.when(
        F.size("_spans") > 0, _without_emails(F.col("_text")))).drop("_text"))
    own = stage(rows.filter("_masked IS NOT NULL").groupBy("_hash").agg(
        F.first("_masked").alias("_masked"), F.first(_entities(F.col("_spans"))).alias("_entities"),
        F.count("*").alias("n")))
    held = stage(_with_held(own).drop("_entities"))
    terms = broadcast_if_small(disclosures(held, texts.select("_text")))
    marks = _pairs(held, "_hash").join(terms, ["entity", "term"]).groupBy("_hash", "term").agg(
        F.max("share").alias("share")).groupBy("_hash").agg(F.map_from_entries(
            F.collect_list(F.struct("term", "share"))).alias("_marks"))
    # Staged, so that adaptive execution can split the rows of a frequent text.
    marked = stage(_term_spans(held.join(stage(marks), "_hash")))
    base = F.transform("r._spans", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        s["value"].alias("value"), F.lit(None).cast("double").alias("share")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string,share:double>>")
    return rows.alias("r").join(marked.alias("m"), F.expr("r._hash = m._hash"), "left").select(
        "r._key", "r._hash", F.array_sort(F.concat(base, F.coalesce("m._terms", none))).alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text"
              ) -> DataFrame:
    """``docs`` with its spans acted on: entities give way to their kind in angle brackets, terms
    that disclose one fully (share 1) are removed, other terms are generalised to ``<term>``. A
    span that begins inside an earlier one goes with it. A null text stays null; repeated rows are
    treated alike; an empty table gives no rows, and the columns stay as they were."""
    once = spans.dropDuplicates(["_key", "_hash"]).select(
        "_key", "_hash", F.col("spans").alias("__row_spans"))
    names = F.array(*(F.lit(f"<{k}>") for k in (*KINDS, TERM)))
    label = lambda s: F.when(F.coalesce(s["share"] >= 1, F.lit(False)), F.lit("")).otherwise(
        F.get(names, s["kind"]))
    piece = lambda at, n: F.substring(F.col(text), (at + 1).cast("int"), n.cast("int"))
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    built = F.aggregate("__row_spans", start, lambda a, s: F.when(s["start"] >= a["at"], F.struct(
        F.concat(a["done"], piece(a["at"], s["start"] - a["at"]), label(s)).alias("done"),
        s["end"].alias("at"))).otherwise(F.struct(
            a["done"].alias("done"), F.greatest(a["at"], s["end"]).alias("at"))),
        lambda a: F.concat(a["done"], piece(a["at"], F.length(text).cast("long"))))
    new = F.when(F.coalesce(F.size("__row_spans"), F.lit(0)) > 0, built).otherwise(F.col(text))
    joined = marked(docs, key, text).alias("d").join(
        once.alias("c"), F.expr("d.__row_key <=> c._key AND d.__row_hash = c._hash"), "left")
    return joined.select("d.*", "c.__row_spans").withColumn(text, new).drop(
        "__row_key", "__row_hash", "__row_spans")
