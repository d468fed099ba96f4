"""DuckDB SQL for the queries that SQL can express.

The others rest on a hash that DuckDB lacks (XXH64) or are no relational work (tiling, components,
Viterbi, model fits); tests compare them with brute force. CRC-32 is taken a byte at a time.
"""

from __future__ import annotations

WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SUPER_KMERS = rf"""
WITH worded AS (SELECT doc_id, {WORDS} AS words FROM documents),
windows AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 49], ' ') AS words FROM (
        SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS pos FROM worded)),
late AS (
    SELECT doc_id, pos FROM windows QUALIFY min(doc_id) OVER (PARTITION BY words) < doc_id),
gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS pos FROM late),
left_over AS (
    SELECT w.doc_id, w.pos, w.word FROM (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM worded) AS w
    ANTI JOIN gone AS g ON w.doc_id = g.doc_id AND w.pos = g.pos),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
    FROM left_over GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (doc_id)"""

# Sources sorted by cap over weight: the first ones stay at their caps, and the level of words per
# weight for the rest is right where the next source's cap lies above it.
CURRICULUM = rf"""
WITH sized AS (
    SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source),
filled AS (
    SELECT *, 3 * source_size AS most, 3 * source_size / weight AS ratio,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
           sum(3 * source_size) OVER w AS held, sum(weight) OVER w AS held_weights
    FROM sources WINDOW w AS (ORDER BY 3 * source_size / weight, source
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
    SELECT arg_min((total - coalesce(held, 0)) / (weights - coalesce(held_weights, 0)), ratio) AS level
    FROM filled
    WHERE ratio > (total - coalesce(held, 0)) / (weights - coalesce(held_weights, 0))),
targets AS (
    SELECT source, source_size, weight, CAST(least(most, weight * level) AS DOUBLE) AS target
    FROM filled, level),
lined AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
                              ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
    FROM sized),
planned AS (
    SELECT doc_id, size, source_size, target, l.source, middle, weight,
           CAST(CASE WHEN source_size = 0 THEN 0
                ELSE least(greatest(ceil((target - middle) / source_size), 0), 3) END AS INT) AS passes
    FROM lined AS l JOIN targets AS t ON l.source IS NOT DISTINCT FROM t.source),
-- The schedule of a source is that of its weight: even, rising, falling to the middle and then even.
takings AS (
    SELECT doc_id, pass, weight, (middle + pass * source_size) / target AS share
    FROM (SELECT *, unnest(range(passes)) AS pass FROM planned)),
spent AS (SELECT *, greatest(share * 0.9375::DOUBLE, 0) AS area FROM takings),
placed AS (
    SELECT doc_id, pass, CASE
        WHEN weight = 1 THEN least(2 * share / 2, 1)
        WHEN weight = 2 THEN least(2 * share / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * share)), 1)
        WHEN area <= 0.5625 THEN
            least(2 * area / (1.5::DOUBLE + sqrt(greatest(2.25::DOUBLE - 3 * area, 0))), 0.5::DOUBLE)
        ELSE least(0.5::DOUBLE + 2 * (area - 0.5625::DOUBLE) / 1.5::DOUBLE, 1) END AS position
    FROM spent),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY position, md5(CAST(doc_id AS VARCHAR)), doc_id, pass) - 1 AS rank
    FROM placed),
ends AS (
    SELECT doc_id, round(min(position), 9) AS first_position, round(max(position), 9) AS last_position,
           min(rank) AS first_rank FROM ranked GROUP BY doc_id)
SELECT doc_id, size, source_size, target, CAST(size * passes AS BIGINT) AS taken,
       first_position, last_position, first_rank
FROM planned LEFT JOIN ends USING (doc_id)"""


def _quartiles(name: str, *keys: str) -> str:
    group = ", ".join([*keys, "metric"])
    return f"""
{name} AS (
    SELECT {group}, min(bucket) FILTER (WHERE 4 * upto >= whole) AS low,
           min(bucket) FILTER (WHERE 4 * upto >= 3 * whole) AS high, max(whole) AS support
    FROM (SELECT {group}, bucket, sum(count(*)) OVER (PARTITION BY {group} ORDER BY bucket) AS upto,
                 sum(count(*)) OVER (PARTITION BY {group}) AS whole
          FROM sketch GROUP BY {group}, bucket)
    GROUP BY {group})"""


ADAPTIVE = rf"""
WITH worded AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
grams AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 4], ' ') AS gram FROM (
        SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS pos FROM worded)),
repeats AS (
    SELECT doc_id, count(DISTINCT pos) AS n FROM (
        SELECT doc_id, unnest(generate_series(pos, pos + 4)) AS pos FROM (
            SELECT doc_id, pos FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1))
    GROUP BY doc_id),
measured AS (
    SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           len(lines) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
    FROM worded LEFT JOIN repeats USING (doc_id)),
ruled AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           1000 * n_symbols // greatest(word_chars, 1) AS symbols,
           10 * word_chars // greatest(n_words, 1) AS word_length,
           1000 * n_dup_lines // greatest(n_lines, 1) AS repeated_lines
    FROM measured),
long AS (
    SELECT doc_id, lang, source, base_failed, unnest([
        {{'metric': 'symbols', 'value': symbols, 'room': 20}},
        {{'metric': 'word_length', 'value': word_length, 'room': 20}},
        {{'metric': 'repeated_lines', 'value': repeated_lines, 'room': 350}}], recursive := true)
    FROM ruled),
sketch AS (
    SELECT *, value - value % CAST(2 ** greatest(length(bin(value)) - 6, 0) AS BIGINT) AS bucket
    FROM long WHERE NOT base_failed),
{_quartiles('own', 'lang', 'source')},
{_quartiles('of_lang', 'lang')},
{_quartiles('of_all')},
fences AS (
    SELECT o.lang, o.source, o.metric,
           CASE WHEN o.support >= 100 THEN [o.low, o.high] WHEN l.support >= 100 THEN [l.low, l.high]
                ELSE [a.low, a.high] END AS q
    FROM own AS o JOIN of_lang AS l ON o.lang IS NOT DISTINCT FROM l.lang AND o.metric = l.metric
    JOIN of_all AS a ON o.metric = a.metric),
judged AS (
    SELECT doc_id, bool_and(value BETWEEN q[1] - 6 * (q[2] - q[1]) - room
                                  AND q[2] + 6 * (q[2] - q[1]) + room) AS within
    FROM long AS l JOIN fences AS f ON l.lang IS NOT DISTINCT FROM f.lang
    AND l.source IS NOT DISTINCT FROM f.source AND l.metric = f.metric
    GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(within, true) AS kept
FROM ruled LEFT JOIN judged USING (doc_id)"""

# Unsigned CRC-32 of the UTF-8 bytes of a text, given as a table of texts ``(t)``: ``crc (t, crc)``.
CRC = """
step AS (
    SELECT list(list_reduce([b::BIGINT] || range(8)::BIGINT[],
                            lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS entries
    FROM range(256) AS r(b)),
crc AS (
    SELECT t, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
               range(1, octet_length(encode(t)) + 1),
               lambda i: CAST('0x' || substr(hex(encode(t)), 2 * i - 1, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, entries[1 + (xor(c, b) & 255)]))) AS crc
    FROM texts CROSS JOIN step)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(count: str) -> str:
    fields = ("doc_id", "source", "lang", count, "text")
    return f"sha256(concat({', '.join(_field(f) for f in fields)}))"


def _tree(name: str, leaves: str) -> str:
    """Nodes ``name (grp, depth, place, node, n)`` over ``leaves (grp, place, node, n)``, ``n`` being
    how many nodes stand on a level."""
    return f"""
{name} AS (
    SELECT grp, 0 AS depth, place, node, n FROM {leaves}
    UNION ALL
    SELECT grp, max(depth) + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)),
           (max(n) + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY grp, place // 2)"""


def _walk(name: str, start: str, tree: str) -> str:
    """Rows of ``start (doc_id, grp, place, node, proof, ...)`` carried up ``tree`` to its root."""
    return f"""
{name}_steps AS (
    SELECT doc_id, leaf, grp, 0 AS depth, place, node, proof FROM {start}
    UNION ALL
    SELECT doc_id, leaf, w.grp, w.depth + 1, w.place // 2,
           sha256(CASE WHEN t.node IS NULL THEN w.node WHEN w.place % 2 = 1 THEN t.node || w.node
                       ELSE w.node || t.node END),
           proof || coalesce(t.node, '')
    FROM {name}_steps AS w JOIN {tree}_heights AS h ON w.grp = h.grp AND w.depth < h.height
    LEFT JOIN {tree} AS t ON t.grp = w.grp AND t.depth = w.depth AND t.place = xor(w.place, 1)),
{name} AS (
    SELECT w.* FROM {name}_steps AS w JOIN {tree}_heights AS h ON w.grp = h.grp AND depth = height)"""


MERKLE = f"""
WITH RECURSIVE texts AS (SELECT DISTINCT doc_id::VARCHAR AS t FROM documents),
{CRC},
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id, leaf) - 1 AS place, leaf AS node,
           count(*) OVER (PARTITION BY grp) AS n
    FROM (
        SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
               {_leaf('n_chars')} AS leaf,
               CASE WHEN crc % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS now
        FROM documents JOIN crc ON t = doc_id::VARCHAR)),
{_tree('langs', 'leaves')},
langs_heights AS (SELECT grp, max(depth) AS height FROM langs GROUP BY grp),
subroots AS (SELECT 0 AS grp, grp AS place, node, count(*) OVER () AS n FROM langs WHERE n = 1),
{_tree('top', 'subroots')},
top_heights AS (SELECT grp, max(depth) AS height FROM top GROUP BY grp),
starts AS (SELECT doc_id, leaf, grp, place, now AS node, '' AS proof FROM leaves),
{_walk('inside', 'starts', 'langs')},
crossing AS (SELECT doc_id, leaf, 0 AS grp, grp AS place, node, proof FROM inside),
{_walk('outside', 'crossing', 'top')}
SELECT o.doc_id, o.leaf, s.node AS subroot, r.node AS root, sha256(o.proof) AS proof_sha256,
       o.node AS folded_root, o.node = r.node AS verified
FROM outside AS o JOIN inside AS i USING (doc_id, leaf) JOIN subroots AS s ON i.grp = s.place
CROSS JOIN (SELECT node FROM top WHERE n = 1) AS r"""

VARIANTS = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents),
counted AS (
    SELECT doc_id || ':' || run AS t, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
texts AS (SELECT t FROM counted),
{CRC},
slipped AS (
    SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run))
                     || substr(run, crc % length(run) + 2) ELSE run END AS word, n AS times
    FROM counted JOIN crc USING (t)),
words AS (
    SELECT word, sum(times)::BIGINT AS n FROM slipped WHERE length(word) >= 7
    GROUP BY word HAVING sum(times) >= 2),
shorter AS (
    SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
indels AS (
    SELECT DISTINCT w.word, w.n, s.word AS other, s.n AS other_n
    FROM words AS w JOIN shorter AS s ON w.word = s.rest),
near AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n
    FROM shorter AS a JOIN shorter AS b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT * FROM indels
    UNION ALL SELECT other, other_n, word, n FROM indels),
best AS (
    SELECT word, n, count(*) AS n_near, max(other_n) AS most,
           first(other ORDER BY other_n DESC, other) AS other
    FROM near GROUP BY word, n),
forms AS (SELECT word, other AS form, most AS form_n FROM best WHERE most >= 10 * n),
chain AS (
    SELECT word, form AS last_form, 1 AS step FROM forms
    UNION ALL SELECT c.word, f.form, step + 1 FROM chain AS c JOIN forms AS f ON c.last_form = f.word)
SELECT w.word, form, coalesce(root, w.word) AS root, w.n, coalesce(n_near, 0) AS n_near, form_n
FROM words AS w LEFT JOIN best AS b ON b.word = w.word LEFT JOIN forms AS f ON f.word = w.word
LEFT JOIN (SELECT word, last(last_form ORDER BY step) AS root FROM chain GROUP BY word) AS r
    ON r.word = w.word"""

ORACLES = {
    "op3_super_kmer_dedup": SUPER_KMERS,
    "op5_curriculum_mix": CURRICULUM,
    "op8_adaptive_quality": ADAPTIVE,
    "op11_merkle_versions": MERKLE,
    "op13_bit_sliced_variants": VARIANTS,
}
