"""The operators against plain Python over the smallest tables, and on planted cases."""

import collections
import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from calltext.llm import (
    classifier, decontamination, lines, mixing, privacy, queries, sharding, simhash, substrings, urls,
)

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(
        f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}


# -- op1 -------------------------------------------------------------------------------------------

def best_split(token, counts, total):
    """All splits, by cost."""
    def cost(word):
        if counts.get(word):
            return np.log(counts[word] / total)
        return np.log(10 / total) - len(word) * np.log(10)

    found = []
    for cuts in itertools.product((0, 1), repeat=len(token) - 1):
        words, at = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                words.append(token[at:i])
                at = i
        words.append(token[at:])
        found.append((sum(map(cost, words)), words))
    return max(found)[0]


def test_viterbi_finds_the_best_split():
    counts = {"news": 50, "paper": 40, "newspaper": 5, "new": 30, "spa": 20, "per": 10, "s": 3}
    total = sum(counts.values())
    for token in ("newspaper", "newspapers", "xnewsy", "paperspa"):
        known = {(i, n): counts[token[i:i + n]] for i in range(len(token)) for n in range(1, 12)
                 if token[i:i + n] in counts and i + n <= len(token)}
        words = urls.segment(token, known, total)
        assert "".join(words) == token
        cost = sum(np.log(counts[w] / total) if w in counts else
                   np.log(10 / total) - len(w) * np.log(10) for w in words)
        assert abs(cost - best_split(token, counts, total)) < 1e-9


def test_rules(spark):
    pages = spark.createDataFrame([
        (1, "http://www.Example.org/es/1", ""), (2, "http://example.org/en/17?x", ""),
        (3, "https://example.org/en/2", ""), (4, "ftp://a.com/de/", ""), (5, "http://a.com/fr/9#x", ""),
        (6, "http://myexample.org/es/", ""), (7, "http://org", ""), (8, "x://y.net/://z.com/de/", "")],
        "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in urls.judged(pages).collect()}
    assert got[1] == ("www.example.org", "example.org/es/", "block")
    assert got[2][1:] == ("example.org/en/1", "block") and got[3][1:] == ("org/", "allow")
    assert got[4][1:] == ("com/de/", "block") and got[5][1:] == ("com/fr/", "allow")
    assert got[6][1:] == ("org/", "allow") and got[7][:2] == ("org", None)
    assert got[8][:2] == ("y.net", None)


def test_bayes_learns_words_of_hosts(spark):
    rows = [(i, f"http://{'cheappills' if i % 2 else 'goodnews'}{i % 5}.com/{'de' if i % 2 else 'fr'}/x",
             "<b>cheap pills good news</b> " * 5) for i in range(40)]
    rows += [(100, "http://cheappills.net/en/x", ""), (101, "http://goodnews.net/en/x", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["verdict"] for r in urls.judged(pages).collect()}
    assert (got[100], got[101]) == ("block", "allow")


def plain_scores(pages):
    """Rules, words, splits and naive Bayes over a whole table, one page after another."""
    counts = collections.Counter(
        w for _, _, html in pages for w in re.split(
            r"[^\w]|[\d_]", re.sub("<[^<>]*>", " ", html or "").lower())
        if w and w.isalpha() and len(w) <= urls.LONGEST_WORD)
    total, split = sum(counts.values()), {}

    def parts(side, text):
        for run in re.findall(r"[0-9]+|[^\W\d_]+", text.translate(LOW)):
            if run[0].isdigit():
                yield f"{side}:#{len(run)}"
                continue
            if run not in split:
                known = {(i, n): counts[run[i:i + n]] for i in range(len(run))
                         for n in range(1, len(run) - i + 1) if run[i:i + n] in counts}
                split[run] = urls.segment(run, known, total)
            yield from (f"{side}:{w}" for w in split[run])

    judged, seen = {}, {"allow": collections.Counter(), "block": collections.Counter()}
    totals = collections.Counter()
    for page, url, _ in pages:
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].translate(LOW), found[2]) if found else ("", "")
        fit = [(len(r), r, v) for v, r in urls.RULES if
               (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
               and path.startswith("/" + r.split("/", 1)[1])]
        words = [*parts("host", host), *parts("path", path)]
        judged[page] = (host, path, *(max(fit)[1:] if fit else (None, None)), words)
        if fit:
            totals[max(fit)[2]] += 1
            seen[max(fit)[2]].update(words)
    names = {w for c in seen.values() for w in c}
    size, many = len(names), {v: sum(c.values()) for v, c in seen.items()}
    out = {}
    for page, (host, path, rule, verdict, words) in judged.items():
        score = math.log((totals["block"] + 1) / (totals["allow"] + 1)) + sum(
            math.log((seen["block"][w] + 1) / (many["block"] + size + 1))
            - math.log((seen["allow"][w] + 1) / (many["allow"] + size + 1)) for w in words)
        out[page] = (host, path, rule, verdict or ("block" if round(score, 9) > 0 else "allow"),
                     None if rule else round(score, 6))
    return out


def test_urls_of_a_whole_table(spark):
    table = spark.read.parquet(f"{FOLDER}/pages.parquet")
    pages = [(r["page_id"], r["url"], r["html"]) for r in table.collect()]
    pages += [(-1, "http://straßenbahn-über.example.net/größe/ñandú", "<p>straßenbahn über größe ñandú</p>")]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"],
                          r["block_score"] if r["block_score"] is None else round(r["block_score"], 6))
           for r in urls.judged(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    want = plain_scores(pages)
    assert {k: v[:4] for k, v in got.items()} == {k: v[:4] for k, v in want.items()}
    for page, row in want.items():
        assert row[4] is None and got[page][4] is None or abs(row[4] - got[page][4]) < 1e-5


# -- op2 and op3 -----------------------------------------------------------------------------------
def signed(n):
    return n - 2**64 if n >= 2**63 else n


def cuts_of(parts, law):
    """Chunks (from, to) of lines: one ends where the hash of its line says so, and at the end."""
    seed, out, start = xxhash.xxh64(struct.pack("<i", law), seed=42).intdigest(), [], 0
    for i, line in enumerate(parts):
        own = signed(xxhash.xxh64(line.encode(), seed=42).intdigest())
        if signed(xxhash.xxh64(struct.pack("<q", own), seed=seed).intdigest()) % 4 or i == len(parts) - 1:
            out.append((start, i + 1))
            start = i + 1
    return out


def grown_runs(rows):
    """Lines to remove of each document: chunks, their first copies, and equal lines around both."""
    parts = {d: t.split("\n") for d, t in rows}
    first = {}
    chunks = {d: sorted({c for law in range(2) for c in cuts_of(p, law)}) for d, p in parts.items()}
    for d in sorted(parts):
        for start, end in chunks[d]:
            first.setdefault(tuple(parts[d][start:end]), (d, start))
    gone = {d: set() for d in parts}
    for d, p in parts.items():
        before = {}
        for start, end in chunks[d]:
            name = tuple(p[start:end])
            other, at = (d, before[name]) if name in before else first[name]
            before[name] = start
            if (other, at) == (d, start):
                continue
            q, shift, low, high = parts[other], at - start, start, start
            while low > 0 and low - 1 + shift >= 0 and p[low - 1] == q[low - 1 + shift]:
                low -= 1
            while high < len(p) and high + shift < len(q) and p[high] == q[high + shift]:
                high += 1
            if other == d and shift == -1:
                low += 1  # one line again and again stays twice
            if high - low >= 2:
                gone[d] |= set(range(low, high))
    return {d: (len(gone[d]), "\n".join(x for i, x in enumerate(p) if i not in gone[d]))
            for d, p in parts.items()}


ODD_LINES = [(1, "p\nx\ny\nq"), (2, "a\nx\ny\nb"), (3, "x\ny\nq"), (4, "s\ns\ns\ns\ns"), (5, "x\nz\ny"),
             (6, "v\nw\nv\nw\nu"), (7, ""), (8, "p"), (9, "\n\n\n"), (10, "x\n\ny\n\nx\n\ny")]


def test_line_chunks(spark, docs):
    rows = [*((d - 10**6, t) for d, t in ODD_LINES), *docs]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(lines.without_repeated_chunks(df), "n_removed", "kept")
    assert got == grown_runs(rows) and sum(n for n, _ in got.values()) > 100


def test_chunks_find_most_repeated_runs(spark):
    """Beside all windows of two lines that an earlier text holds, or the text itself before."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect())
    least, gone = {}, 0
    for doc, text in rows:
        pairs, own, mine = list(itertools.pairwise(text.split("\n"))), {}, set()
        for i, pair in enumerate(pairs):
            if least.setdefault(pair, doc) < doc or own.setdefault(pair, i) <= i - 2:
                mine |= {i, i + 1}
        gone += len(mine)
    got = lines.without_repeated_chunks(table).agg(F.sum("n_removed")).first()[0]
    assert 0.95 < got / gone <= 1


def test_cuts_do_not_shift(spark):
    """Lines put in before a passage leave it recognisable, in whatever it is cut."""
    passage = "\n".join(f"line {i} of the passage" for i in range(40))
    df = spark.createDataFrame(
        [(1, passage), (2, "new start\nmore\n" + passage), (3, "x\n" + passage[:-5] + "\nend"),
         (None, passage)], "doc_id long, text string")
    got = by_id(lines.without_repeated_chunks(df), "n_removed", "kept")
    assert got[1] == (0, passage) and got[2] == (40, "new start\nmore")
    assert got[3][0] == 39 and got[None] == (40, "")


def test_a_text_of_one_line(spark):
    df = spark.createDataFrame([(1, "same\n" * 5000 + "end"), (2, "a\nb\n" * 900), (3, "same\nsame\nend")],
                               "doc_id long, text string")
    got = by_id(lines.without_repeated_chunks(df), "n_removed", "kept")
    assert got == {1: (4998, "same\nsame\nend"), 2: (1798, "a\nb\n"), 3: (3, "")}


def test_many_copies_of_one_line(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("same\n"), F.col("id"), F.lit("\nsame\n\nother "), F.col("id") % 3).alias("text"))
    got = lines.without_repeated_chunks(df).groupBy("n_removed").count().collect()
    assert {r["n_removed"]: r["count"] for r in got} == {0: 1, 2: 2, 3: 2997}


def test_runs_travel_as_digests(spark):
    """Overlapping runs of a long text are no rows of their bytes, and its copies no further rows."""
    text = "\n".join(["long line " * 500] * 9)
    rows = spark.createDataFrame([(1, 5, text)] * 2, "_key long, _hash long, _text string")
    spans = spark.createDataFrame([(1, 5, i, 9) for i in range(8)], "_key long, _hash long, from int, to int")
    got = {r["from"]: bytes(r["bytes"]) for r in lines._texts_of(spans, rows).collect()}
    assert lines._texts_of(spans, rows).count() == 8
    assert got == {i: hashlib.sha256("\n".join(text.split("\n")[i:]).encode()).digest() for i in range(8)}


@pytest.mark.parametrize("hot", [40_000, 2])
def test_super_kmers(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_COUNT", hot)
    first, want = {}, {}
    for doc, text in docs:
        words = text.encode().split()
        gone = bytearray(len(words))
        for i in range(len(words) - 49):
            if first.setdefault(tuple(words[i:i + 50]), doc) < doc:
                gone[i:i + 50] = b"\1" * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        want[doc] = (len(words), sum(gone), kept)
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = by_id(substrings.without_repeats(table), "n_words", "n_removed", "kept")
    assert got == want and any(n for _, n, _ in want.values())


def test_window_names_are_exact():
    draw = random.Random(5)
    ids = np.array([draw.randrange(3) for _ in range(400)])
    for size in (1, 2, 3, 7, 50):
        names = substrings.window_names(ids, size)
        windows = [tuple(ids[i:i + size]) for i in range(len(ids) - size + 1)]
        assert len(names) == len(windows)
        assert len(set(zip(names.tolist(), windows))) == len(set(windows)) == len(set(names.tolist()))


# -- op4 -------------------------------------------------------------------------------------------

def greedy_tiles(item, doc, least):
    """The longest unmarked common run, again and again."""
    a, b, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for p in range(len(item)):
            for q in range(len(doc)):
                n = 0
                while (p + n < len(item) and q + n < len(doc) and item[p + n] == doc[q + n]
                       and not a[p + n] and not b[q + n]):
                    n += 1
                if n >= least and (best is None or n > best[2]):
                    best = p, q, n
        if best is None:
            return sum(t[2] for t in tiles)
        tiles.append(best)
        for i in range(best[2]):
            a[best[0] + i] = b[best[1] + i] = True


def test_tiles_are_greedy():
    draw = random.Random(3)
    for _ in range(60):
        item = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(3, 14))]
        doc = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(3, 25))]
        seeds = [(p, q) for p in range(len(item) - 2) for q in range(len(doc) - 2)
                 if item[p:p + 3] == doc[q:q + 3]]
        got = decontamination.tile(item, doc, seeds, 3)
        for p, q, n in got:
            assert item[p:p + n] == doc[q:q + n] and n >= 3
        assert len({i for p, _, n in got for i in range(p, p + n)}) == sum(t[2] for t in got)
        assert sum(t[2] for t in got) == greedy_tiles(item, doc, 3)


@pytest.mark.parametrize("block", [500_000, 30])
def test_reordered_passages(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
    item = [f"w{i}" for i in range(30)]
    other = [f"v{i}" for i in range(30)]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(other))], "item_id long, text string")
    df = spark.createDataFrame([
        (1, "start " + " ".join(item[15:] + ["between"] + item[:15])), (2, " ".join(item[:10])),
        (3, " ".join(item).upper() + " x " + " ".join(other)), (4, " ".join(reversed(item)))],
        "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["covered"] for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(1, 7): 30, (3, 7): 30, (3, 8): 30}


# -- op5 and op10 ----------------------------------------------------------------------------------

def test_positions_follow_the_schedules(spark):
    rows = [(i, "a b c", f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.curriculum(df).select("_key", "passes", "positions", "target", "source_size").collect()
    places = {k: [] for k in range(3)}
    for r in plan:
        assert len(r["positions"]) == r["passes"] <= 3
        places[r["_key"] % 3] += r["positions"]
    targets = {r["_key"] % 3: r["target"] for r in plan}
    assert [round(targets[k]) for k in range(3)] == [1500, 3000, 4500]
    for k, wanted in ((0, 0.5), (1, 0.5 + 0.5 / 6), (2, None)):
        assert 0 <= min(places[k]) and max(places[k]) <= 1
        assert abs(3 * len(places[k]) - targets[k]) <= 3
        if wanted:
            assert abs(np.mean(places[k]) - wanted) < 0.01
    # Falling weight: the first half of training takes (1.5 + 0.75) / 2 / 1.875 of the demand... / 2.
    assert abs(np.mean(np.array(places[2]) < 0.5) - 0.5625 / 0.9375) < 0.02
    order = mixing.in_training_order(df, mixing.curriculum(df))
    assert order.columns == df.columns
    placed = sorted((p, r["_key"]) for r in plan for p in r["positions"])
    met = [r["doc_id"] for r in order.collect()]
    assert len(met) == len(placed)
    # Ties in position may stand either way round.
    at = {}
    for i, (p, k) in enumerate(placed):
        at.setdefault(p, []).append((i, k))
    for same in at.values():
        assert sorted(met[i] for i, _ in same) == sorted(k for _, k in same)
    ranks = {r["_key"]: (r["first_position"], r["first_rank"])
             for r in mixing.in_place(mixing.curriculum(df)).collect()}
    for r in plan:
        first = r["positions"][0] if r["positions"] else None
        assert ranks[r["_key"]][0] == first
        if first is not None:
            assert placed[ranks[r["_key"]][1]][0] == first


def test_many_equal_rows_take_their_own_places(spark):
    rows = [(1, "a b", "s", "x")] * 50 + [(1, "a b", "s", "y")] * 3 + [(None, "c d", None, None)] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `a b` string")
    plan = mixing.curriculum(df)
    taken = plan.agg(F.sum("passes")).first()[0]
    order = mixing.in_training_order(df, plan)
    assert plan.count() == 57 and order.count() == taken
    assert {r["a b"] for r in order.collect()} <= {"x", "y", None}


def least_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, left = (low + high) // 2, 1, 0
        for s in sizes:
            if left + s > middle:
                used, left = used + 1, 0
            left += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("group", [1, 3, 4096])
def test_minimax_shards(spark, docs, monkeypatch, group):
    monkeypatch.setattr(sharding, "GROUPS_PER_BLOCK", group)
    got = sharding.shard_by_bytes(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    size = {d: len(t.encode()) + 1 for d, t in docs}
    digest = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in docs}
    groups = {}
    for d in size:
        groups[digest[d]] = groups.get(digest[d], 0) + size[d]
    per, of = {}, {}
    for r in got:
        d = r["doc_id"]
        assert r["size"] == size[d] and r["law"] == "bytes" and r["grown_shard"] is None
        assert r["text_crc32"] == zlib.crc32(dict(docs)[d].encode())
        per[r["shard"]] = per.get(r["shard"], 0) + r["size"]
        assert of.setdefault(digest[d], r["shard"]) == r["shard"]
    assert sorted(of.items()) == sorted(of.items(), key=lambda x: (x[1], x[0]))
    assert max(per.values()) <= least_capacity([groups[k] for k in sorted(groups)], 8)
    for shard in per:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_one_huge_group_leaves_no_shard_empty(spark):
    rows = [(i, "same text " * 30) for i in range(300)] + [(1000 + i, f"text {i} " * 20) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_bytes(df).groupBy("shard").sum("size").collect()
    sizes = sorted(r[1] for r in got)
    assert len(sizes) == 8 and sizes[0] > 0.4 * sizes[-2]


# -- op6 -------------------------------------------------------------------------------------------

@pytest.mark.parametrize("most, bucket", [(16_384, 512), (16, 32)])
def test_simhash(spark, docs, monkeypatch, most, bucket):
    monkeypatch.setattr(simhash, "MOST_IN_TASK", most)
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = []
    for _, text in docs:
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
            [b" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2 and root(i) != root(j):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    want = {d: (f"{p:016x}", docs[root(i)][0]) for i, ((d, _), p) in enumerate(zip(docs, prints))}
    got = by_id(queries.op6_simhash_planes(spark, FOLDER), "fingerprint", "component_id")
    assert got == want


def test_near_counts_distances():
    draw = np.random.default_rng(1)
    for bits, radius in ((64, 2), (128, 20)):
        base = draw.integers(0, 2, (150, bits), dtype=np.uint8)
        base[75:] = base[:75] ^ (draw.random((75, bits)) < radius / bits / 1.5)
        prints = [np.packbits(x).tobytes() for x in base]
        masks = np.where(base == 1, simhash.ALL, np.uint64(0))
        query, block, lanes = simhash.near(
            simhash._planes(prints), masks, simhash._limits(bits, radius, None))
        hit = np.unpackbits(lanes[:, None].view(np.uint8), axis=1, bitorder="little")
        row, lane = np.nonzero(hit)
        got = {(int(query[r]), int(block[r] * 64 + x)) for r, x in zip(row, lane)}
        distance = (base[:, None] != base[None]).sum(axis=2)
        want = {(int(i), int(j)) for i, j in zip(*np.nonzero(distance <= radius))}
        assert {p for p in got if p[1] < 150} == want


def test_one_of_each_keeps_the_least_of_each_component(spark, docs):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = {}
    for r in simhash.near_components(table).collect():
        first.setdefault(r["component"], []).append(r["doc_id"])
    left = sorted(r["doc_id"] for r in simhash.one_of_each(table).collect())
    assert left == sorted(min(ids) for ids in first.values()) and len(left) < len(docs)


# -- op7 -------------------------------------------------------------------------------------------

# The patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


ODD = [
    "a@b.c@d.e.f a@b.c%d@e.f @x.y a@b a@b. .@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.1 1.2.3",
    "ä 4111 1111 1111 1111 😀 4111-1111-1111-1112 49927398716 0000000000000000 1 2",
    "+1 (555) 010-9999 +12 +1.2.3.4.5.6.7.8.9.0 ++49 30 1234567 +1 2 3 " + "()" * 50,
    "9" * 5000 + " " + "a." * 3000 + "@b" + ".c" * 3000, "+1" + " " * 5000 + "1@2.3",
]


def test_base_spans(spark, docs):
    rows = [*docs, *((10_000 + i, t) for i, t in enumerate(ODD))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_key"]: [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 4]
           for r in privacy.sensitive_spans(df).collect()}
    for doc, text in rows:
        want = sorted((m.start(), i, m.end()) for i, (k, p) in enumerate(PATTERNS.items())
                      for m in re.finditer(p, text) if holds(k, m.group()))
        assert got[doc] == want


def test_terms_that_disclose_an_entity(spark):
    rows = [(i, f"report {i} by the aardvark clerk at boss@firm.com about the weather {i}") for i in range(6)]
    rows += [(100 + i, f"plain words about the weather and the clerk, number {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = privacy.sensitive_spans(df)
    got = {r["_key"]: {s["value"] for s in r["spans"] if s["kind"] == 4} for r in spans.collect()}
    # The word each text begins with stands nowhere else either.
    assert all(got[i] == {"aardvark", "report"} for i in range(6))
    assert not any(got[100 + i] for i in range(60))
    texts = dict(by_id(privacy.sanitised(df, spans), "text"))
    assert texts[0] == (" 0 by the  clerk at <email> about the weather 0",)
    assert texts[100] == (rows[6][1],)


def test_terms_far_from_their_entity(spark):
    """Over more than the 48 code points once looked at, before and behind, at the end of the text."""
    far = "some plain words of no account " * 5
    rows = [(i, f"Aardvark {i}, aardvark {far}boss@firm.com {far}Aardvark {i} zebra") for i in range(6)]
    rows += [(100 + i, f"{far} and more of it, number {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_key"]: [(s["start"], s["end"]) for s in r["spans"] if s["kind"] == 4]
           for r in privacy.sensitive_spans(df).collect()}
    for i in range(6):
        want = [m.span() for m in re.finditer("(?i)(?<![a-z])(aardvark|zebra)", rows[i][1])]
        assert got[i] == want and len(want) == 4
    assert not any(got[100 + i] for i in range(60))


def test_terms_that_disclose_a_kind_or_a_token(spark):
    """Every value stands in one text only; what stands with a kind three times may do so by chance."""
    rows = [(i, f"the aardvark {i} at u{i}@firm{i}.com " + ("odd" if i < 3 else "")) for i in range(12)]
    rows += [(50 + i, f"the zebra {i} at v{i}@stripes.org") for i in range(12)]
    rows += [(100 + i, f"the plain words, number {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_key"]: {s["value"] for s in r["spans"] if s["kind"] == 4}
           for r in privacy.sensitive_spans(df).collect()}
    assert all(got[i] == {"aardvark"} and got[50 + i] == {"zebra"} for i in range(12))
    assert not any(got[100 + i] for i in range(400))


# -- op9 and the pipeline --------------------------------------------------------------------------

def test_one_row_of_a_key_takes_part(spark, monkeypatch):
    rows = [(i % 20 if i < 400 else i, f"text {i} of words", "en", "web") for i in range(440)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(classifier, "co_train", lambda views, y, total: seen.append(
        (len(views[0]), len(y), total(lambda v: np.array([len(v[0])])).tolist())))
    assert classifier.scored(df, labels).count() == 440
    assert seen == [(10, 10, [440.0])]


def _views_of(rows):
    texts = [(r["text"] or "").encode() for r in rows]
    return (classifier.text_view(texts), classifier.metadata_view(
        [r["lang"] for r in rows], [r["source"] for r in rows], texts))


def test_sums_over_tasks_give_the_model_of_one_array(spark):
    """All sums in one array on one machine, and class by class with plain loops, give the same scores."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    views = _views_of(rows)
    mine = sorted((i for i, r in enumerate(rows) if r["doc_id"] in labels),
                  key=lambda i: str(rows[i]["doc_id"]))
    y = np.array([float(labels[rows[i]["doc_id"]]) for i in mine])
    model = classifier.co_train([v[mine] for v in views], y, lambda f: f(views))
    wanted = model.scores(*views)
    got = {r["doc_id"]: (r["text_score"], r["metadata_score"], r["score"]) for r in classifier.scored(
        spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(5),
        spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        assert np.allclose(got[r["doc_id"]], [w[i] for w in wanted], atol=1e-5)


def test_step_beside_plain_sums():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(60, 3)), rng.integers(-1, 2, 60)
    model = classifier.Linear(np.zeros(3), np.ones(3), rng.normal(size=4) / 3)
    g, h = np.zeros(4), np.zeros((4, 4))
    for value in (0, 1):
        some = [np.append(row, 1) for row, label in zip(x, y) if label == value]
        for z in some:
            p = 1 / (1 + np.exp(-z @ model.weights))
            g += 0.5 / len(some) * (p - value) * z
            h += 0.5 / len(some) * p * (1 - p) * np.outer(z, z)
    penalty = np.array([classifier.PENALTY] * 3 + [1e-6])
    wanted = model.weights - np.linalg.solve(h + np.diag(penalty), g + penalty * model.weights)
    got = classifier.stepped(model, [classifier.class_sums(model, x, y)])
    assert np.allclose(got.weights, wanted)


def test_limits_part_off_shares():
    bins = np.zeros(classifier.BINS)
    bins[[10, 100, 4000, 4050]] = 5, 50, 20, 3
    low, high = classifier.limits_of(bins, 20, 0.5)
    width = 2 * classifier.LIMIT / classifier.BINS
    # Ten are wanted on each side; the bin that is begun is taken whole.
    assert abs(high - (-classifier.LIMIT + 4000 * width)) < 1e-9
    assert abs(low - (-classifier.LIMIT + 101 * width)) < 1e-9
    low, high = classifier.limits_of(np.zeros(classifier.BINS), 20, 0.5)
    assert low < 0 < high


def test_a_source_without_labels_gets_labels_from_the_other_view(spark):
    rng = random.Random(11)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = []
    for i in range(600):
        good = i // 3 % 2 == 0
        text = " ".join(rng.choice(words) for _ in range(60)) + "." if good else "buy now " * 40
        rows.append((i, text, "en", "seen" if i < 200 else "unseen"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    given, inner = [], classifier.given_labels

    def noted(rounds, views):
        out = inner(rounds, views)
        given.append((len(rounds), [z.copy() for z in out]))
        return out

    everything = _views_of(df.orderBy("doc_id").collect())
    chosen = list(range(80))
    y = np.array([float(i // 3 % 2 == 0) for i in chosen])
    classifier.given_labels = noted
    try:
        classifier.co_train([v[chosen] for v in everything], y, lambda f: f(everything))
    finally:
        classifier.given_labels = inner
    last = max(given, key=lambda g: g[0])[1]
    for labels_of_view in last:
        outside = labels_of_view[200:]
        assert (outside == 1).sum() > 0 and (outside == 0).sum() > 0
        right = [z == (i // 3 % 2 == 0) for i, z in zip(range(200, 600), outside) if z >= 0]
        assert sum(right) / len(right) > 0.95


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    known = labels.filter("doc_id % 2 = 0")
    got = by_id(classifier.scored(docs, known), "kept")
    held = [(r["quality"] == 1, got[r["doc_id"]][0]) for r in labels.filter("doc_id % 2 = 1").collect()]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    good = [b for a, b in held if a]
    assert sum(good) / len(good) > 0.97


def test_pipeline(spark):
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert got and {r["shard"] for r in got} <= set(range(8))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, FOLDER)
    single = corpus_pipeline.drop_near_copies(spark, kept, FOLDER)
    clean = corpus_pipeline.drop_leaks(spark, single, FOLDER)
    assert {r["doc_id"] for r in got} <= {r["doc_id"] for r in clean.select("doc_id").collect()}
    assert docs.count() > kept.count() > single.count() >= clean.count()
