"""The hash tree and the spelling variants beside plain versions of them."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from calltext.llm import merkle, spelling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp int, `at` string"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc_id, source, lang, n, text):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                      for v in (doc_id, source, lang, n, text)))


def _tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def _siblings(tree, at):
    path = []
    for level in tree[:-1]:
        path.append((at % 2, level[at ^ 1] if at ^ 1 < len(level) else None))
        at //= 2
    return path


def _plain(docs):
    by_lang = {}
    for d in docs:
        n = d[4]
        now = n + 1 if n is not None and d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0 else n
        by_lang.setdefault(d[2], []).append(
            (d[0] is not None, d[0] or 0, _leaf(d[0], d[3], d[2], n, d[1]),
             _leaf(d[0], d[3], d[2], now, d[1]), d[0]))
    langs = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: _tree([r[2] for r in sorted(by_lang[k], key=lambda r: r[:3])]) for k in langs}
    top = _tree([trees[k][-1][0] for k in langs])
    out = []
    for number, k in enumerate(langs):
        for at, row in enumerate(sorted(by_lang[k], key=lambda r: r[:3])):
            path = _siblings(trees[k], at) + _siblings(top, number)
            node = row[3]
            for odd, other in path:
                node = _h(node) if other is None else _h(other + node if odd else node + other)
            out.append((k, row[4], row[2], trees[k][-1][0], top[-1][0],
                        _h("".join(other or "" for _, other in path)), node))
    return sorted(out, key=str)


def _docs(rng, n):
    out = []
    for i in range(n):
        out.append((rng.choice([i, i, i, 3, None]), rng.choice(["a", "ä b", "", None]),
                    rng.choice(["en", "en", "en", "de", "é", None]), rng.choice(["s", None]),
                    rng.choice([5, 0, None]), 1, "clash"))
    return out + out[:n // 3] * 2


@pytest.mark.parametrize("n, bits", [(0, 2), (1, 2), (7, 2), (60, 1), (90, 2), (90, 10)])
def test_manifest(spark, n, bits):
    docs = _docs(random.Random(n), n)
    rows = merkle.tampered(spark.createDataFrame(docs, SCHEMA))
    got = merkle.Manifest(rows, bits).proofs().select(
        "grp", "key", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    assert sorted((tuple(r) for r in got.collect()), key=str) == _plain(docs)


def test_versions_copy_ancestors_only(spark):
    docs = [(i, "t", "en", "s", 1, 1, "") for i in range(21)]
    tree = merkle.Manifest(merkle.tampered(spark.createDataFrame(docs, SCHEMA)), 2)
    changed = [i for i in range(21) if zlib.crc32(str(i).encode()) % 7 == 0]
    rows = tree.versions().collect()
    assert changed and {r.key for r in rows} == set(changed)
    shared = {n for level in _tree([_leaf(i, "s", "en", 1, "t") for i in range(21)]) for n in level}
    for key in changed:
        mine = sorted((r.level, r.node) for r in rows if r.key == key)
        assert [level for level, _ in mine] == list(range(6))
        assert not shared & {node for _, node in mine}
        folded = tree.proofs().filter(F.col("key") == key).first().folded_root
        assert mine[-1][1] == folded


def test_manifest_of_a_long_text(spark):
    docs = [(1, "ä" * 500_000, "en", "s", 500_000, 1, "")]
    got = merkle.Manifest(merkle.tampered(spark.createDataFrame(docs, SCHEMA))).proofs().first()
    assert got.leaf == _leaf(1, "s", "en", 500_000, "ä" * 500_000)
    assert got.subroot == got.root == got.leaf and got.proof_sha256 == _h("")


# -- spelling ----------------------------------------------------------------------------------------

def _near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain_near(counts):
    out = {}
    for a in counts:
        near = [b for b in counts if _near(a, b)]
        if near:
            form = min(near, key=lambda b: (-counts[b], b))
            out[a] = (len(near), counts[form], form)
    return out


@pytest.mark.parametrize("letters, low, high, n", [
    ("ab", 1, 7, 120), ("abc", 4, 9, 400), ("abcdé", 7, 9, 400), ("ab", 12, 14, 500), ("a", 1, 70, 70)])
def test_near_words(spark, letters, low, high, n):
    rng = random.Random(n)
    counts = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))): rng.randint(1, 5)
              for _ in range(n)}
    for word in list(counts)[:n // 4]:  # neighbours for certain
        at = rng.randrange(len(word))
        counts[word[:at] + rng.choice(letters) + word[at:]] = 3
        counts[word[:at] + rng.choice(letters) + word[at + 1:]] = 3
    got = spelling.near_counts(spark.createDataFrame(list(counts.items()), "word string, n long"), 1)
    assert {r.word: (r.n_near, r.form_n, r.form) for r in got.collect()} == _plain_near(counts)


def test_one_group_of_many_words(spark):
    # All words share three quarters of their letters, so they meet in one group of thousands.
    counts = {f"abcdefghijkl{a}{b}{c}": 2 for a in "mnopqrstuv" for b in "abcdefghij" for c in "klmnopqrst"}
    counts["abcdefghijklmak"] = 50
    got = {r.word: r for r in spelling.near_counts(
        spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert len(got) == 1000 and all(r.n_near == 27 for r in got.values())
    assert got["abcdefghijklnak"].form == "abcdefghijklmak"


def test_words_and_forms(spark):
    rows = [(1, "Grossartig " * 30, "x"), (2, "grossartigg grossartigg, GROSSARTIGG?", "x"),
            (3, None, "x"), (4, "", "x"), (None, "kurz grosartigg grosartigg", "x"),
            (5, "q" * 300_000 + " " + "q" * 300_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    counts = {}
    for doc_id, text, _ in rows:
        for run in (text or "").lower().replace(",", " ").replace("?", " ").split():
            code = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and code % 31 == 0:
                run = run[:code % len(run)] + run[code % len(run) + 1:]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if n > 1}
    words = spelling.words(docs)
    assert {r.word: r.n for r in words.collect()} == counts
    got = {r.word: r for r in spelling.variants(words).collect()}
    assert set(got) == set(counts)
    assert got["grossartigg"].form == got["grossartigg"].root == "grossartig"
    assert got["grossartig"].form is None and got["grossartig"].root == "grossartig"
    assert spelling.variants(spelling.words(docs.limit(0))).collect() == []


def test_roots_follow_forms(spark):
    counts = [("abcdefg", 1), ("abcdefgh", 10), ("abcdefghi", 100), ("abcdefghij", 1000),
              ("abcdefghijk", 10_000), ("zzzzzzz", 1)]
    got = {r.word: (r.form, r.root) for r in spelling.variants(
        spark.createDataFrame(counts, "word string, n long")).collect()}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghijk")
    assert got["abcdefghij"] == ("abcdefghijk", "abcdefghijk")
    assert got["zzzzzzz"] == (None, "zzzzzzz")
