"""HTML as a sequence of leaf blocks, each with the features that a labeller reads.

A block is what stands between two tags of block elements. Tags in between are formatting and leave
no trace; a line break counts as white space. Pages are read once from front to back, in time that
follows their length, however badly the tags are nested, quoted or closed.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape
from typing import NamedTuple
from zlib import crc32

import numpy as np

# Elements that begin or end a block.
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
menu nav ol p pre search section summary table tbody td tfoot th thead tr ul ins label input
""".split())
_VOID = frozenset(["hr", "input"])
# Elements whose content is no text of the page: code, what is not shown, and controls of forms.
_SILENT = ("script", "style", "title", "noscript", "template", "textarea", "select", "datalist",
           "button", "iframe", "object", "svg", "math", "canvas", "audio", "video", "xmp", "noembed")
# An element in the first group is closed by the start of one in the second.
_P_ENDS = BLOCKS - {"ins", "label", "input"}
_ENDS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
         "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
         "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
         "tr": frozenset(["tr", "tbody", "tfoot"])}
# Possessive throughout, so no character is looked at twice.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</?([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""",
    re.S)
_BEGUN = re.compile(r"<[A-Za-z/!?]")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_CLOSING = {name: re.compile(rf"</{name}\b[^>]*+>?", re.I) for name in _SILENT}

PATH, NEAR, WORDS, PLAIN = 64, 32, 32, 14
WIDTH = PATH + NEAR + WORDS + PLAIN


class Block(NamedTuple):
    text: str
    path: np.ndarray
    near: np.ndarray
    tag: str
    depth: int
    linked: int


@lru_cache(maxsize=1 << 14)
def _traits(tag: str, attributes: str) -> tuple[np.ndarray, np.ndarray]:
    """Random but fixed vectors of an element: its name and the parts of its class, id and role."""
    tokens = {"t:" + tag}
    for value in _NAMED.findall(attributes):
        for piece in _PIECES.findall(value):
            tokens |= {"c:" + piece.lower(), "s:" + piece.lower()[:4]}
    out = []
    for width in (PATH, NEAR):
        vector = np.zeros(width, dtype=np.float32)
        for token in tokens:
            for k in range(3):
                code = crc32(f"{width}:{k}:{token}".encode())
                vector[code % width] += 1 if code >> 16 & 1 else -1
        out.append(vector)
    return tuple(out)


def blocks(html: str) -> list[Block]:
    """The blocks of a page that hold text."""
    found: list[Block] = []
    root = np.zeros(PATH, dtype=np.float32), np.zeros(NEAR, dtype=np.float32)
    stack = [("", *root)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    link, linked = False, 0
    at, last = 0, html.rfind(">")

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                tag, path, near = stack[-1]
                found.append(Block(text, path, near, tag, len(stack), linked))
        linked = 0

    def close(names: frozenset[str]) -> None:
        while stack[-1][0] in names:
            opened[stack.pop()[0]] -= 1

    def say(text: str) -> None:
        nonlocal linked
        text = unescape(text) if "&" in text else text
        parts.append(text)
        if link:
            linked += len(text)

    while at < len(html):
        start = html.find("<", at, last)
        tag = _TAG.match(html, start) if start >= 0 else None
        if tag is None:
            if start < 0:
                # No tag ends after this; one that begins was cut off.
                cut = _BEGUN.search(html, at)
                say(html[at:cut.start() if cut else len(html)])
                break
            say(html[at:start + 1])
            at = start + 1
            continue
        if start > at:
            say(html[at:start])
        at = tag.end()
        name = (tag[1] or "").lower()
        ending = html.startswith("</", start)
        if name in _CLOSING:
            if not ending and not (tag[2] or "").endswith("/"):
                end = _CLOSING[name].search(html, at)
                at = end.end() if end else len(html)
        elif name == "a":
            link = not ending
        elif name == "br":
            parts.append(" ")
        elif name in BLOCKS:
            flush()
            if ending:
                if opened[name]:
                    while stack[-1][0] != name:
                        opened[stack.pop()[0]] -= 1
                    opened[stack.pop()[0]] -= 1
                link = False
                continue
            if name in _P_ENDS:
                close(frozenset(["p"]))
            close(frozenset(k for k, v in _ENDS.items() if name in v))
            if name not in _VOID:
                path, near = _traits(name, tag[2] or "")
                stack.append((name, stack[-1][1] + path, near + np.float32(0.5) * stack[-1][2]))
                opened[name] += 1
    flush()
    return found


class _Buckets(dict):
    """Word to bucket, forgotten when there are many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[word] = value = crc32(word.lower().encode()) % (2 * WORDS)
        return value


_BUCKETS = _Buckets()
_STOPS = re.compile(r"[.,;:!?]")
_DIGITS = re.compile(r"[0-9]")


def features(page: list[Block]) -> np.ndarray:
    """A row of numbers for each block."""
    n = len(page)
    if not n:
        return np.empty((0, WIDTH), dtype=np.float32)
    split = [b.text.split() for b in page]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=n)
    codes = np.array([_BUCKETS[w] for words in split for w in words])
    counts = np.bincount(np.repeat(np.arange(n), sizes) * (2 * WORDS) + codes,
                         minlength=n * 2 * WORDS).reshape(n, 2 * WORDS)
    # Letters, linked letters, stops, digits, ends with a stop, begins large, depth.
    plain = np.array([
        (len(b.text), b.linked, len(_STOPS.findall(b.text)), len(_DIGITS.findall(b.text)),
         b.text[-1] in ".!?:;…\"'»”)", b.text[0].isupper(), b.depth) for b in page], dtype=np.float32)
    length = plain[:, 0]
    kinds = [(b.tag == "p", b.tag == "li", len(b.tag) == 2 and b.tag[0] == "h",
              b.tag in ("div", "section", "td", "")) for b in page]
    return np.concatenate((
        np.clip(np.stack([b.path for b in page]), -3, 3),
        np.clip(np.stack([b.near for b in page]), -3, 3),
        (counts[:, :WORDS] - counts[:, WORDS:]) / np.sqrt(sizes)[:, None],
        np.stack((
            np.log1p(length) / 5, np.log1p(sizes) / 4, np.minimum(plain[:, 1] / length, 1),
            np.minimum(plain[:, 2] / sizes, 2), plain[:, 4], plain[:, 5], plain[:, 3] / length,
            np.arange(n) / n, np.full(n, np.log1p(n) / 5), np.minimum(plain[:, 6], 40) / 10), axis=1),
        np.array(kinds, dtype=np.float32)), axis=1).astype(np.float32)
