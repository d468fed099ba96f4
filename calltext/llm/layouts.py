"""Made-up pages with known labels, for the block labeller to learn from.

The words are those of given pages; what is made up is how pages are built: where the article stands,
what it is wrapped in, and the menus, notices, adverts, forms, side columns and comments around it.
"""

from __future__ import annotations

import random
from html import escape

# Names that page authors give to the parts of a page.
ARTICLE = ["article", "content", "post", "entry-content", "story-body", "main", "text", "page-content",
           "articleBody", "post-body", "mainContent", "blog-post", "news-text", "body-copy", "rich-text"]
MENU = ["nav", "menu", "navbar", "main-nav", "breadcrumb", "topnav", "navigation", "site-menu", "tabs",
        "pagination", "toc-links", "subnav"]
HEADER = ["header", "masthead", "top-bar", "site-header", "branding", "page-head", "banner-top", "logo"]
FOOTER = ["footer", "site-footer", "copyright", "bottom", "legal", "colophon", "imprint", "foot-links"]
SIDE = ["sidebar", "aside", "widget", "right-rail", "related", "popular", "more-stories", "recommended",
        "teaser", "tags", "author-box", "side-column", "trending", "see-also"]
NOTICE = ["cookie-notice", "consent", "gdpr", "alert", "notice", "cookieBanner", "popup", "modal",
          "overlay", "notification", "paywall", "subscribe-hint", "disclaimer"]
ADVERT = ["ad", "ads", "advert", "sponsored", "promo", "adsbygoogle", "banner", "ad-slot", "advertisement",
          "dfp", "sponsor-box", "commercial"]
FORM = ["form", "newsletter", "search-form", "login", "signup", "subscribe", "contact-form", "poll"]
COMMENTS = ["comments", "comment-list", "commentlist", "disqus", "replies", "responses", "discussion",
            "reader-comments", "user-comments"]
SHARE = ["share", "social", "share-bar", "byline-links", "follow-us", "toolbar"]


class Layouts:
    """A source of pages. ``sentences`` is what paragraphs are made of, ``words`` what labels are."""

    def __init__(self, sentences: list[str], seed: int):
        self.random = random.Random(seed)
        self.sentences = sentences or ["Lorem."]
        self.words = [w for s in self.sentences for w in s.split()] or ["Lorem"]
        self.html: list[str] = []
        self.labels: list[bool] = []

    # -- text
    def some(self, low: int, high: int) -> str:
        at = self.random.randrange(len(self.words))
        return " ".join(self.words[at:at + self.random.randint(low, high)])

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.random.choice(self.sentences)
                        for _ in range(self.random.randint(low, high)))

    def chance(self, share: float) -> bool:
        return self.random.random() < share

    # -- markup
    def leaf(self, text: str, label: bool, around: str = "{}") -> None:
        self.html.append(around.format(escape(text, quote=self.chance(0.5))))
        if text.strip():
            self.labels.append(label)

    def opened(self, names: list[str], tags: list[str], plain: str | None = None) -> str:
        if plain and self.chance(0.3):
            self.html.append(f"<{plain}>")
            return plain
        tag, name = self.random.choice(tags), self.random.choice(names)
        how = self.random.choice(["class", "class", "id"])
        more = f" {self.random.choice(['clearfix', 'col-8', 'box', 'wrap', 'block', 'mt-4', 'inner'])}"
        self.html.append(f'<{tag} {how}="{name}{more if self.chance(0.3) else ""}">')
        return tag

    def links(self, label: bool, low: int = 3, high: int = 12) -> None:
        kind = self.random.choice(["<li><a href='/x'>{}</a></li>", "<li><a href='/x'>{}</a>",
                                   "<div><a href='/x'>{}</a></div>", "<p><a href='#'>{}</a></p>"])
        listed = kind.startswith("<li")
        self.html.append("<ul>" if listed else "")
        for _ in range(self.random.randint(low, high)):
            self.leaf(self.some(1, 4), label, kind)
        self.html.append("</ul>" if listed else "")

    # -- parts of a page
    def paragraph(self, long: bool = True) -> None:
        kind = self.random.random()
        text = self.prose(1, 6) if kind < 0.6 else self.some(1, 3) + "." if kind < 0.75 else (
            self.some(3, 60) if kind < 0.9 else " | ".join(self.some(1, 1) for _ in range(20)))
        if self.chance(0.15):
            text += " " + self.random.choice("&<©€") + " " + self.some(1, 3)
        around = self.random.choice(
            ["<p>{}</p>"] * 6 + ["<p><b>{}<br>", "<p>{}", "<div>{}</div>", "<p>{}<br/></p>",
                                 "<p><em>{}</em></p>", "<p class='lead'>{}</p>", "<p><a href='/s'>{}</a></p>",
                                 "<blockquote><p>{}</p></blockquote>"])
        self.leaf(text, True, around)

    def article(self) -> None:
        plain = self.random.choice(["article", "main"]) if self.chance(0.6) else None
        bare = self.chance(0.1)
        tag = "" if bare else self.opened(ARTICLE, ["div", "div", "section", "article", "main", "td"], plain)
        if self.chance(0.85):
            self.leaf(self.some(2, 14), True, self.random.choice(["<h1>{}</h1>", "<h2>{}</h2>"]))
        if self.chance(0.1):
            self.boxed(SHARE, ["div", "ul"])
        for _ in range(self.random.choice([1, 2, 3, 5, 8, 13, 25])):
            kind = self.random.random()
            if kind < 0.85:
                self.paragraph()
            elif kind < 0.9:
                self.leaf(self.some(2, 8), True, "<h2>{}</h2>" if self.chance(0.5) else "<h3>{}</h3>")
            elif kind < 0.94:
                self.html.append("<ul>")
                for _ in range(self.random.randint(2, 6)):
                    self.leaf(self.prose(1, 1), True, "<li>{}</li>")
                self.html.append("</ul>")
            elif kind < 0.96:
                self.html.append("<table>")
                for _ in range(self.random.randint(1, 4)):
                    self.html.append("<tr>")
                    for _ in range(self.random.randint(2, 3)):
                        self.leaf(self.some(1, 4), True, "<td>{}</td>")
                    self.html.append("</tr>")
                self.html.append("</table>")
            elif kind < 0.98:
                self.boxed(ADVERT, ["div", "ins", "aside"])
            else:
                self.boxed(SIDE, ["div", "aside"])
        if self.chance(0.1):
            self.comments()
        self.html.append(f"</{tag}>" if tag else "")

    def boxed(self, names: list[str], tags: list[str], plain: str | None = None) -> None:
        """A part that is no article: links, a few words or some prose."""
        tag = self.opened(names, tags, plain)
        if self.chance(0.3):
            self.leaf(self.some(1, 4), False, self.random.choice(["<h3>{}</h3>", "<h4>{}</h4>", "<p>{}</p>"]))
        kind = self.random.random()
        if kind < 0.45:
            self.links(False)
        elif kind < 0.75:
            self.leaf(self.prose(1, 3), False, self.random.choice(["{}", "<p>{}</p>", "<div>{}</div>"]))
        else:
            for _ in range(self.random.randint(1, 4)):
                self.leaf(self.some(1, 12), False, self.random.choice(["<p>{}</p>", "<div>{}</div>"]))
        self.html.append(f"</{tag}>")

    def form(self) -> None:
        tag = self.opened(FORM, ["form", "form", "div"], "form")
        for _ in range(self.random.randint(1, 4)):
            self.leaf(self.some(1, 6), False, self.random.choice(
                ["<label>{}</label><input>", "<p>{}</p>", "<label>{}<input></label>", "<legend>{}</legend>"]))
        self.html.append(f"<button>{self.some(1, 2)}</button><select><option>{self.some(1, 1)}</select>")
        self.html.append(f"</{tag}>")

    def comments(self) -> None:
        tag = self.opened(COMMENTS, ["div", "section", "ol", "ul"])
        inner = "li" if tag in ("ol", "ul") else self.random.choice(["div", "article"])
        if tag not in ("ol", "ul") and self.chance(0.5):
            self.leaf(self.some(1, 3), False, "<h3>{}</h3>")
        for _ in range(self.random.randint(1, 6)):
            self.html.append(f"<{inner} class='{self.random.choice(['comment', 'reply', 'response', 'c-item'])}'>")
            if self.chance(0.5):
                self.leaf(self.some(1, 3), False, "<div class='author'>{}</div>")
            self.leaf(self.prose(1, 3), False, self.random.choice(["<p>{}</p>", "<div>{}</div>"]))
            self.html.append(f"</{inner}>")
        self.html.append(f"</{tag}>")

    def page(self) -> tuple[str, list[bool]]:
        """The markup of a page and, for each of its blocks, whether it is part of the article."""
        self.html, self.labels = ["<!DOCTYPE html><html><head><title>"], []
        self.html.append(escape(self.some(2, 9)))
        self.html.append('</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>')
        before = [(0.5, lambda: self.boxed(HEADER, ["div", "header"], "header")),
                  (0.8, lambda: self.boxed(MENU, ["div", "ul", "nav"], "nav")),
                  (0.3, lambda: self.boxed(NOTICE, ["div", "section", "aside"])),
                  (0.5, lambda: self.boxed(ADVERT, ["div", "div", "section"])),
                  (0.15, lambda: self.boxed(SIDE, ["div", "aside"], "aside")),
                  (0.15, self.form)]
        after = [(0.3, lambda: self.boxed(SHARE, ["div", "ul"])), (0.4, self.comments),
                 (0.4, lambda: self.boxed(SIDE, ["div", "aside", "section"], "aside")),
                 (0.3, lambda: self.boxed(ADVERT, ["div"])), (0.2, self.form),
                 (0.2, lambda: self.boxed(NOTICE, ["div"])),
                 (0.8, lambda: self.boxed(FOOTER, ["div", "footer"], "footer"))]
        for share, part in before:
            if self.chance(share):
                part()
        wrapped = self.random.choice(["", "", "div class='container'", "div id='wrapper'", "table><tr", "section"])
        if wrapped:
            self.html.append(f"<{wrapped}>")
        if not self.chance(0.03):
            self.article()
        if wrapped:
            self.html.append("</table>" if wrapped[0] == "t" else f"</{wrapped.split()[0]}>")
        for share, part in after:
            if self.chance(share):
                part()
        self.html.append("</body></html>" if self.chance(0.8) else "")
        return "".join(self.html), self.labels
