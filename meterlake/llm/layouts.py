"""Pages assembled from a grammar of layouts, whose main text is known: what the extraction learns from.

Every block of the main text begins with ``MARK``, a private character no page is made of otherwise. Layouts vary in how
their parts are named (by element, by class or id, or not at all), in their order, in the length of their texts and in
whether elements are closed. Everything follows from the seed.
"""

from __future__ import annotations

import functools
import random
from collections.abc import Iterator

MARK = "\ue000"

# Names that authors give to the parts of a page.
MAIN_NAMES = (
    "article content post entry story main body text prose page-content post-content entry-content article-body articleBody main-content "
    "mainContent story-body blog-post single hentry markdown-body read post-text"
).split()
OTHER_NAMES = {
    "menu": "nav navbar menu main-menu navigation top-nav site-nav breadcrumb breadcrumbs links tabs toolbar pagination pager skip-links dropdown".split(),
    "header": "header site-header masthead top page-header branding logo banner topbar tagline".split(),
    "footer": "footer site-footer bottom colophon copyright legal page-footer credits imprint footnote-links".split(),
    "sidebar": "sidebar aside side widget widget-area secondary rail right-col sidebar-left complementary toc".split(),
    "related": "related related-posts recommended more-stories read-next also-like popular trending teaser see-also tags share social sharing follow".split(),
    "notice": "notice cookie cookie-banner cookie-notice consent gdpr alert popup modal overlay warning disclaimer message announcement privacy toast paywall".split(),
    "advert": "ad ads advert advertisement adsbygoogle sponsored sponsor promo promotion banner-ad ad-slot commercial affiliate outbrain taboola".split(),
    "form": "form newsletter subscribe signup login search search-form contact-form subscription register poll feedback".split(),
    "comments": "comments comment-list comment respond reply discussion disqus thread user-comments responses reader-comments replies".split(),
}
OTHER_TAGS = {
    "menu": "nav div ul menu".split(), "header": "header div".split(), "footer": "footer div".split(), "sidebar": "aside div section".split(),
    "related": "aside div section ul".split(), "notice": "div section aside p dialog".split(), "advert": "div aside section p".split(),
    "form": "form div section".split(), "comments": "section div ol".split(),
}
PLAIN_NAMES = "container wrapper row col col-8 inner outer box css-1x2 grid flex block clearfix layout w-100 js-x module section-3 unit".split()
SYLLABLES = "an er in th on ti es en re nd ha ou ing le la de que ment der sch ein ung ich aux ción ado ár é ü ä 日 本 сло во ма".split()


@functools.cache
def _words() -> list[str]:
    """Invented words, some with a comma or a character reference behind them."""
    r = random.Random(1)
    return ["".join(r.choices(SYLLABLES, k=r.choice((1, 1, 2, 2, 3, 4)))) + r.choice(("", "", "", "", "", ",", " &amp;")) for _ in range(4000)]


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        #: How parts are named: by element and class, by class alone, by element alone, or not.
        self.by_tag, self.by_name = self.r.choice([(True, True), (True, True), (False, True), (True, False), (False, False)])
        self.untidy = self.r.random() < 0.3

    def chance(self, share: float) -> bool:
        return self.r.random() < share

    def words(self, n: int) -> str:
        return " ".join(self.r.choices(_words(), k=n))

    def sentences(self, n: int) -> str:
        return " ".join(self.words(self.r.choice((1, 2, 5, 9, 14, 22))).capitalize() + self.r.choice("...?!") for _ in range(n))

    def element(self, tag: str, inside: str, names: list[str] | None = None, more: str = "") -> str:
        given = ""
        if names:
            given = f' {self.r.choice(("class", "class", "class", "id", "role"))}="{" ".join(names)}"'
        elif self.chance(0.15):
            given = f' class="{self.r.choice(PLAIN_NAMES)}"'
        ended = "" if self.untidy and tag in ("p", "li", "dd", "td") and self.chance(0.5) else f"</{tag}>"
        return f"<{tag}{given}{more}>{inside}{ended}"

    def link(self, n: int) -> str:
        return f'<a href="/{self.r.randrange(999)}">{self.words(n)}</a>'

    def links(self, n: int) -> str:
        kind = self.r.randrange(4)
        items = [self.link(self.r.choice((1, 1, 2, 3))) for _ in range(n)]
        if kind == 0:
            return " | ".join(items)
        inside = "".join(self.element("li" if kind < 3 else "div", i) for i in items)
        return self.element("ul", inside) if kind < 3 else inside

    def wrapped(self, inside: str) -> str:
        for _ in range(self.r.choice((0, 0, 1, 2))):
            inside = self.element("div", inside, [self.r.choice(PLAIN_NAMES)] if self.chance(0.6) else None)
        return inside

    # main text

    def block(self, text: str, tag: str = "p", **more) -> str:
        return self.element(tag, MARK + text, **more)

    def paragraph(self) -> str:
        text = self.sentences(self.r.choice((1, 1, 2, 3, 5, 8)))
        if self.chance(0.25):
            text += " " + self.r.choice((f"<b>{self.words(3)}</b>", f"<em>{self.words(2)}", self.link(2), "<br>", f"<span>{self.words(2)}</span>")) + " " + self.sentences(1)
        tag = "div" if not self.by_tag and not self.by_name and self.chance(0.2) else "p"
        return self.block(text, tag)

    def main_part(self) -> str:
        kind = self.r.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.80:
            return self.block(self.words(self.r.randint(1, 8)), self.r.choice(("h2", "h3")))
        if kind < 0.87:
            tag = self.r.choice(("ul", "ol"))
            return self.element(tag, "".join(self.block(self.sentences(self.r.choice((1, 1, 2))), "li") for _ in range(self.r.randint(2, 6))))
        if kind < 0.91:
            return self.element("blockquote", self.paragraph() if self.chance(0.5) else MARK + self.sentences(2))
        if kind < 0.94:
            return self.block(self.words(12), "pre")
        if kind < 0.97:
            rows = "".join(self.element("tr", "".join(self.block(self.words(2), "td") for _ in range(3))) for _ in range(self.r.randint(2, 4)))
            return self.element("table", rows)
        return self.element("figure", "<img src=x>" + self.block(self.words(6), "figcaption"))

    def article(self) -> str:
        n = self.r.choice((1, 2, 4, 7, 12, 20))
        parts = [self.main_part() for _ in range(n)]
        if self.chance(0.15):
            parts = [MARK + self.sentences(3)] if self.chance(0.5) else [self.paragraph()]
        for _ in range(self.r.choice((0, 0, 0, 1, 2))):
            parts.insert(self.r.randint(0, len(parts)), self.other(self.r.choice(("advert", "related", "form", "notice", "advert"))))
        head = self.block(self.words(self.r.randint(2, 10)), "h1") if self.chance(0.75) else ""
        return head + "".join(parts)

    def main(self) -> str:
        inside = self.article()
        if self.chance(0.25):
            inside = self.wrapped(inside)
        named = [self.r.choice(MAIN_NAMES)] if self.by_name and self.chance(0.8) else None
        if self.by_tag:
            inside = self.element(self.r.choice(("article", "article", "main", "section")), inside, named)
            return self.element("main", inside) if self.chance(0.25) else inside
        return self.element("div", inside, named) if self.chance(0.85) else inside

    # everything else

    def other(self, kind: str) -> str:
        r = self.r
        named = [r.choice(OTHER_NAMES[kind])] if self.by_name and self.chance(0.85) else None
        tag = r.choice(OTHER_TAGS[kind]) if self.by_tag else "div"
        if not self.by_tag and not self.by_name and kind in ("advert", "notice"):
            named = [r.choice(OTHER_NAMES[kind])]
        if kind == "menu":
            inside = self.links(r.randint(2, 12))
            if tag in ("ul", "menu"):
                inside = "".join(self.element("li", self.link(1)) for _ in range(r.randint(2, 9)))
        elif kind == "header":
            inside = r.choice((self.link(2), self.words(3), self.element("h1", self.link(2)), self.element("p", self.words(6)))) + (self.links(5) if self.chance(0.4) else "")
        elif kind == "footer":
            inside = r.choice((f"&copy; {self.words(2)} &middot; ", f"Copyright {r.randint(1990, 2030)} ", "", self.links(4))) + r.choice((self.sentences(1), self.sentences(2), self.element("p", self.sentences(1))))
        elif kind == "sidebar":
            inside = (self.element("h3", self.words(2)) if self.chance(0.6) else "") + r.choice((self.links(r.randint(3, 9)), self.element("p", self.sentences(r.randint(1, 3)))))
        elif kind == "related":
            inside = (self.element("h3", self.words(2)) if self.chance(0.5) else "") + self.links(r.randint(2, 6))
            if self.chance(0.3):
                inside += "".join(self.element("p", self.link(r.randint(3, 8)) + (" " + self.words(8) if self.chance(0.5) else "")) for _ in range(3))
        elif kind == "notice":
            inside = r.choice((self.sentences(r.randint(1, 4)), self.element("p", self.sentences(r.randint(1, 3)))))
            inside += r.choice(("", f"<button>{self.words(1)}</button>", self.link(2)))
        elif kind == "advert":
            inside = r.choice((self.sentences(r.randint(1, 3)), self.element("p", self.sentences(1)), self.link(4), self.element("h4", self.words(3)) + self.link(3)))
        elif kind == "form":
            inside = (self.element("p", self.sentences(1)) if self.chance(0.6) else "") + "".join(
                f"<label>{self.words(1)}</label><input name=x>" for _ in range(r.randint(1, 4))) + f"<button>{self.words(1)}</button>"
            if not self.by_name and not self.by_tag:
                tag = "form"
        else:
            item = "li" if tag == "ol" else "div"
            comments = []
            for _ in range(r.randint(1, 8)):
                said = "".join(self.element("p", self.sentences(r.choice((1, 1, 2, 4)))) for _ in range(r.choice((1, 1, 2))))
                by = r.choice((self.element("span", self.words(2)), self.element("div", self.words(2)), self.element("h4", self.link(1)), f"<time>{r.randint(1, 28)}.{r.randint(1, 12)}.</time> "))
                comments.append(self.element(item, by + said + (self.link(1) if self.chance(0.4) else ""), ["comment"] if self.by_name and self.chance(0.6) else None))
            inside = (self.element("h3", f"{len(comments)} {self.words(1)}") if self.chance(0.6) else "") + "".join(comments)
            if not self.by_name and not self.by_tag:
                named = [r.choice(OTHER_NAMES[kind])]
        return self.element(tag, inside, named, ' style="display:none"' if kind in ("notice", "form") and self.chance(0.1) else "")

    def page(self) -> str:
        kind = self.r.random()
        if kind < 0.06:
            body = "".join(self.main_part() for _ in range(self.r.randint(1, 6)))
        elif kind < 0.09:
            body = MARK + self.sentences(self.r.randint(1, 6))
        elif kind < 0.13:
            body = "".join(self.other(k) for k in self.r.sample(["menu", "header", "footer", "related", "notice"], 3))
        else:
            before = [k for k in ("notice", "header", "menu", "menu", "advert", "form", "sidebar") if self.chance(0.4)]
            after = [k for k in ("comments", "comments", "related", "sidebar", "advert", "form", "menu", "notice") if self.chance(0.35)]
            self.r.shuffle(before)
            self.r.shuffle(after)
            inside = [self.other(k) for k in before], self.main(), [self.other(k) for k in after]
            body = "".join(inside[0]) + inside[1] + "".join(inside[2])
            if self.chance(0.3):
                cut = self.r.randint(0, len(before))
                body = "".join(inside[0][:cut]) + self.wrapped("".join(inside[0][cut:]) + inside[1] + "".join(inside[2]))
            if self.chance(0.8):
                body += self.other("footer")
        end = "" if self.untidy else "</body></html>"
        return f"<!DOCTYPE html><html><head><title>{self.words(4)}</title></head><body>{body}{end}"


def pages(n: int, seed: int) -> Iterator[str]:
    """So many pages; each follows from the seed and its number."""
    for k in range(n):
        yield _Writer(seed * 1_000_003 + k).page()
