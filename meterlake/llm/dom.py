"""Pages as flat block trees: tolerant of markup that is not closed, linear in the length of the page.

Only block elements are nodes. A run of text between block boundaries is a leaf below the element it stands in; inline
elements leave no trace but the counts of a leaf. Nodes come in page order, so the subtree of node i is the range
[i, end[i]) and sums over subtrees are differences of running sums.
"""

from __future__ import annotations

import functools
import html as references
import re

import numpy as np

# Elements of the HTML standard by what they mean for blocks.
BLOCKS = frozenset(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements without text for a reader, whose content is never parsed, and controls, which are skipped where they end.
UNPARSED = "script|style|title|textarea|iframe|noframes|noembed|xmp"
SKIPPED = frozenset("button select datalist svg math template noscript object video audio canvas".split())
EMPTY = frozenset("hr".split())
#: A start tag of the first kind ends an open element of the others, unless one of the last stands between.
IMPLIED_ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["td", "th", "tr", "caption"]), frozenset(["table"])),
    "thead": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot", "caption"]), frozenset(["table"])),
    "tbody": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["td", "th", "tr", "thead", "tbody", "tfoot", "caption"]), frozenset(["table"])),
}
#: An end tag does not reach beyond these, but for their own.
BARRIERS = frozenset(["table", "td", "th"])

_ATTRIBUTES = r"""[^>=]*(?:=\s*(?:"[^"]*"|'[^']*')?[^>=]*)*"""
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({UNPARSED})(?=[\s/>]){_ATTRIBUTES}(?:>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Attributes whose words say what an element is for.
NAMING = frozenset("class id role itemprop aria-label".split())

ROOT, RUN = "#page", "#run"


@functools.lru_cache(maxsize=1 << 14)
def tokens(attributes: str) -> tuple[str, ...]:
    """The words of the attributes that name an element, and ``hidden`` where it is not shown."""
    found: list[str] = []
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in NAMING:
            found += [t.lower() for t in _TOKEN.findall(value)]
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            found.append("hidden")
    return tuple(dict.fromkeys(found))


class Forest:
    """The block trees of several pages one after the other."""

    def __init__(self):
        self.tag: list[str] = []
        self.tokens: list[tuple[str, ...]] = []
        self.parent: list[int] = []
        self.end: list[int] = []
        self.depth: list[int] = []
        self.text: list[str] = []
        self.link_chars: list[int] = []
        self.inputs: list[int] = []
        self.pages: list[int] = []

    def _node(self, tag: str, names: tuple[str, ...], parent: int, depth: int, text: str = "", linked: int = 0) -> int:
        at = len(self.tag)
        self.tag.append(tag)
        self.tokens.append(names)
        self.parent.append(parent)
        self.end.append(at + 1)
        self.depth.append(depth)
        self.text.append(text)
        self.link_chars.append(linked)
        self.inputs.append(0)
        return at

    def add(self, page: str) -> None:
        """Parse a page; its root is a node of its own."""
        root = self._node(ROOT, (), -1, 0)
        self.pages.append(root)
        stack, open_count = [root], {}
        pieces: list[str] = []
        linked, link_from = 0, -1

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self._node(RUN, (), stack[-1], len(stack), text, min(linked, len(text)))
                pieces.clear()
            linked = 0

        def close(depth: int) -> None:
            """End open elements down to so many."""
            nonlocal link_from
            while len(stack) > depth:
                at = stack.pop()
                self.end[at] = len(self.tag)
                open_count[self.tag[at]] -= 1
            if link_from > depth:
                link_from = -1

        def close_implied(kinds: frozenset, stops: frozenset) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tag[stack[depth]]
                if tag in stops:
                    return
                if tag in kinds:
                    flush()
                    close(depth)

        done, resume, never = 0, 0, set()
        for found in _MARKUP.finditer(page):
            start = found.start()
            if start < resume:
                continue
            if start > done:
                piece = page[done:start]
                if "&" in piece:
                    piece = references.unescape(piece)
                pieces.append(piece)
                if link_from >= 0:
                    linked += len(piece.strip())
            done = found.end()
            _, closing, name, attributes = found.groups()
            if name is None:
                continue
            name = name.lower()
            if name in BLOCKS:
                if not closing:
                    flush()
                    if self.tag[stack[-1]] == "p":
                        close(len(stack) - 1)
                    elif name in HEADINGS and self.tag[stack[-1]] in HEADINGS:
                        close(len(stack) - 1)
                    if name in IMPLIED_ENDS:
                        close_implied(*IMPLIED_ENDS[name])
                    at = self._node(name, tokens(attributes) if attributes else (), stack[-1], len(stack))
                    if name not in EMPTY:
                        stack.append(at)
                        open_count[name] = open_count.get(name, 0) + 1
                else:
                    kinds = HEADINGS if name in HEADINGS else (name,)
                    if any(open_count.get(k) for k in kinds):
                        for depth in range(len(stack) - 1, 0, -1):
                            tag = self.tag[stack[depth]]
                            if tag in kinds:
                                flush()
                                close(depth)
                                break
                            if tag in BARRIERS and name not in IMPLIED_ENDS and name != "table":
                                break
            elif name == "a":
                link_from = -1 if closing else len(stack)
            elif name == "br":
                pieces.append("\n")
            elif name == "input" and not closing:
                self.inputs[stack[-1]] += 1
            elif name in SKIPPED and not closing and name not in never:
                if name in ("button", "select"):
                    self.inputs[stack[-1]] += 1
                ended = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, done)
                if ended:
                    resume = done = ended.end()
                    pieces.append(" ")
                else:
                    never.add(name)
        if done < len(page):
            piece = page[done:]
            pieces.append(references.unescape(piece) if "&" in piece else piece)
        flush()
        close(1)
        self.end[root] = len(self.tag)

    def arrays(self) -> dict[str, np.ndarray]:
        n = len(self.tag)
        return {
            "parent": np.array(self.parent, np.int64), "end": np.array(self.end, np.int64), "depth": np.array(self.depth, np.int64),
            "page": np.searchsorted(self.pages, np.arange(n), "right") - 1,
        }
