"""HTML pages as sequences of leaf blocks.

A block is the text between two block boundaries: the start or end of any element
that is not inline.  Each block knows its path (the open elements with their class
and id words) and how many of its characters stand inside links.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Fixed values of HTML: elements by how their content flows.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rt rp s samp small "
    "span strike strong sub sup time tt u var wbr").split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset("script style title noscript template svg iframe textarea object canvas".split())
CLOSES = {   # a start tag that ends an open element of these names
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("tr", "thead"), "tfoot": ("tr", "tbody")}
SCOPES = frozenset("table ul ol dl select body html".split())

TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
MARKS = re.compile(r"(?:^|\s)(class|id|role|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORDS = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]      # element names and name words, outermost first
    text: str
    link_chars: int
    main: bool                 # the nearest data-main mark, for training pages


def blocks(page: str) -> list[Block]:
    """Blocks with text, in page order.  Character references are decoded, white
    space becomes one space.  Open elements at the end of a cut-off page count."""
    return _Parser().run(page)


class _Parser:
    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...], str | None]] = []   # name, words, data-main
        self.parts: list[str] = []
        self.link_chars = 0
        self.out: list[Block] = []

    def run(self, page: str) -> list[Block]:
        at, lower = 0, None
        for m in iter(lambda: TAG.search(page, at), None):
            self._text(page[at:m.start()])
            at = m.end()
            name = m[2] and m[2].lower()
            if not name:
                continue
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3])
            if name in SKIPPED and not m[3].rstrip().endswith("/"):
                lower = page.lower() if lower is None and not page.islower() else lower or page
                end = _same_length(lower, page).find(f"</{name}", at)
                at = len(page) if end < 0 else end
        self._text(page[at:])
        self._flush()
        return self.out

    def _text(self, raw: str) -> None:
        if raw and not (self.stack and self.stack[-1][0] in SKIPPED):
            self.parts.append(raw)
            if any(n == "a" for n, _, _ in self.stack):
                self.link_chars += len(raw)

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.parts.append(" ")
        if name not in INLINE:
            self._flush()
            if any(n == "p" for n, _, _ in self.stack) and name not in SKIPPED:
                self._close(("p",))
            if name in CLOSES:
                self._close(CLOSES[name], SCOPES)
        if name in VOID:
            return
        words, main = (), None
        if attributes:
            for m in MARKS.finditer(attributes):
                value = m[2] or m[3] or m[4] or ""
                if m[1].lower() == "data-main":
                    main = value
                else:
                    words += tuple(NAME_WORDS.findall(value.lower()))
        self.stack.append((name, words, main))

    def _end(self, name: str) -> None:
        if name not in INLINE:
            self._flush()
        if any(n == name for n, _, _ in self.stack):
            self._close((name,))

    def _close(self, names: tuple[str, ...], scopes=frozenset()) -> None:
        """Close the innermost open element of ``names``, and all inside it."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in names:
                self.stack = self.stack[:k]
                return
            if self.stack[k][0] in scopes:
                return

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            path = tuple(w for n, words, _ in self.stack for w in (n, *words))
            main = next((m for _, _, m in reversed(self.stack) if m is not None), "0")
            self.out.append(Block(path, text, self.link_chars, main == "1"))
        self.parts, self.link_chars = [], 0


def _same_length(lower: str, page: str) -> str:
    """Lower case may change the length of rare letters; then search as written."""
    return lower if len(lower) == len(page) else page
