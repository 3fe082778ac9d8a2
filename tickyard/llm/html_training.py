"""Labelled training pages for the block labeller.

Pages are drawn from a layout grammar: site furniture (menus, headers, sidebars,
notices, adverts, forms, comments, footers) around an article, with many namings
and nestings, unclosed elements and invented words.  ``data-main`` marks what is
article and what is not; the labeller never sees it.  The draw is seeded.
"""

from __future__ import annotations

import random

SYLLABLES = "an ta re lo mi en su ka der ion ver the sch ou eau que ci ll be no ti ra".split()
ENDS = ". . . ? !".split()


def training_pages(count: int, seed: int = 7) -> list[str]:
    r = random.Random(seed)
    return [_Page(r).html() for _ in range(count)]


class _Page:
    def __init__(self, r: random.Random):
        self.r = r
        self.junk = r.random() < 0.15
        self.linked = r.random()

    def word(self) -> str:
        w = "".join(self.r.choices(SYLLABLES, k=self.r.randint(1, 4)))
        return w + self.r.choice(["###", "%%%", "***", "$$$", "&amp;&amp;&amp;"]) if self.junk else w

    def words(self, low: int, high: int) -> str:
        w = [self.word() for _ in range(self.r.randint(low, high))]
        for k in range(len(w) - 1):
            if self.r.random() < 0.08:
                w[k] += self.r.choice([",", ",", ".", " &amp;", ";"])
        return " ".join(w).capitalize()

    def sentence(self, low: int, high: int) -> str:
        return self.words(low, high) + self.r.choice(ENDS)

    def tag(self, name: str, body: str, marks: str = "") -> str:
        return f"<{name}{' ' + marks if marks else ''}>{body}</{name}>"

    def mark(self, *names: str) -> str:
        """A class or id of one of the names, sometimes decorated, sometimes none."""
        if self.r.random() < 0.1:
            return ""
        name = self.r.choice(names)
        name = self.r.choice([name, name, f"{name}-{self.word()[:4].strip('#%*$&')}", f"site-{name}", f"{name} wide"])
        return f'{self.r.choice(["class", "class", "id"])}="{name}"'

    def box(self, names: tuple[str, ...], body: str, elements: tuple[str, ...] = ("div", "section")) -> str:
        return self.tag(self.r.choice(elements), body, f'{self.mark(*names)} data-main="0"'.strip())

    def links(self, low: int, high: int) -> str:
        return "".join(self.tag("li", self.tag("a", self.words(1, 3), 'href="/x"'))
                       for _ in range(self.r.randint(low, high)))

    def furniture(self) -> list:
        """Makers of non-article parts, with the usual element and some namings."""
        r, t = self.r, self.tag
        return [
            lambda: t("nav", t("ul", self.links(2, 9)), 'data-main="0"'),
            lambda: self.box(("menu", "navbar", "topnav", "breadcrumbs", "tabs"), t("ul", self.links(2, 9))),
            lambda: self.box(("menu", "breadcrumb"), " / ".join(t("a", self.words(1, 2)) for _ in range(3))),
            lambda: t("header", r.choice(["", t("p", self.sentence(2, 10)), t("h1", self.words(1, 4)),
                                          t("a", self.words(1, 4))]) + t("div", self.words(1, 6)), 'data-main="0"'),
            lambda: self.box(("header", "masthead", "banner", "topbar", "logo"),
                             r.choice([t("h1", self.words(1, 4)), t("p", self.sentence(2, 9)), self.words(1, 5)])),
            lambda: self.box(("ad", "ads", "advert", "sponsored", "promo", "advertisement"), self.sentence(3, 30), ("div",)),
            lambda: self.box(("ad", "ads", "advert", "sponsor", "promo"),
                             t("p", self.sentence(3, 30)) + r.choice(["", t("a", self.words(1, 4))]), ("div", "aside")),
            lambda: t("aside", r.choice([t("p", self.sentence(4, 40)), t("h3", self.words(1, 4)) + t("ul", self.links(2, 7))]),
                      'data-main="0"'),
            lambda: self.box(("sidebar", "side", "related", "widget", "rail"),
                             t("h3", self.words(1, 4)) + r.choice([t("ul", self.links(2, 7)), t("p", self.sentence(4, 40)),
                                                                    t("p", self.sentence(4, 20)) * 2])),
            lambda: self.box(("cookie", "notice", "consent", "gdpr", "alert", "banner", "popup", "warning"),
                             r.choice([self.sentence(4, 25), t("p", self.sentence(4, 25)) + t("button", self.words(1, 2))])),
            lambda: t("form", r.choice([t("label", self.words(1, 4)) + '<input name="q">' + t("button", self.words(1, 2)),
                                        t("p", self.sentence(3, 12)) + "<input>" + t("button", self.words(1, 2))]),
                      f'{self.mark("search", "newsletter", "login", "subscribe")} data-main="0"'.strip()),
            lambda: self.box(("newsletter", "subscribe", "share", "social", "signup"),
                             t("p", self.sentence(3, 14)) + t("form", t("label", self.words(1, 3)) + t("button", self.words(1, 2)))),
            lambda: t("dialog", t("p", self.sentence(4, 20)), 'data-main="0"'),
        ]

    def after(self) -> list:
        r, t = self.r, self.tag

        def comment() -> str:
            inner = r.choice(["", t("span", self.words(1, 2)), t("b", self.words(1, 2)), t("h4", self.words(1, 2))])
            body = "".join(t("p", self.sentence(3, 40)) for _ in range(r.randint(1, 3)))
            return t(r.choice(["div", "li", "article"]), inner + body, self.mark("comment", "reply", "comment-body"))
        return [
            lambda: self.box(("comments", "responses", "discussion", "comment-list", "replies"),
                             t("h3", self.words(1, 3)) + "".join(comment() for _ in range(r.randint(1, 5)))),
            lambda: self.box(("comments", "discussion"), t("ul", "".join(comment() for _ in range(r.randint(1, 5))))),
            lambda: self.box(("related", "more", "recommended", "tags"), t("h3", self.words(1, 3)) + t("ul", self.links(2, 6))),
            lambda: self.box(("share", "author-bio", "tags"), t("p", self.sentence(3, 15))),
        ]

    def footer(self) -> str:
        t, r = self.tag, self.r
        body = r.choice(["&copy; example.net &middot; " + self.sentence(3, 30), t("p", "&copy; " + self.words(2, 12)),
                         t("ul", self.links(2, 8)), t("div", self.sentence(3, 20)) + t("p", self.words(1, 8))])
        return r.choice([t("footer", body, 'data-main="0"'), t("footer", body, 'data-main="0"'),
                         self.box(("footer", "bottom", "copyright", "legal"), body, ("div",))])

    def paragraph(self) -> str:
        r, t = self.r, self.tag
        text = self.sentence(*r.choice([(1, 4), (4, 30), (10, 80), (30, 160)]))
        if r.random() < 0.15:
            k = text.find(" ")
            text = t("a", text[:k] or text) + (text[k:] if k > 0 else "")
        shape = r.random()
        if shape < 0.15:
            return f"<p><b>{text}<br>"
        if shape < 0.2:
            return f"<p>{text}"
        if shape < 0.3:
            return t("p", t(r.choice(["b", "em", "span"]), text))
        return t("p", text)

    def article(self) -> str:
        r, t = self.r, self.tag
        parts = [t("h1", self.words(1, 12))] if r.random() < 0.85 else []
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14, 25])):
            kind = r.random()
            if kind < 0.8:
                parts.append(self.paragraph())
            elif kind < 0.87:
                parts.append(t(r.choice(["h2", "h3"]), self.words(1, 8)))
            elif kind < 0.91:
                parts.append(t(r.choice(["ul", "ol"]), "".join(t("li", self.sentence(2, 25)) for _ in range(r.randint(1, 5)))))
            elif kind < 0.94:
                parts.append(t("blockquote", self.paragraph()))
            elif kind < 0.96:
                parts.append(t("pre", self.words(3, 20)))
            elif kind < 0.98:
                parts.append(t("table", "".join(t("tr", t("td", self.words(1, 6)) * 2) for _ in range(r.randint(1, 4)))))
            elif r.random() < 0.5:
                parts.append(r.choice(self.furniture())())
        body = "".join(parts)
        if r.random() < 0.7:
            return t("article", body, (self.mark("post", "entry", "story") if r.random() < 0.3 else "") + ' data-main="1"')
        name = r.choice(["div", "section", "main", "td"])
        return t(name, body, f'{self.mark("content", "article", "post", "entry-content", "story", "body", "main-text", "text")} data-main="1"')

    def html(self) -> str:
        r = self.r
        before = [f() for f in r.sample(self.furniture(), r.randint(0, 4))]
        after = ([r.choice(self.after())()] if r.random() < 0.4 else []) + (
            [r.choice(self.furniture())()] if r.random() < 0.3 else [])
        article = self.article()
        if r.random() < 0.3:
            article = self.tag(r.choice(["main", "div"]), article + "".join(after), self.mark("main", "page", "wrap", "content"))
            after = []
        body = "".join([*before, article, *after, self.footer() if r.random() < 0.85 else ""])
        if r.random() < 0.2:
            body = self.tag("div", body, self.mark("wrap", "page", "container"))
        end = "</body></html>" if r.random() < 0.85 else ""
        return (f'<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style></head>'
                f"<body>{body}{end}")
