"""Labelled pages to learn content from: layouts drawn from common page parts.

Every page is put together from parts (menus, headers, adverts, notices, side columns,
forms, comments, footers and one article) under varied tags, class names, orders and
lengths. The words are drawn syllables, so nothing is learned about a language. The
attribute ``data-label="1"`` marks the top of a part that is content, ``0`` of one that is
not; everything below has the label of the nearest marked element.
"""

from __future__ import annotations

import random

SYLLABLES = "an ar be ca den dor el en er fa ga hin ing is ka la len lo mar mi na nor o pel ra ren sa ta ter un vi".split()

# Names that pages commonly give their parts.
MENU = "nav navbar main-nav menu top-menu site-nav navigation mainMenu breadcrumb breadcrumbs pagination pager toc-nav".split()
HEADER = "header site-header masthead top-bar page-header banner logo topbar head brand".split()
FOOTER = "footer site-footer page-footer bottom foot colophon copyright legal credits".split()
SIDE = "sidebar side aside widget right-column left-column related recommended widget-area popular trending rail".split()
ADVERT = "ad ads advert advertisement ad-slot sponsored sponsor promo banner-ad adsense promotion partner".split()
NOTICE = "cookie cookie-notice consent notice alert gdpr popup modal privacy-banner message overlay announcement".split()
FORM = "search login subscribe newsletter signup contact-form form searchbox register".split()
SOCIAL = "share social sharing share-buttons follow social-links tags meta-links".split()
COMMENTS = "comments comment-list comment discussion replies reply disqus responses feedback user-comments".split()
ARTICLE = "article post entry content story post-content entry-content article-body main-content text body-text".split()
NEUTRAL = "wrapper container row col inner page site block box section group layout".split()


class _Writer:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 3)))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most)))

    def sentence(self, least: int = 4, most: int = 18) -> str:
        text = self.words(least, most).capitalize()
        if self.rng.random() < 0.05:
            text = text.replace(" ", self.rng.choice([" | ", ", ", " &amp; ", "&nbsp;", " - "]))
        return text + self.rng.choice(["."] * 12 + ["?", "!", "", " |"])

    def prose(self, least: int = 1, most: int = 6) -> str:
        draw = self.rng.random()
        if draw < 0.04:
            return " ".join([self.word()] * self.rng.randint(2, 60 * most))
        if draw < 0.08:
            return self.words(3, 40 * most)
        text = " ".join(self.sentence() for _ in range(self.rng.randint(least, most)))
        if self.rng.random() < 0.2:
            text += f' <a href="#">{self.words(1, 3)}</a> ' + self.sentence()
        if self.rng.random() < 0.2:
            text = f"<b>{self.words(1, 4)}</b> " + text
        return text

    def names(self, choices: list[str]) -> str:
        """A class or an id, or neither."""
        draw = self.rng.random()
        if draw < 0.65:
            return f' class="{self.rng.choice(choices)}"'
        if draw < 0.8:
            return f' id="{self.rng.choice(choices)}"'
        if draw < 0.9:
            return f' class="{self.rng.choice(NEUTRAL)} {self.rng.choice(choices)}"'
        return ""

    def box(
        self, tags: str, choices: list[str], inner: str, label: int, needs_name: tuple[str, ...] = ("div", "section")
    ) -> str:
        tag = self.rng.choice(tags.split())
        name = self.names(choices)
        if not name and tag in needs_name:
            name = f' class="{self.rng.choice(choices)}"'
        return f'<{tag}{name} data-label="{label}">{inner}</{tag}>'

    def some(self, shares: dict) -> list[str]:
        """Each part with its share as probability, in the order given."""
        return [part() for part, share in shares.items() if self.rng.random() < share]

    def links(self, least: int = 2, most: int = 9) -> str:
        rows = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.rng.randint(least, most))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{r}</li>" for r in rows) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(rows)

    def menu(self) -> str:
        return self.box("nav nav div ul div", MENU, self.links(), 0)

    def header(self) -> str:
        link = f"<a href='/'>{self.words(1, 3)}</a>"
        inner = self.rng.choice([link, f"<p>{self.words(2, 6)}</p>", f"<div>{self.words(1, 4)}</div>"])
        return self.box("header header div", HEADER, inner + (self.menu() if self.rng.random() < 0.4 else ""), 0)

    def footer(self) -> str:
        inner = self.rng.choice(
            [
                f"&copy; {self.word()}.example.com &middot; {self.sentence()}",
                f"<p>&copy; 20{self.rng.randint(10, 30)} {self.words(1, 4)}</p>{self.links(2, 5)}",
                f"<p>{self.prose(1, 2)}</p>",
                self.links(2, 6),
            ]
        )
        return self.box("footer footer footer div", FOOTER, inner, 0)

    def side(self) -> str:
        title = "<h{0}>{1}</h{0}>".format(self.rng.choice([2, 3, 3, 4]), self.words(1, 3))
        short = self.links(1, 3) + f"<p>{self.sentence()}</p>"
        inner = title + self.rng.choice([self.links(), f"<p>{self.prose(1, 3)}</p>", short])
        return self.box("aside aside div section", SIDE, inner, 0, ("div", "section"))

    def advert(self) -> str:
        titled = f"<h4>{self.words(2, 4)}</h4><p>{self.sentence()}</p>"
        link = f"<a href='#'>{self.words(2, 6)}</a>"
        inner = self.rng.choice([self.sentence(), f"<p>{self.prose(1, 3)}</p>", link, titled])
        return self.box("div div section aside p", ADVERT, inner, 0, ("div", "section", "p"))

    def notice(self) -> str:
        button = f"<p>{self.prose(1, 3)}</p><button>{self.word()}</button>"
        link = f"<p>{self.sentence()} <a href='#'>{self.words(1, 2)}</a></p>"
        inner = self.rng.choice([self.prose(1, 2), button, link])
        role = self.rng.choice(["", "", ' role="alert"', ' role="dialog"', ' style="display:none"', " hidden"])
        return self.box("div div section p", NOTICE, inner, 0, ("div", "section", "p")).replace(" data-label", role + " data-label", 1)

    def form(self) -> str:
        inner = f"<label>{self.words(1, 3)}</label><input name='q'><p>{self.sentence()}</p><button>{self.word()}</button>"
        if self.rng.random() < 0.5:
            return f'<form{self.names(FORM)} data-label="0">{inner}</form>'
        return self.box("div section", FORM, f"<form>{inner}</form>", 0)

    def social(self) -> str:
        return self.box("div ul div", SOCIAL, self.links(2, 5), 0, ("div", "ul"))

    def comments(self) -> str:
        rows = []
        for _ in range(self.rng.randint(1, 5)):
            inner = f"<p>{self.words(1, 2)}</p><p>{self.prose(1, 4)}</p>"
            name = self.rng.choice(["comment", "reply", "comment-body"])
            rows.append(self.rng.choice([f'<div class="{name}">{inner}</div>', f"<li>{inner}</li>", f"<li>{inner}</li>"]))
            if self.rng.random() < 0.1:
                rows[-1] = f"<article>{inner}</article>"
        return self.box("section div div ol", COMMENTS, f"<h3>{self.words(1, 2)}</h3>" + "".join(rows), 0, ("div", "section", "ol"))

    def body(self) -> str:
        rng, parts = self.rng, []
        if rng.random() < 0.8:
            title = f"<h1>{self.words(2, 12)}</h1>"
            parts.append(f"<header>{title}</header>" if rng.random() < 0.1 else title)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 8, 12])):
            draw = rng.random()
            if draw < 0.72:
                parts.append(f"<p>{self.prose()}</p>" if rng.random() < 0.85 else f"<p>{self.words(1, 3).capitalize()}.</p>")
            elif draw < 0.78:
                parts.append("<ul>" + "".join(f"<li>{self.sentence(2, 10)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif draw < 0.84:
                parts.append("<h{0}>{1}</h{0}>".format(rng.choice([2, 2, 3, 4]), self.words(1, 6)))
            elif draw < 0.88:
                parts.append(f"<blockquote><p>{self.prose(1, 2)}</p></blockquote>")
            elif draw < 0.91:
                parts.append(f"<pre>{self.words(3, 20)}</pre>")
            elif draw < 0.94:
                parts.append("<table><tr>" + "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3)) + "</tr></table>")
            elif draw < 0.97:
                parts.append(f"<figure><figcaption>{self.sentence()}</figcaption></figure>")
            else:
                parts.append(f"<div>{self.prose(1, 3)}</div>")
        inside = {self.advert: 0.2, self.social: 0.15, self.side: 0.1, self.notice: 0.05, self.form: 0.05}
        for extra in self.some(inside):
            parts.insert(rng.randint(1, len(parts)), extra)
        if rng.random() < 0.1:
            parts.append(self.comments())
        return "".join(parts)

    def article(self) -> str:
        draw = self.rng.random()
        if draw < 0.45:
            return f'<article{self.names(ARTICLE)} data-label="1">{self.body()}</article>'
        if draw < 0.6:
            return f'<main{self.names(ARTICLE)} data-label="1">{self.body()}</main>'
        if draw < 0.9:
            return self.box("div section div", ARTICLE, self.body(), 1)
        if draw < 0.95:
            return f'<div role="main" data-label="1">{self.body()}</div>'
        return f'<table><tr><td data-label="0">{self.links()}</td><td data-label="1">{self.body()}</td></tr></table>'

    def page(self) -> str:
        rng = self.rng
        if rng.random() < 0.04:
            return f'<div data-label="1">{self.body()}</div>'
        before = self.some({self.notice: 0.25, self.header: 0.5, self.menu: 0.7, self.form: 0.15, self.advert: 0.35})
        if rng.random() < 0.3:
            rng.shuffle(before)
        ends = {self.side: 0.35, self.social: 0.2, self.comments: 0.4, self.form: 0.2, self.advert: 0.2, self.notice: 0.15}
        after = self.some(ends | {self.footer: 0.85})
        main = self.article()
        if rng.random() < 0.3:
            if after and rng.random() < 0.5:
                main += after.pop(0)
            main = f"<div{self.names(NEUTRAL)}>{main}</div>"
        inner = "".join(before) + main + "".join(after)
        if rng.random() < 0.3:
            inner = f"<div{self.names(NEUTRAL)}>{inner}</div>"
        return f"<html><head><title>{self.words(2, 5)}</title></head><body>{inner}</body></html>"


def pages(count: int, seed: int = 11) -> list[str]:
    writer = _Writer(seed)
    return [writer.page() for _ in range(count)]
