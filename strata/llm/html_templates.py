"""Labelled pages to train the extraction model on: random layouts of random words.

Each element carries its label in ``data-y``: 1 if it holds main text (or wraps
an element that does), 0 if all of it is to go. The words are random letters in
several scripts, so the model learns layout, not language.
"""

from __future__ import annotations

import random

# Names that page authors commonly give to parts of a page.
NAMES = {
    "menu": "nav navbar main-nav menu top-menu site-navigation breadcrumb breadcrumbs pagination pager tabs skip-links",
    "header": "header site-header masthead topbar page-header logo branding",
    "footer": "footer site-footer page-footer bottom copyright colophon foot legal",
    "sidebar": "sidebar side-bar right-rail widget widget-area related related-posts recommended trending popular tag-cloud",
    "notice": "cookie cookie-banner cookie-notice consent gdpr notice alert popup modal overlay subscribe newsletter signup paywall",
    "advert": "ad ads advert advertisement ad-slot adsbygoogle sponsor sponsored promo promotion top-ad dfp",
    "comment": "comments comment-list comment discussion replies respond disqus reader-comments",
    "share": "share social social-share sharing follow-us",
    "content": "article post entry-content post-content content story article-body main-content post-body text",
    "neutral": "container wrapper row col col-md-8 inner box block module grid x1 clearfix section panel outer",
}
ALPHABETS = ("abcdefghilmnoprstuvy", "абвгдеиклмнопрстуя", "aeioumnprstlkéèçñöüß", "日本語文章漢字中国人大小上下")


class _Page:
    def __init__(self, rng: random.Random) -> None:
        self.r, self.letters = rng, rng.choice(ALPHABETS)
        self.noise = rng.random() < 0.15  # a page without telling names
        self.close_p = rng.random() < 0.7

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = ["".join(r.choices(self.letters, k=r.randrange(1, 10))) for _ in range(r.randrange(low, high + 1))]
        for i in range(len(out)):
            if r.random() < 0.12:
                out[i] += r.choice(",.;!?")
        if r.random() < 0.03:
            out = [w + r.choice(["***", "&amp;&amp;", " |", "!!", "###"]) for w in out]
        return " ".join(out)

    def sentence(self, low: int, high: int) -> str:
        text = self.words(low, high)
        return text[:1].upper() + text[1:] + self.r.choice([".", ".", ".", "!", "", "?"])

    def attrs(self, kind: str, y: int, chance: float = 0.85) -> str:
        r, out = self.r, f' data-y="{y}"'
        if r.random() < chance:
            name = r.choice(NAMES["neutral" if self.noise and r.random() < 0.8 else kind].split())
            if r.random() < 0.3:
                name += " " + r.choice(NAMES["neutral"].split())
            out += f' {r.choice(["class", "class", "id"])}="{name}"'
        return out

    def links(self, low: int, high: int, y: int = 0) -> str:
        r = self.r
        items = [f'<a href="/{self.words(1, 1)}">{self.words(1, 4)}</a>' for _ in range(r.randrange(low, high + 1))]
        if r.random() < 0.7:
            end = "</li>" if r.random() < 0.8 else ""
            return f'<ul data-y="{y}">' + "".join(f'<li data-y="{y}">{x}{end}' for x in items) + "</ul>"
        return r.choice([" | ", " ", " &middot; "]).join(items)

    def wrap(self, tags: str, kind: str, inner: str, y: int = 0, chance: float = 0.85) -> str:
        """One of the tags; a tag without a meaning of its own always gets a name."""
        tag = self.r.choice(tags.split())
        if tag in ("div", "section", "ul"):
            chance = max(chance, 0.9)
        return f"<{tag}{self.attrs(kind, y, chance)}>{inner}</{tag}>"

    def menu(self) -> str:
        return self.wrap("nav nav div", "menu", self.links(3, 12), chance=0.4)

    def advert(self) -> str:
        r = self.r
        inner = r.choice([self.sentence(3, 25), f'<a href="#">{self.words(3, 12)}</a>', '<img src="a.png">' + self.sentence(2, 8),
                          f'<p data-y="0">{self.sentence(4, 20)}</p><a href="#">{self.words(1, 3)}</a>'])
        return self.wrap("div div div ins aside", "advert", inner, chance=1)

    def notice(self) -> str:
        button = f'<button data-y="0">{self.words(1, 2)}</button>' if self.r.random() < 0.6 else ""
        inner = f'<p data-y="0">{self.sentence(5, 40)}</p>{button}' if self.r.random() < 0.6 else self.sentence(5, 40) + button
        role = self.r.choice(["", ' role="alert"', ' role="dialog"'])
        return self.wrap("div div section aside", "notice", inner, chance=1).replace(' data-y="0"', f' data-y="0"{role}', 1)

    def form(self) -> str:
        inner = f'<label data-y="0">{self.words(1, 6)}</label><input name="q"><button data-y="0">{self.words(1, 3)}</button>'
        if self.r.random() < 0.4:
            inner = f'<p data-y="0">{self.sentence(3, 25)}</p>' + inner
        return f'<form action="/"{self.attrs("notice", 0, 0.4)}>{inner}</form>'

    def comments(self) -> str:
        one = lambda: self.wrap("div li article div", "comment", (
            f'<b>{self.words(1, 2)}</b> ' if self.r.random() < 0.6 else "") + f'<p data-y="0">{self.sentence(5, 80)}</p>', chance=0.95)
        head = f'<h3 data-y="0">{self.words(1, 4)}</h3>' if self.r.random() < 0.6 else ""
        return self.wrap("section div div ol", "comment", head + "".join(one() for _ in range(self.r.randrange(1, 7))), chance=1)

    def sidebar(self) -> str:
        parts = []
        for _ in range(self.r.randrange(1, 5)):
            part = f'<h3 data-y="0">{self.words(1, 4)}</h3>' if self.r.random() < 0.7 else ""
            part += self.r.choice([self.links(3, 8), f'<p data-y="0">{self.sentence(5, 40)}</p>', self.form()])
            parts.append(self.wrap("div section div", "sidebar", part, chance=0.7))
        return self.wrap("aside aside div", "sidebar", "".join(parts), chance=0.6)

    def header(self) -> str:
        name = self.words(1, 4)
        if self.r.random() < 0.4:
            tag = self.r.choice(["h1", "h2", "h3", "p", "div"])
            name = self.r.choice([name, f'<a href="/">{name}</a>'])
            parts = [f'<{tag} data-y="0">{name}</{tag}>']
        else:
            parts = [f'<a href="/">{name}</a>']
        if self.r.random() < 0.5:
            parts.append(f'<p data-y="0">{self.sentence(2, 10)}</p>')
        if self.r.random() < 0.6:
            parts.append(self.menu())
        if self.r.random() < 0.3:
            parts.append(self.form())
        return self.wrap("header header div", "header", "".join(parts), chance=0.5)

    def footer(self) -> str:
        mark = self.r.choice(["&copy; ", "© ", "", "&copy; "]) + self.words(1, 4)
        rest = self.r.choice([" &middot; " + self.sentence(2, 30), f'<p data-y="0">{self.sentence(3, 30)}</p>', self.links(2, 10), "\n" + self.sentence(2, 20)])
        return self.wrap("footer footer div", "footer", mark + rest, chance=0.5)

    def paragraph(self, low: int = 1, high: int = 140) -> str:
        r = self.r
        text = self.sentence(low, r.choice([12, 40, high]))
        if r.random() < 0.3:
            words = text.split(" ")
            i = r.randrange(len(words))
            tag = r.choice(["b", "i", "em", "strong", "span", 'a href="/x"'])
            words[i] = f"<{tag}>{words[i]}</{tag.split()[0]}>"
            text = " ".join(words)
        if r.random() < 0.12:
            text = "<b>" + text + "<br>"  # left open
        elif r.random() < 0.1:
            text += "<br>" + self.sentence(3, 40)
        return f'<p data-y="1">{text}' + ("</p>" if self.close_p and r.random() < 0.95 else "")

    def article(self) -> str:
        r, parts = self.r, []
        if r.random() < 0.75:
            head = f'<h1 data-y="1">{self.words(1, 14)}</h1>'
            parts.append(f'<header data-y="1">{head}</header>' if r.random() < 0.15 else head)
        loose = r.random() < 0.1  # text straight in the container
        for _ in range(r.choice([0, 1, 1, 2, 2, 4, 8, 15])):
            roll = r.random()
            if loose:
                parts.append(self.sentence(5, 80) + "<br>")
            elif roll < 0.74:
                parts.append(self.paragraph())
            elif roll < 0.8:
                parts.append(f'<h2 data-y="1">{self.words(1, 9)}</h2>')
            elif roll < 0.85:
                parts.append('<ul data-y="1">' + "".join(f'<li data-y="1">{self.sentence(1, 25)}</li>' for _ in range(r.randrange(1, 7))) + "</ul>")
            elif roll < 0.88:
                parts.append(f'<blockquote data-y="1"><p data-y="1">{self.sentence(3, 50)}</p></blockquote>')
            elif roll < 0.91:
                parts.append('<table data-y="1">' + "".join(f'<tr data-y="1"><td data-y="1">{self.words(1, 4)}</td><td data-y="1">{self.words(1, 9)}</td></tr>' for _ in range(r.randrange(1, 5))) + "</table>")
            elif roll < 0.93:
                parts.append(f'<pre data-y="1">{self.words(2, 40)}</pre>')
            elif roll < 0.95:
                parts.append(f'<div data-y="1">{self.sentence(5, 60)}</div>')
            elif roll < 0.97:
                parts.append(f'<figure data-y="1"><img src="i.jpg"><figcaption data-y="1">{self.sentence(2, 20)}</figcaption></figure>')
            else:
                parts.append(r.choice([self.advert, self.notice, self.form])())
        if not any(p for p in parts):
            parts.append(self.paragraph(1, 60))
        if r.random() < 0.2:
            parts.append(self.wrap("div ul section", "share", self.links(2, 6), chance=1))
        if r.random() < 0.15:
            parts.append(self.wrap("div section aside", "sidebar", f'<h3 data-y="0">{self.words(1, 4)}</h3>' + self.links(2, 7), chance=1))
        if r.random() < 0.12:
            parts.append(self.comments())
        body = "".join(parts)
        tag = r.choice(["article"] * 5 + ["div", "div", "section", "main"])
        return f'<{tag}{self.attrs("content", 1, 0.35 if tag in ("article", "main") else 0.85)}>{body}</{tag}>'

    def html(self) -> str:
        r, some = self.r, lambda p, f: [f()] if self.r.random() < p else []
        article = self.article()
        middle = some(0.15, self.menu) + some(0.25, self.advert) + [article] + some(0.2, self.comments) + some(0.2, self.advert)
        if r.random() < 0.3:
            middle = some(0.5, self.sidebar) + middle if r.random() < 0.4 else middle + some(0.9, self.sidebar)
        inner = "".join(middle)
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            tag = r.choice(["div", "div", "main", "section"])
            inner = f'<{tag}{self.attrs(r.choice(["neutral", "neutral", "content"]), 1, 0.7)}>{inner}</{tag}>'
        before = some(0.5, self.header) + some(0.5, self.menu) + some(0.2, self.notice) + some(0.4, self.advert)
        r.shuffle(before)
        body = "".join(["<!-- x -->" if r.random() < 0.2 else "", *before, inner, *some(0.15, self.form), *some(0.75, self.footer), *some(0.12, self.notice)])
        if r.random() < 0.04:
            return self.article()  # a fragment
        end = "</body></html>" if r.random() < 0.85 else ""
        return (f'<!DOCTYPE html><html data-y="1"><head data-y="0"><meta charset="utf-8"><title data-y="0">{self.words(1, 12)}</title>'
                f'<style>p{{margin:0}}</style><script>var t="</p>";</script></head><body data-y="1">{body}{end}')


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` pages; the same for the same seed."""
    rng = random.Random(seed)
    return [_Page(rng).html() for _ in range(n)]
