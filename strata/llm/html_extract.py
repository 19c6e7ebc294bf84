"""Main text of web pages: boosted trees over the elements, decoded along the tree.

Method. Every block element, and every inline element whose names tell
something, is described by its tag, attribute tokens, text and link density of
its subtree, depth, siblings and place in the page. Gradient-boosted trees give
the probability that it holds main text. The decoding takes the most likely
labelling of the whole tree in which nothing under a rejected element is kept:
for each element, the best of "rejected, with all below it" and "kept, each
child as is best for it". Scripts, styles, form controls and the like are never
text.

The trees are trained on ``TRAIN_PAGES`` generated pages of random layouts (see
``html_templates``); nothing is learned from the table.

The kept elements' text is put together in page order: character references are
decoded, white space runs within a block become one space, blocks are trimmed
and joined by one space.

Defined cases: a null page, an empty one and one without kept text give the
empty text; text outside any element is kept; repeated rows give the same text;
empty tables and further columns of any name are taken as they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.boosting import Trees, boost
from strata.llm.common import slices
from strata.llm.html_dom import INLINE, Dom, attributes, read
from strata.llm.html_templates import labelled_pages

TRAIN_PAGES = 2000
SEED = 41

# Elements whose text is never main text, groups of tags, and
# words in class, id, role and the like that name a part of a page.
NEVER = frozenset("script style noscript template head title textarea select option button input iframe object embed "
                  "applet audio video canvas svg math map datalist dialog noembed noframes link meta base".split())
TAGS = [x.split() for x in (
    "nav", "header", "footer", "aside", "article", "main", "section", "div center", "p", "h1 h2 h3 h4 h5 h6", "ul ol dl menu",
    "li dt dd", "table tbody thead tfoot", "tr td th caption", "form fieldset label legend", "figure figcaption picture img",
    "pre blockquote", "#page html body", "ins", "address details summary")]
FAMILIES = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toolbar toc skip menubar",
    "header": "header masthead topbar logo branding banner",
    "footer": "footer foot bottom copyright colophon legal contentinfo",
    "sidebar": "sidebar side rail widget widgets related recommended trending popular tagcloud cloud complementary aside",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog subscribe newsletter signup paywall notification privacy",
    "advert": "ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promoted promotion dfp adslot",
    "form": "form search login field input searchbox",
    "comment": "comment comments commentlist disqus discussion reply replies respond reviews commentary",
    "share": "share social sharing follow sharebar",
    "content": "article post entry content story body text main prose articlebody maincontent hentry",
}
_FAMILY = {w: i for i, words in enumerate(FAMILIES.values()) for w in words.split()}
_STEMS = [(w, i) for w, i in _FAMILY.items() if len(w) >= 6]
_TAG = {t: i for i, group in enumerate(TAGS) for t in group}
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
N_FAMILIES = len(FAMILIES)
#: Tags whose presence above an element is a feature.
_SECTIONS = [_TAG[t] for t in "nav header footer aside article main form li table".split()]
_PUNCTUATION = re.compile(r"[.,;!?:。，、]")


def families(raw: str, known: dict[str, tuple]) -> tuple[tuple[int, ...], bool]:
    """Families named by a start tag's attributes, and whether it is hidden."""
    out = known.get(raw)
    if out is None:
        a = attributes(raw)
        found = set()
        for key in ("class", "id", "role", "itemprop", "aria-label"):
            for word in _TOKEN.findall(a.get(key, "")):
                word = word.lower()
                if word in _FAMILY:
                    found.add(_FAMILY[word])
                else:
                    found |= {i for stem, i in _STEMS if stem in word}
        hidden = "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDDEN.search(a.get("style", "")))
        out = (tuple(found), hidden)
        if len(known) > 50_000:
            known.clear()
        known[raw] = out
    return out


class Units:
    """The elements of a page that are decided on: their tree and their features."""

    __slots__ = ("of", "parent", "x", "element")

    def __init__(self, dom: Dom, known: dict[str, tuple]) -> None:
        n = len(dom.tag)
        of, never, link = [0] * n, [False] * n, [False] * n
        element, parent, told = [], [], []
        for e in range(n):
            tag, up = dom.tag[e], dom.parent[e]
            found = families(dom.attrs[e], known) if dom.attrs[e] else ((), False)
            if e:
                never[e] = tag in NEVER or never[up]
                link[e] = tag == "a" or link[up]
            if e == 0 or tag not in INLINE or found[0] or found[1] or tag == "ins":
                of[e] = len(element)
                parent.append(of[up] if e else -1)
                element.append(e)
                told.append(found)
            else:
                of[e] = of[up]
        m = len(element)
        own = np.zeros((m, 6))  # characters, words, link characters, punctuation, pieces, marks of rights
        place = np.full(m, -1.0)
        done = 0
        for e, text in dom.pieces:
            if text is None or never[e]:
                continue
            size = len(text) - text.count(" ") - text.count("\n")
            if not size:
                continue
            u = of[e]
            row = own[u]
            row[0] += size
            row[1] += text.count(" ") + 1
            row[2] += size if link[e] else 0
            row[3] += len(_PUNCTUATION.findall(text))
            row[4] += 1
            row[5] += "©" in text or "&copy" in text
            if place[u] < 0:
                place[u] = done
            done += size
        total = own.copy()
        below, children, depth = np.zeros(m), np.zeros(m), np.zeros(m)
        index, same, longest, paragraphs = np.zeros(m), np.zeros(m), own[:, 1].copy(), np.zeros(m)
        up_names, up_tags = np.zeros((m, N_FAMILIES)), np.zeros((m, len(TAGS)))
        names, tags, hidden = np.zeros((m, N_FAMILIES)), np.zeros((m, len(TAGS))), np.zeros(m)
        counts: dict[tuple[int, str], int] = {}
        for u in range(m):
            tag, p = dom.tag[element[u]], parent[u]
            if tag in _TAG:
                tags[u, _TAG[tag]] = 1
            for i in told[u][0]:
                names[u, i] = 1
            hidden[u] = told[u][1]
            if p >= 0:
                depth[u] = depth[p] + 1
                index[u] = children[p]
                children[p] += 1
                np.maximum(up_names[p], names[p], out=up_names[u])
                np.maximum(up_tags[p], tags[p], out=up_tags[u])
                key = (p, tag)
                same[u] = counts[key] = counts.get(key, 0) + 1
                paragraphs[p] += tag == "p"
        for u in range(m - 1, 0, -1):
            p = parent[u]
            total[p] += total[u]
            below[p] += below[u] + 1
            if longest[u] > longest[p]:
                longest[p] = longest[u]
            if place[u] >= 0 and (place[p] < 0 or place[u] < place[p]):
                place[p] = place[u]
        up = np.maximum(np.array(parent), 0)
        chars = total[:, 0]
        page = max(chars[0], 1.0)
        share = lambda a, b: a / np.maximum(b, 1.0)
        log = np.log1p
        density = share(total[:, 2], chars)
        siblings = children[up]
        same_all = np.array([counts.get((parent[u], dom.tag[element[u]]), 0) for u in range(m)], dtype=float)
        # a text piece's place is known from its first character, an empty element's is not
        start = np.where(place >= 0, place / page, -1)
        self.of, self.parent, self.element = of, parent, element
        self.x = np.column_stack([
            tags, names, up_names, up_tags[:, _SECTIONS], hidden, depth, siblings, index, share(index, siblings), same, same_all,
            log(chars), log(total[:, 1]), density, log(own[:, 0]), children, log(below), share(below, total[:, 1]),
            share(total[:, 3], total[:, 1]), share(total[:, 1], total[:, 4]), chars / page, start, density[up],
            log(chars[up]), share(chars, chars[up]), paragraphs, paragraphs[up], log(longest), total[:, 5], names.sum(axis=1),
            share(own[:, 2], own[:, 0]), log(children[up]),
        ]).astype(np.float32)


def decode(parent: list[int], logit: np.ndarray) -> list[bool]:
    """The most likely labels in which an element is kept only if its parent is.

    Element 0 (the page) is kept. Sums of log-likelihoods from the leaves up:
    ``off`` rejects a subtree, ``on`` keeps its root.
    """
    on = -np.logaddexp(0, -logit)
    off = -np.logaddexp(0, logit)
    on, off = on.tolist(), off.tolist()
    for u in range(len(parent) - 1, 0, -1):
        p = parent[u]
        on[p] += max(on[u], off[u])
        off[p] += off[u]
    keep = [True] * len(parent)
    for u in range(1, len(parent)):
        keep[u] = keep[parent[u]] and on[u] > off[u]
    return keep


def _never(dom: Dom) -> list[bool]:
    out = [False] * len(dom.tag)
    for e in range(1, len(out)):
        out[e] = dom.tag[e] in NEVER or out[dom.parent[e]]
    return out


def join_text(dom: Dom, keep: list[bool], of: list[int]) -> str:
    """Text of the kept elements: blocks in page order."""
    never, parts = _never(dom), []
    for e, text in dom.pieces:
        if text is None:
            parts.append("\n")
        elif keep[of[e]] and not never[e]:
            # each piece by itself: a reference doesn't reach over a tag
            parts.append(html.unescape(text) if "&" in text else text)
    return " ".join("".join(parts).split())


def train(pages: int = TRAIN_PAGES, seed: int = SEED) -> Trees:
    """The model, fitted on generated pages."""
    xs, ys, known = [], [], {}
    for page in labelled_pages(pages, seed):
        dom = read(page)
        units = Units(dom, known)
        for u in range(1, len(units.element)):
            raw = dom.attrs[units.element[u]]
            if 'data-y="' in raw:
                ys.append(raw.split('data-y="')[1][0] == "1")
                xs.append(units.x[u])
    return boost(np.array(xs, dtype=np.float32), np.array(ys, dtype=float))


def main_texts(model: Trees, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    doms, units, known = [], [], {}
    for page in pages:
        dom = read(page or "")
        doms.append(dom)
        units.append(Units(dom, known))
    logits = model.logits(np.concatenate([u.x for u in units])) if units else np.zeros(0)
    out, at = [], 0
    for dom, unit in zip(doms, units, strict=True):
        n = len(unit.element)
        out.append(join_text(dom, decode(unit.parent, logits[at:at + n]), unit.of))
        at += n
    return out


def _extractor(model: Broadcast, keep: list[str]) -> Callable:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*model.value)
        for batch in slices(batches, "__llm_html"):
            texts = main_texts(trees, batch.column("__llm_html").to_pylist())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    return extract


def extract(spark: SparkSession, pages: DataFrame, model: Trees, *keep: Column, column: str = "html") -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of each page. No shuffle."""
    rows = pages.select(*keep, F.col(f"`{column}`").cast("string").alias("__llm_html"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    shared = spark.sparkContext.broadcast((model.feature, model.threshold, model.leaf, model.base))
    return rows.mapInArrow(_extractor(shared, rows.columns[:-1]), schema + "text string")
