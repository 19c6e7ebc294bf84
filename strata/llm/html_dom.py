"""A small forgiving HTML reader: elements in page order, with their text pieces.

It knows void and raw-text elements, the implied ends of paragraphs, list
items, table parts and options, and stray or missing end tags. It runs once
over the page, whatever the page holds.
"""

from __future__ import annotations

import html
import re

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var del wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: A start tag ends an open element of these names, up to the nearest of the borders.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
#: Elements in which an open paragraph is out of reach.
P_BORDERS = frozenset({"table", "td", "th", "button", "caption", "html", "object"})

_TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                  r"|/[^a-zA-Z>][^>]*(?:>|\Z)|/>|([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z))", re.S)
_ATTR = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Dom:
    """Elements in page order, element 0 being the page itself.

    ``tag``, ``parent``, ``attrs`` (raw text) by element; ``pieces`` is the
    page's text in order: (element, text), where a text of None is a border
    between blocks.
    """

    __slots__ = ("tag", "parent", "attrs", "pieces")

    def __init__(self) -> None:
        self.tag: list[str] = ["#page"]
        self.parent: list[int] = [-1]
        self.attrs: list[str] = [""]
        self.pieces: list[tuple[int, str | None]] = []


def attributes(raw: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(raw):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


#: Each rule of implied ends: the names that are ended, and the borders that hide them.
RULES = [({"p"}, P_BORDERS), *IMPLIED.values()]
P_RULE, RULE_OF = 0, {name: n for n, name in enumerate(IMPLIED, 1)}
#: What an element of a name means to the rules: (rule, is it a border).
ROLES: dict[str, list[tuple[int, bool]]] = {}
for _n, (_ended, _borders) in enumerate(RULES):
    for _name in _ended:
        ROLES.setdefault(_name, []).append((_n, False))
    for _name in set(_borders) - set(_ended):
        ROLES.setdefault(_name, []).append((_n, True))


class _Open:
    """The open elements, with what end tags and implied ends ask for at hand.

    ``places`` has the stack places of each open name, ``blocks`` those of the
    elements that are not inline, and ``reach`` for each rule, by border, the
    places that an implied end can reach. Each is kept as elements come and go, so
    no question walks the stack.
    """

    __slots__ = ("stack", "tag", "pieces", "places", "blocks", "reach")

    def __init__(self, dom: Dom) -> None:
        self.stack, self.tag, self.pieces = [0], dom.tag, dom.pieces
        self.places: dict[str, list[int]] = {"#page": [0]}
        self.blocks = [0]
        self.reach: list[list[list[int]]] = [[[]] for _ in RULES]

    def push(self, element: int) -> None:
        name, place = self.tag[element], len(self.stack)
        self.stack.append(element)
        self.places.setdefault(name, []).append(place)
        if name not in INLINE:
            self.blocks.append(place)
        for rule, border in ROLES.get(name, ()):
            if border:
                self.reach[rule].append([])
            else:
                self.reach[rule][-1].append(place)

    def close(self, upto: int) -> None:
        """Close all elements from stack place ``upto`` on."""
        stack = self.stack
        while len(stack) > upto:
            name = self.tag[stack.pop()]
            self.places[name].pop()
            for rule, border in ROLES.get(name, ()):
                if border:
                    self.reach[rule].pop()
                else:
                    self.reach[rule][-1].pop()
            if name not in INLINE:
                self.blocks.pop()
                self.pieces.append((stack[-1] if stack else 0, None))

    def imply(self, rule: int) -> None:
        """Close the outermost element that the rule's implied end reaches."""
        places = self.reach[rule][-1]
        if places:
            self.close(places[0])


def read(page: str) -> Dom:
    dom = Dom()
    tag, parent, attrs, pieces = dom.tag, dom.parent, dom.attrs, dom.pieces
    held = _Open(dom)
    stack, places = held.stack, held.places

    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            pieces.append((stack[-1], page[at:start]))
        if start == size:
            break
        found = _TAG.match(page, start)
        if found is None:  # a "<" that begins no tag
            pieces.append((stack[-1], "<"))
            at = start + 1
            continue
        at = found.end()
        if found[1]:
            name = found[1].lower()
            if name == "br":
                pieces.append((stack[-1], "\n"))
            elif places.get(name):
                k = places[name][-1]
                if name not in INLINE or held.blocks[-1] < k:  # no inline end tag ends a block
                    held.close(k)
            continue
        if not found[2]:
            continue
        name = found[2].lower()
        if name in ENDS_P:
            held.imply(P_RULE)
        if name in RULE_OF:
            held.imply(RULE_OF[name])
        if name not in INLINE:
            pieces.append((stack[-1], "\n" if name == "br" else None))
        me = len(tag)
        tag.append(name)
        parent.append(stack[-1])
        attrs.append(found[3] or "")
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at) if name != "plaintext" else None
            if name in ("textarea", "title"):
                pieces.append((me, page[at:end.start() if end else size]))
            at = end.end() if end else size
            if name not in INLINE:
                pieces.append((stack[-1], None))
            continue
        if (found[3] or "").endswith("/") and name in ("svg", "path", "use"):
            continue
        held.push(me)
    return dom
