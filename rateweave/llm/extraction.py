"""Main text of web pages by scoring the element tree.

Every text block passes points for its length and commas to the elements
around it, fewer the farther up; an element's points are discounted by the
share of its text that lies in links.  The best element and those of its
siblings that score or read like it are kept.
"""

from __future__ import annotations

import html
import re
from bisect import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, with_fields

TOKEN = re.compile(
    r"<!--(?:.*?(?:-->|--!>)|.*)"                    # a comment, also one without an end
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|)|[\"'])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"                          # declarations and stray ends
    r"|<[a-zA-Z].*+\Z", re.S)                         # a tag cut off by the end of the page
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that hold no article text.
NEVER = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map noembed noframes xmp "
    "nav aside footer form button select textarea input datalist menu dialog search title".split())
NOT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form "
    "tablist tooltip status".split())
#: Words in class and id names of what surrounds an article, or names a part of one.
PARTS = frozenset(
    "alert announcement aside banner banners copyright disclaimer discussion feedback footer form header hidden leaderboard "
    "legal menu menus overlay popular promotion rail recommendations recommended related responses reviews search skip social "
    "subscription tags toc trending widget widgets".split())
#: Words in class and id names of what surrounds an article.
AROUND = PARTS | frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner banners sponsor sponsored sponsors "
    "promo promos promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars sidenav "
    "aside rail widget widgets footer header masthead topbar toolbar cookie cookies consent gdpr notice notices alert "
    "popup popups modal overlay newsletter subscribe subscription signup login paywall share sharing social related "
    "recommended recommendations trending popular comment comments commentlist disqus discussion replies reply respond "
    "responses reviews pagination pager tags taglist skip hidden copyright disclaimer legal form search searchbox "
    "announcement outbrain taboola adsbygoogle skyscraper leaderboard colophon dropdown notification notifications "
    "feedback toc".split())
#: Words that tell of the article itself.
ARTICLE = frozenset("article main content story entry post body text prose".split())
#: Class names with one of these words speak of the page's layout ("has-sidebar").
LAYOUT = frozenset("has with no without open enabled layout".split())
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Points for an element that is marked as the article.
HOLDER = 25.0
NAME_PARTS = re.compile(r"[a-z]+(?=[A-Z])|[A-Z]?[a-z]+|[A-Z]+")
CLOSES = {  # an open element of the value ends where one of the key begins
    **{name: frozenset({"p"}) for name in BLOCK - {"html", "body", "head", "option", "optgroup", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}},
    "li": frozenset({"li", "p"}), "dt": frozenset({"dt", "dd", "p"}), "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}), "td": frozenset({"td", "th", "p"}), "th": frozenset({"td", "th", "p"}),
    "tbody": frozenset({"tbody", "thead", "tr", "td", "th", "p"}), "tfoot": frozenset({"tbody", "thead", "tr", "td", "th", "p"}),
    "option": frozenset({"option"}), "optgroup": frozenset({"option", "optgroup"}), "body": frozenset({"head"}),
}
#: Ends that are implied do not reach beyond these.
SCOPE = frozenset("table ul ol dl div section article main body html td th aside nav header footer form blockquote".split())
#: Elements below this depth are not opened: their text belongs to the one at this depth.
DEPTH = 256


class Below:
    """The open elements below DEPTH, of which only names and off marks count."""

    def __init__(self):
        self.open, self.places, self.hidden, self.forms = [], {}, 0, []

    def push(self, node: Element) -> None:
        self.places.setdefault(node.name, []).append(len(self.open))
        self.open.append(node)
        self.hidden += node.off
        if node.name == "form" and node.off:
            self.forms.append(node)

    def cut(self, size: int) -> None:
        while len(self.open) > size:
            node = self.open.pop()
            self.places[node.name].pop()
            self.hidden -= node.off
            node.off = False

    def last(self, names) -> int:
        """The place of the innermost of these elements, -1 for none."""
        return max((self.places[x][-1] for x in names if self.places.get(x)), default=-1)

    def first(self, names, after: int) -> int:
        """The place of the outermost of these elements behind a place, or -1."""
        got = [p[bisect(p, after)] for x in names if (p := self.places.get(x)) and p[-1] > after]
        return min(got, default=-1)

    def show_forms(self) -> None:
        for node in self.forms:
            self.hidden -= node.off
            node.off = False
        self.forms = []


class Element:
    __slots__ = ("name", "parent", "items", "off", "favour", "part", "chars", "linked", "score")

    def __init__(self, name, parent, off=False, favour=0.0, part=False):
        self.name, self.parent, self.off, self.favour, self.part = name, parent, off, favour, part
        self.items, self.chars, self.linked, self.score = [], 0, 0, 0.0


def surrounds(name: str, attributes: str, parent: Element, named: bool = True) -> tuple[bool, float, bool]:
    """Whether an element holds no article text, points for its names, and whether these may name a part.

    Such a name switches off outside a marked article only; within one it
    does so if most of the part is links.  Without ``named``, class and id
    names switch nothing off.
    """
    if name in NEVER or name == "header" and parent.name not in ("article", "main") and not parent.favour > 0:
        return True, 0.0, False
    favour = HOLDER if name in ("article", "main") else 0.0
    if not attributes.strip() or name in ("html", "body"):
        return False, favour, False
    off = told = beside = article = False
    part = True
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key in ("class", "id"):
            for one in value.split():
                parts = [x.lower() for x in NAME_PARTS.findall(one)]
                words = {*parts, "".join(parts)}  # "side-bar" is a sidebar
                told |= bool(words & ARTICLE)
                around = words & AROUND
                article |= not around and bool(words & ARTICLE)
                if not around or words & LAYOUT:
                    continue
                if name in ("article", "main"):
                    off |= set(parts) <= {"comment", "comments", "body"}
                elif not (around == {"header"} and words & {"article", "entry", "post", "story"}):
                    beside, part = True, part and around <= PARTS
        elif key == "role":
            off |= value.lower() in NOT_ROLES
            favour += HOLDER * (value.lower() in ("main", "article"))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            off = True
        elif key == "style":
            off |= bool(UNSEEN.search(value))
        elif key == "aria-label" and name not in ("article", "main"):
            off |= bool(AROUND & {x.lower() for x in NAME_PARTS.findall(value)})
        elif key == "itemprop" and value.lower() == "articlebody":
            favour += HOLDER
    if beside and article:  # another name says that it is the article
        return off, favour, False
    beside = beside and named and not off
    return off or beside and not part, favour + 15.0 * told, beside and part


def parse(page: str, named: bool = True) -> Element:
    """The element tree of a page; unclosed and misnested tags are mended as browsers do, roughly."""
    root = here = Element("html", None)
    depth = at = 0
    below = Below()
    while True:
        m = TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text and not below.hidden:
            here.items.append(html.unescape(text) if "&" in text else text)
        if not m:
            return root
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            place, scope = below.last((name,)), -1 if name in BLOCK else below.last(SCOPE)
            if place >= 0 and place >= scope:
                below.cut(place)
                if name in BLOCK:
                    here.items.append(Element(name, here))
                continue
            if scope >= 0:  # the end of an inline element that began elsewhere, or never
                if name == "br":
                    here.items.append(Element(name, here))
                continue
            node, steps = here, 0
            while node.parent is not None and node.name != name:
                if name not in BLOCK and node.name in SCOPE:
                    node = root  # the end of an inline element that began elsewhere, or never
                    break
                node, steps = node.parent, steps + 1
            if node.parent is not None:
                below.cut(0)
                here, depth = node.parent, depth - steps - 1
            elif name in ("p", "br"):
                here.items.append(Element(name, here))
            continue
        if name == "html":
            continue
        ends = CLOSES.get(name)
        if ends:
            scope = below.last(SCOPE - ends) if below.open else -1
            place = below.first(ends, scope)
            node, steps, last, last_steps = here, 0, None, 0
            while node.parent is not None and scope < 0:
                if node.name in ends:
                    last, last_steps = node, steps + 1
                elif node.name in SCOPE:
                    break
                node, steps = node.parent, steps + 1
            if place >= 0:
                below.cut(place)
            if last is not None:
                below.cut(0)
                here, depth = last.parent, depth - last_steps
        off, favour, part = surrounds(name, m[3], below.open[-1] if below.open else here, named)
        if name in ("article", "main", "h1"):  # a form around the whole page
            below.show_forms()
            node = here
            while node is not None:
                node.off &= node.name != "form"
                node = node.parent
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(page, at)
            at = end.end()
            continue
        node = Element(name, here, off, favour, part)
        if name in VOID:
            here.items.append(node)
        elif depth < DEPTH:
            here.items.append(node)
            here, depth = node, depth + 1
        else:
            here.items.append(Element(name, here))  # where a block begins
            below.push(node)


def blocks_of(root: Element) -> list[tuple[Element, str, int]]:
    """(innermost block, text, characters in links) of every text block in page order."""
    found, words, linked = [], [], 0

    def end(owner):
        nonlocal words, linked
        text = " ".join("".join(words).split())
        if text:
            found.append((owner, text, linked))
        words, linked = [], 0

    stack = [(root, iter(root.items), root, False)]
    while stack:
        node, items, owner, link = stack[-1]
        item = next(items, None)
        if item is None:
            stack.pop()
            if node.name in BLOCK:
                end(node)
            continue
        if isinstance(item, str):
            words.append(item)
            if link:
                linked += len(" ".join(item.split()))
        elif item.off:
            if item.name in BLOCK:
                end(owner)
        elif item.name == "br":
            words.append(" ")
        else:
            block = item.name in BLOCK
            if block:
                end(owner)
            stack.append((item, iter(item.items), item if block else owner, link or item.name == "a"))
    end(root)
    return found


def settle(root: Element) -> None:
    """Decide on the elements whose names may name a part of the article.

    Outside an element that is marked as the article they are switched off.
    Inside one, a part stays unless most of its text is links.
    """
    stack = [(root, False)]
    while stack:
        node, marked = stack.pop()
        marked |= node.favour >= HOLDER
        for item in node.items:
            if isinstance(item, Element) and not item.off:
                if item.part:
                    chars, linked = weight(item)
                    item.off = not marked or 2 * linked > chars
                if not item.off:
                    stack.append((item, marked))


def weight(node: Element) -> tuple[int, int]:
    """(characters, those in links) of the text of an element."""
    chars = linked = 0
    stack = [(node, False)]
    while stack:
        top, link = stack.pop()
        for item in top.items:
            if isinstance(item, str):
                n = len(" ".join(item.split()))
                chars, linked = chars + n, linked + n * link
            elif not item.off:
                stack.append((item, link or item.name == "a"))
    return chars, linked


def main_text(page: str) -> str:
    """The article of a page, one line for each block; empty if there is none.

    Where nothing but links and headings is left, names switch nothing off.
    """
    text, points = article_of(parse(page))
    return text if points else article_of(parse(page, named=False))[0]


def article_of(root: Element) -> tuple[str, float]:
    """(the article's text, the points of all blocks)."""
    settle(root)
    blocks = blocks_of(root)
    if not blocks:
        return "", 0.0
    total = 0.0
    nodes: dict[int, Element] = {}
    for owner, text, linked in blocks:
        heading = owner.name in HEADINGS
        points = 0.0 if heading else 1.0 + text.count(",") + min(len(text) / 100, 3.0)
        points *= 1 - min(linked / len(text), 1.0)
        total += points
        # the blocks' points also go to a block element that holds text of its own
        near = owner.parent if owner.name in ("p", "pre", "li", "blockquote", "td") and owner.parent is not None else owner
        node, share, k = near, 1.0, 0
        while node is not None:
            node.chars += len(text)
            node.linked += linked
            node.score += points * share
            nodes[id(node)] = node
            k += 1
            share = 1.0 / (k + 1)
            node = node.parent
        if near is not owner:
            owner.chars, owner.linked = owner.chars + len(text), owner.linked + linked
            nodes.setdefault(id(owner), owner)
    worth = lambda e: (e.score + e.favour) * (1 - e.linked / max(e.chars, 1))
    holders = [e for e in nodes.values() if e.score > 0 and e.name not in HEADINGS and e.name not in ("ul", "ol", "li", "table", "tr", "tbody")] \
        or list(nodes.values())
    best = node = max(holders, key=worth)
    while node is not None:  # a part of an element that is marked as the article
        if node.favour >= HOLDER:
            best = node
            break
        node = node.parent
    kept = {id(best)}
    least = max(5.0, 0.1 * worth(best))
    for item in best.parent.items if best.parent is not None else []:
        if not isinstance(item, Element) or id(item) not in nodes or item is best:
            continue
        density = item.linked / max(item.chars, 1)
        if density < 0.3 and (item.name == "h1" or best.favour < HOLDER and (
                worth(item) >= least or item.name in HEADINGS
                or item.name in ("p", "pre", "blockquote") and item.chars > 80)):
            kept.add(id(item))
    inside = []
    for owner, text, linked in blocks:
        node = owner
        while node is not None and id(node) not in kept:
            node = node.parent
        if node is not None:
            inside.append((owner, text, linked))
    # between which blocks an element's own paragraphs lie
    spoken: dict[int, list[int]] = {}
    for k, (owner, text, linked) in enumerate(inside):
        if owner.name in ("p", "pre", "blockquote") and 2 * linked < len(text):
            spoken.setdefault(id(owner.parent), []).append(k)
    lines = []
    for k, (owner, text, linked) in enumerate(inside):
        # a list mostly of links is a menu, save inside a marked article or between paragraphs
        if linked >= len(text) and owner.name == "li" and best.favour < HOLDER and 2 * owner.parent.linked > owner.parent.chars:
            around = spoken.get(id(owner.parent.parent), [])
            if not around or not around[0] < k < around[-1]:
                continue
        lines.append(text)
    return "\n".join(lines), total


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The rows with ``text``, the page's main text, and ``n_chars``, its code points.

    A null or empty page, or one without text, has the empty text.  Every row
    is read by itself, so ties, repeats and further columns do not matter;
    columns of the two names are replaced.  An empty table gives no rows.
    """
    rest = pages.drop("text", "n_chars")

    def extract(batches):
        for batch in by_bytes(batches, html_col):
            texts = [main_text(x) if x else "" for x in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*batch.schema.names, "text", "n_chars"])

    return rest.mapInArrow(extract, with_fields(rest, text=T.StringType(), n_chars=T.LongType()))
