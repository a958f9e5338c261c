"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Text is gathered in blocks (block elements part them).
Paragraph blocks pass points to their parent, and fewer to farther ancestors: one, one for each comma, one for each
hundred characters up to three. An element's points are discounted by the share of its text that
is in links. The element with the most points is the container; it grows to its parent while the
parent is an article or main element, and siblings with a fair part of its points, or long prose
with few links, are kept with it. Menus, headers, footers, asides, forms, scripts, styles, hidden
elements, and elements whose class, id or role names an advert, menu, notice or comments, are left
out, but for wrappers: such an element that holds most of the page's text and its heading or article
only says how the page looks, and a form around a page is no form. A title in a header element inside the
article counts as header.

Defined results: a null or empty page, and one without text outside such parts, has an empty text;
unclosed and stray tags are repaired as browsers do for the common cases; a page cut inside a tag
loses that tag only; of pages of one size of points the first container in page order wins;
repeated rows are extracted each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import small_batches, spare

# Names of elements as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br img".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg math object xmp noembed noframes".split())
LEFT_OUT = RAW | frozenset(
    "head nav header footer aside form button select option input menu dialog fieldset audio video canvas map".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header"
    " hgroup hr main menu nav ol p pre section table ul".split()
)
CLOSES = {  # an open element of these that a start tag of the key ends
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
SCOPE = frozenset("ul ol dl table tbody thead tfoot body html".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*(?:>|\Z)", re.S)
CUT_TAG = re.compile(r"<(?:/?[a-zA-Z][^<>]*)?\Z")
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
#: Words of class, id and role that mark what is no part of an article.
SHUNNED = re.compile(
    r"(?:\A|[^a-z])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notices?|popup|modal|overlay|comments?|replies"
    r"|disqus|respond|nav\w*|menu\w*|breadcrumbs?|sidebar|side|aside|foot\w*|header|masthead|share\w*|sharing|social|related"
    r"|recommend\w*|newsletter|subscribe\w*|signup|login|pagination|pager|toolbar|widgets?|skip|hidden|contentinfo"
    r"|complementary|search|alert|disclaimer|legal)(?:\Z|[^a-z])"
)
WANTED = re.compile(r"(?:\A|[^a-z])(?:article|main|content|post|entry|story|body|text)(?:\Z|[^a-z])")
SPACES = re.compile(r"\s+")


#: Of them, those of readers' comments.
COMMENTS = re.compile(r"(?:\A|\s)(?!(?:has|no|with|without|show|hide|is)-)(?:\S*[^a-z\s])?(?:comments?|replies|disqus|respond)(?:\Z|[^a-z])")
#: Text outside shunned elements below which a page counts as shunned whole.
LITTLE = 100


class Element:
    __slots__ = ("name", "parent", "parts", "shunned", "spared", "wanted", "points", "length", "linked", "prose")

    def __init__(self, name: str, parent: Element | None, shunned: bool, wanted: bool, spared: str = "") -> None:
        self.name = name
        self.parent = parent
        self.parts: list[Element | str] = []
        self.shunned = shunned
        #: why it is shunned, if it may yet be a wrapper of the article: "words", "comments" or "form"
        self.spared = spared
        self.wanted = wanted
        self.points = 0.0
        self.length = 0
        self.linked = 0
        self.prose = 0


def marks(attributes: str) -> tuple[str, bool]:
    """What the attributes shun the element for ("hidden", "comments", "words" or nothing), and whether they want it."""
    if not attributes.strip(" /"):
        return "", False
    shunned, wanted = "", False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values)).lower()
        if name in ("class", "id", "role"):
            value = value.replace("_", "-")
            if SHUNNED.search(value) is not None:
                shunned = shunned or ("comments" if COMMENTS.search(value) else "words")
            wanted |= WANTED.search(value) is not None
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            shunned = "hidden"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            shunned = "hidden"
    return shunned, wanted


def parse(page: str) -> Element:
    """The tree of a page; text parts have their character references decoded."""
    root = at = Element("", None, False, False)
    page = CUT_TAG.sub("", page)
    place = 0
    end = len(page)
    while place < end:
        tag = TOKEN.search(page, place)
        text = page[place : tag.start() if tag else end]
        if text:
            at.parts.append(unescape(text))
        if not tag:
            break
        place = tag.end()
        if tag.group(2) is None:
            continue
        name = tag.group(2).lower()
        if tag.group(1):
            at = closed(at, name)
            continue
        at = opened(at, name)
        reason, wanted = marks(tag.group(3))
        if name in ("html", "body", "article", "main"):
            reason = ""
        left_out = name in LEFT_OUT and name != "form"
        spared = "" if left_out or reason == "hidden" else reason or ("form" if name == "form" else "")
        element = Element(name, at, bool(reason) or name in LEFT_OUT, wanted or name in ("article", "main"), spared)
        at.parts.append(element)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, place)
            place = stop.end() if stop else end
        elif name not in VOID:
            at = element
    return root


def opened(at: Element, name: str) -> Element:
    """Where an element of this name is put: open paragraphs and items end before some."""
    if name in ENDS_PARAGRAPH:
        up: Element | None = at
        while up is not None and (up.name in INLINE or up.name == "p"):
            if up.name == "p":
                return up.parent or up
            up = up.parent
        if at.name in INLINE and up is not None:
            return up  # formatting that was left open does not swallow the next block
    if name in CLOSES:
        up = at
        while up is not None and up.name not in SCOPE:
            if up.name in CLOSES[name]:
                return up.parent or up
            up = up.parent
    return at


def closed(at: Element, name: str) -> Element:
    """Where to go on after an end tag; one without a start is dropped."""
    up: Element | None = at
    while up is not None and up.name != name:
        up = up.parent
    return up.parent if up is not None and up.parent is not None else at


def spare_wrappers(root: Element) -> None:
    """Take back the shunning of wrappers: a word in a class may only say how the page looks.

    An element that is shunned for its words, or as a form, but holds more than half of the page's
    text outside links, and the top heading, ``main`` or (unless it is about comments) an ``article``,
    is a wrapper of the article. Where hardly any text is outside shunned elements, the one with most
    text is taken for a wrapper.
    """
    size: dict[int, int] = {}
    holds: dict[int, bool] = {}
    order: list[tuple[Element, bool]] = [(root, False)]
    seen: list[Element] = []
    while order:  # parents before children
        element, link = order.pop()
        seen.append(element)
        size[id(element)] = 0 if link else sum(len(p.strip()) for p in element.parts if isinstance(p, str))
        holds[id(element)] = element.name in ("h1", "main", "article")
        order += [(p, link or p.name == "a") for p in element.parts if isinstance(p, Element) and (not p.shunned or p.spared)]
    top = {id(e): e.name in ("h1", "main") for e in seen}
    for element in reversed(seen[1:]):
        up = id(element.parent)
        size[up] += size[id(element)]
        top[up] |= top[id(element)]
        holds[up] |= holds[id(element)]
    whole, outside, shut = size[id(root)], size[id(root)], []
    under: set[int] = set()
    for element in seen:
        if id(element.parent) in under:
            under.add(id(element))
        elif element.shunned:
            told = top[id(element)] or holds[id(element)] and element.spared != "comments"
            if 2 * size[id(element)] > whole and told:
                element.shunned = False
            else:
                under.add(id(element))
                outside -= size[id(element)]
                shut.append(element)
    if outside < LITTLE and shut:
        most = max(shut, key=lambda e: size[id(e)])
        if size[id(most)] > outside and most.spared != "comments":
            most.shunned = False


class Blocks:
    """Blocks of text in page order, each with the block element it stands in and its length in links."""

    def __init__(self) -> None:
        self.rows: list[tuple[Element, str]] = []
        self.pieces: list[str] = []
        self.linked = 0

    def end(self, owner: Element) -> None:
        text = SPACES.sub(" ", "".join(self.pieces)).strip()
        linked, self.pieces, self.linked = self.linked, [], 0
        if not text:
            return
        self.rows.append((owner, text))
        up: Element | None = owner
        while up is not None:
            up.length += len(text)
            up.linked += min(linked, len(text))
            up = up.parent
        if owner.name in ("li", "td", "th", "dt", "dd") and linked > len(text) / 2:
            return
        if not owner.name.startswith("h"):
            owner.prose += len(text)
            worth = 1 + text.count(",") + text.count("、") + min(len(text) // 100, 3)
            if len(text) < 25:
                worth = 0.25
            up, level = owner if owner.name not in ("p", "pre", "li", "blockquote") else owner.parent, 0
            while up is not None and level < 4:
                up.points += worth / (1, 2, 6, 9)[level]
                up, level = up.parent, level + 1


def gather(root: Element) -> list[tuple[Element, str]]:
    """All blocks outside shunned elements, walked without recursion since pages nest deep."""
    blocks = Blocks()
    todo: list[tuple[Element, int, Element, bool]] = [(root, 0, root, False)]
    while todo:
        element, i, owner, link = todo.pop()
        if i == len(element.parts):
            if element is owner:
                blocks.end(owner)
            continue
        todo.append((element, i + 1, owner, link))
        part = element.parts[i]
        if isinstance(part, str):
            blocks.pieces.append(part)
            if link:
                blocks.linked += len(part.strip())
        elif part.name == "br":
            blocks.pieces.append(" ")
        elif part.shunned:
            if part.name not in INLINE:
                blocks.end(owner)
        elif part.name in INLINE:
            todo.append((part, 0, owner, link or part.name == "a"))
        else:
            blocks.end(owner)
            todo.append((part, 0, part, link))
    return blocks.rows


def worth(element: Element) -> float:
    bonus = 25.0 if element.wanted else 0.0
    return (element.points + bonus * (element.points > 0)) * (1 - element.linked / max(1, element.length))


def kept_roots(rows: list[tuple[Element, str]]) -> list[Element]:
    """The best container, and its siblings that read like parts of it."""
    seen: dict[int, Element] = {}
    for owner, _ in rows:
        up: Element | None = owner
        while up is not None and id(up) not in seen:
            seen[id(up)] = up
            up = up.parent
    best = max(seen.values(), key=worth)
    up = best
    while up is not None and up.parent is not None:
        up = up.parent
        if up.name in ("article", "main"):
            best = up
    if best.parent is None:
        return [best]
    limit = max(10.0, 0.2 * worth(best))
    kept = [best]
    if best.name not in ("article", "main", "body", "html"):
        for other in best.parent.parts:
            if isinstance(other, Element) and other is not best and id(other) in seen:
                plain = other.linked < 0.25 * other.length
                if worth(other) >= limit or plain and other.prose > 80 or other.name in ("h1", "h2"):
                    kept.append(other)
    return kept


def main_text(page: str | None) -> str:
    """The blocks of the article in page order, parted by empty lines."""
    root = parse(page or "")
    spare_wrappers(root)
    rows = gather(root)
    if not rows:
        return ""
    kept = {id(k) for k in kept_roots(rows)}
    inside: dict[int, bool] = {}

    def within(element: Element) -> bool:
        path = []
        up: Element | None = element
        while up is not None and id(up) not in inside and id(up) not in kept:
            path.append(up)
            up = up.parent
        verdict = up is not None and (id(up) in kept or inside[id(up)])
        for e in path:
            inside[id(e)] = verdict
        return verdict

    return "\n\n".join(text for owner, text in rows if within(owner))


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text`` and ``n_chars`` (code points, both replacing their like) for every row."""
    small_batches(pages.sparkSession)
    keep = [c for c in keep if c.lower() not in ("text", "n_chars")]
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text((v.as_py() or b"").decode("utf-8", "replace")) for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"],
            )

    return pages.select(*keep, F.col(html).cast("binary").alias(spare("page_html", keep))).mapInArrow(extracted, schema)
