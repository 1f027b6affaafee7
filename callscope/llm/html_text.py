"""Main text of web pages by two passes over their blocks.

The first pass decides each block by stop-word density, length and link density, and by elements
that never hold the article (menus, footers, forms, and what their class or id says). The second
lets every undecided block, mostly short ones, take the label of its nearest decided neighbour. In
a marked article every block is kept that is not mostly links.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.3
LINK_SHARE = 0.33
#: Where no block reaches STOP_HIGH: this share of the page's median stop density.
RELATIVE_LOW = 0.25
#: In a marked article only blocks that are mostly links are left out.
MAIN_LINK_SHARE = 0.5
#: A heading counts with the block after it over this many characters at most.
HEADING_REACH = 200

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it for on was be by this with from as are at or an not he his they
    der die und zu den das nicht von sie ist des sich mit dem ein eine für auf im als auch es er
    le la les et un une du de que est pour qui dans par sur avec pas au il ne se ce plus
    el los las y del por con no su para al lo como más pero sus o
    """.split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>"
    r"|<[a-zA-Z!?/][^>]*\Z",
    re.S,
)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_STYLE = re.compile(r"""(?:^|\s)style\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile(r"[A-Za-z\u00c0-\u024f]+")
#: Characters that say about as much as three of an alphabet.
_WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")

#: Elements whose content is not text of the page.
_DROPPED = frozenset("script style noscript template iframe object svg math canvas head title select textarea button audio video".split())
#: Elements whose content is not markup either.
_RAW = frozenset("script style textarea title iframe noscript".split())
#: Elements of _DROPPED whose end the markup inside them decides.
_PARSED = _DROPPED - _RAW - {"head"}
#: Those of which the next one of the same name ends the one before.
_UNNESTED = frozenset(("button", "select"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that end an element of _DROPPED without a closing tag.
_BLOCKS = _HEADINGS | frozenset(
    """
    address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul
    """.split()
)
_SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
_NEVER = frozenset("nav aside footer menu dialog".split())
_MAIN = frozenset(("article", "main"))
_CONTAINERS = frozenset("article body center div form header main section table td".split())
#: Words in a class, id or role of what surrounds an article.
_SURROUNDING = frozenset(
    """
    ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion
    nav navigation navbar menu breadcrumb breadcrumbs pagination pager footer masthead sidebar aside
    cookie cookies consent notice notices popup modal newsletter subscribe signup login share sharing
    social related recommended comment comments disqus respond replies reply widget form search
    """.split()
)


#: Words for what stands above and below an article, unless the name speaks of the article too. What
#: holds most of a page's text is neither that nor a form.
_EDGES = frozenset("header top topbar bottom branding tagline copyright colophon".split())
_OF_ARTICLE = frozenset("article entry post story content page section title".split())
#: A name of one word may be joined of a place, one of these words, and a kind of container.
_JOINED = re.compile(
    r"(?:top|main|site|page|left|right|bottom|sub|side|user|post)?"
    rf"({'|'.join(sorted(_SURROUNDING | _EDGES, key=len, reverse=True))})"
    r"(?:s|bar|list|box|area|wrap|wrapper|container|section|block|panel|links?|items?|thread|body|text|left|right)?"
)
#: In a class or id, a word that tells the state of a page: comments-open.
_STATES = frozenset("open closed enabled disabled allowed off on".split())
#: Headings of lists that lead away from an article.
_LEADING_AWAY = re.compile(
    r"(?:related|recommended)(?: (?:articles?|posts?|stories|content|links|reading|news|pages|topics))?"
    r"|(?:you (?:may|might) also (?:like|enjoy)|read (?:next|more|also)|more (?:stories|articles|posts)|more from .{1,60})",
    re.I,
)
_NOTICE = re.compile(r"\s*(?:©|\(c\)|copyright\b)|.{0,200}\ball rights reserved\b", re.I | re.S)
_SENTENCE = re.compile(r"(?:\S+\s+){3,}\S*[.!?…][\"'”’»)]*\Z|.*[。！？]\Z", re.S)

#: Those that hold articles of their own: remarks and teasers.
_BESIDE = frozenset("comment comments disqus respond replies reply sidebar aside".split())
#: In a class or id, what comes after one of these is a property of the layout.
_MODIFIERS = frozenset("has no with without".split())


@dataclass
class _Span:
    """The blocks from ``begin`` to before ``end``, all of one container."""

    begin: int
    end: int
    #: The container around it.
    parent: int
    #: Where its tag ends, and whether it is surroundings only if it doesn't hold most of the text.
    at: int
    weak: bool


@dataclass
class Block:
    text: str
    linked: int
    #: Level of a heading, 0 for other blocks.
    heading: int
    #: What _zone says; its first word is the kind.
    zone: str
    #: Whether it is in a list.
    listed: bool
    #: The place of its container among the spans of the page.
    within: int

    @property
    def aside(self) -> bool:
        return self.zone.split()[0] in ("never", "named", "beside")

    @property
    def marked(self) -> bool:
        return self.zone.split()[0] in ("main", "wrapped")


@lru_cache(maxsize=1 << 12)
def _names(attributes: str) -> frozenset[str]:
    """The words of class, id and role, without those after a modifier."""
    named = set()
    for m in _NAMES.finditer(attributes):
        for token in (m[1] or m[2] or m[3] or "").split():
            words = re.split(r"[_-]+", _CAMEL.sub("-", token).lower())
            if len(words) > 1 and words[-1] in _STATES:
                continue
            for word in words:
                if word in _MODIFIERS:
                    break
                joined = _JOINED.fullmatch(word)
                named.add(joined[1] if joined else word)
    return frozenset(named)


def _hidden(attributes: str) -> bool:
    if "hidden" not in attributes.lower() and "none" not in attributes.lower():
        return False
    style = _STYLE.search(attributes)
    if style and _UNSEEN.search(style[1] or style[2] or style[3] or ""):
        return True
    return _HIDDEN.search(_QUOTED.sub("", attributes)) is not None


def _weak(name: str, named: frozenset[str]) -> bool:
    """Whether a form or a name of the page's edge makes this surroundings, and nothing surer does."""
    edge = named & _EDGES and not named & _OF_ARTICLE
    return name not in _MAIN and (name == "form" or bool(edge)) and not named & (_SURROUNDING - {"form", "search"})


def _zone(name: str, attributes: str, outer: str, at: int, cleared: bool = False) -> str:
    """Whether what an element at this place may hold is article text: a kind, and the wrapped articles around.

    ``cleared`` is an element that holds most of the page's text and so is none of its surroundings.

    "never" is for all inside. In "named" and "beside" an article is "wrapped" and one of its own; in
    "beside", remarks and sidebars, only <main> is, as none of them holds that.
    """
    kind, _, path = outer.partition(" ")
    inner = kind in ("main", "wrapped")
    if kind == "never" or name in _NEVER or (name == "header" and not inner):
        return "never"
    if name in ("html", "body"):
        return outer
    if _hidden(attributes):
        return "never"
    named = frozenset() if cleared else _names(attributes)
    if kind == "beside" or name not in _MAIN and named & _BESIDE:
        return f"wrapped {path}/{at}" if name == "main" else f"beside {path}"
    if name in _MAIN and named & _BESIDE:
        # a remark in an article, or one that names what it has: its length tells
        return f"wrapped {path}/{at}"
    surrounding = not cleared and (name == "form" or bool(named & _SURROUNDING) or not inner and _weak(name, named))
    article = name in _MAIN or name == "div" and "main" in named and not surrounding
    if kind == "named" or surrounding:
        return f"wrapped {path}/{at}" if article else f"named {path}"
    return "main" if article and not inner else outer


@dataclass
class _Tag:
    start: int
    end: int
    name: str
    closing: bool
    attributes: str


def _tags(html: str) -> list[_Tag]:
    """The tags and comments of a page in order; raw elements and the head are one with what they hold."""
    out, at, end = [], 0, len(html)
    while (m := _TAG.search(html, at)) is not None:
        at = m.end()
        name, closing = (m[2] or m[5] or "").lower(), bool(m[1] or m[4])
        if name in _RAW or name == "head":
            stop = None if closing else re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            if stop is not None:
                at = stop.end()
            elif name == "head" and not closing:
                body = re.compile(r"<body\b", re.I).search(html, at)
                at = body.start() if body else at
            elif not closing:
                at = end
        out.append(_Tag(m.start(), at, name, closing, (m[3] if m[2] else m[6]) or ""))
    return out


def _ends(tags: list[_Tag], end: int) -> dict[int, int]:
    """By the place of its tag, the end of each dropped element that may hold markup.

    One without a closing tag ends with the block around it or where the next block begins.
    """
    ends: dict[int, int] = {}
    #: Elements without a closing tag so far, how many there are of a name, and dropped ones that wait for a block.
    open_: list[_Tag] = []
    depth: dict[str, int] = {}
    begun: list[_Tag] = []
    blocks_after: dict[int, int] = {}

    def leave(tag: _Tag, at: int) -> None:
        depth[tag.name] -= 1
        if tag.name in _PARSED:
            ends[tag.start] = min(blocks_after.get(tag.start, at), at)

    for tag in tags:
        name = tag.name
        if not name or name in _RAW or name == "head" or name in _INLINE or name in _VOID and name != "hr":
            continue
        if name in _BLOCKS:
            blocks_after.update((t.start, tag.start) for t in begun)
            begun.clear()
        if tag.closing:
            if depth.get(name):
                while open_[-1].name != name:
                    leave(open_.pop(), tag.start)
                last = open_.pop()
                depth[name] -= 1
                if name in _PARSED:
                    ends[last.start] = tag.end
            continue
        if name in _MAIN and not depth.get("template") and any(depth.get(n) for n in _PARSED):
            # no other element of these holds an article: what is open here was never closed
            for t in open_:
                if t.name in _PARSED:
                    leave(t, tag.start)
            open_ = [t for t in open_ if t.name not in _PARSED]
        if name in _UNNESTED and depth.get(name):
            while open_[-1].name != name:
                leave(open_.pop(), tag.start)
            leave(open_.pop(), tag.start)
        if name == "hr" or name in _PARSED and tag.attributes.endswith("/"):
            continue
        open_.append(tag)
        depth[name] = depth.get(name, 0) + 1
        if name in _PARSED:
            begun.append(tag)
    while open_:
        leave(open_.pop(), end)
    return ends


def blocks(html: str) -> list[Block]:
    """The page's blocks of text in order, character references decoded and white space joined."""
    return _blocks_and_spans(html)[0]


def _blocks_and_spans(html: str) -> tuple[list[Block], list[_Span]]:
    """A form or an edge of the page that holds most of the text without a link is neither."""
    out, spans = _parse(html, frozenset())
    if any(s.weak for s in spans):
        sums = [0]
        for b in out:
            sums.append(sums[-1] + (0 if b.zone.split()[0] in ("never", "beside") else len(b.text) - b.linked))
        cleared = frozenset(s.at for s in spans if s.weak and 2 * (sums[s.end] - sums[s.begin]) > sums[-1])
        if cleared:
            return _parse(html, cleared)
    return out, spans


@dataclass
class _Open:
    name: str
    zone: str
    listed: bool
    #: Its span, or that of the container around it.
    span: int
    own: bool


def _parse(html: str, cleared: frozenset[int]) -> tuple[list[Block], list[_Span]]:
    out: list[Block] = []
    spans = [_Span(0, 0, -1, 0, False)]
    open_ = [_Open("", "page", False, 0, True)]
    parts: list[str] = []
    linked: list[str] = []
    in_link = 0
    heading = 0
    #: An inline element that is not shown, and how many of its name are open.
    unseen, unseen_depth = "", 0

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                inside = len(" ".join(unescape("".join(linked)).split()))
                last = open_[-1]
                out.append(Block(text, inside, heading, last.zone, last.listed, last.span))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if text and not unseen:
            parts.append(text)
            if in_link:
                linked.append(text)

    def leave(k: int) -> None:
        for e in open_[k:]:
            if e.own:
                spans[e.span].end = len(out)
        del open_[k:]

    at, tags = 0, _tags(html)
    ends = _ends(tags, len(html)) if any(t.name in _PARSED for t in tags) else {}
    for tag in tags:
        if tag.start < at:
            continue
        add(html[at : tag.start])
        name, closing, attributes = tag.name, tag.closing, tag.attributes
        at = tag.end
        if not name:
            continue
        if name in _INLINE and name == unseen:
            unseen_depth += -1 if closing else 1
            unseen = unseen if unseen_depth else ""
        elif name in _INLINE and not closing and not unseen and _hidden(attributes):
            unseen, unseen_depth = name, 1
        if name in _DROPPED and not closing:
            if name != "head":
                flush()
            at = ends.get(tag.start, at)
        elif name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            add(" ")
        elif name in _INLINE or name in _VOID and name != "hr":
            continue
        else:
            flush()
            in_link = 0
            unseen = ""
            heading = int(name[1]) if name in _HEADINGS and not closing else 0
            if closing:
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k].name == name:
                        leave(k)
                        break
            elif name not in _VOID:
                if name in _SELF_CLOSING and open_[-1].name == name or open_[-1].name == "p":
                    leave(len(open_) - 1)
                around = open_[-1]
                zone = _zone(name, attributes, around.zone, at, at in cleared)
                listed = around.listed or name in ("ul", "ol", "dl")
                own = name in _CONTAINERS
                if own:
                    weak = around.zone == "page" and zone.startswith("named") and _weak(name, _names(attributes))
                    spans.append(_Span(len(out), len(out), around.span, at, weak))
                open_.append(_Open(name, zone, listed, len(spans) - 1 if own else around.span, own))
    add(html[at:])
    flush()
    leave(0)
    return out, spans


def _length(text: str) -> int:
    return len(text) if text.isascii() else len(text) + 2 * len(_WIDE.findall(text))


def _is_wording(text: str) -> bool:
    return 4 * sum(map(len, _WORD.findall(text))) >= len(text)


def _stop_density(text: str) -> float | None:
    """None for text that is not in Latin letters, of which the stop words know nothing."""
    words = _WORD.findall(text.lower())
    if not text.isascii() and 2 * sum(map(len, _LATIN.findall(text))) < sum(map(len, words)):
        return None
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _decide(block: Block) -> bool | None:
    """First pass: article, not article, or undecided."""
    marked = block.marked
    if block.aside or block.linked > (MAIN_LINK_SHARE if marked else LINK_SHARE) * len(block.text):
        return False
    length = _length(block.text)
    if not marked and length <= LONG and _NOTICE.match(block.text):
        return False
    if length < SHORT:
        return False if block.linked and not marked else None
    stops = _stop_density(block.text)
    if (stops is None or stops >= STOP_HIGH) and length > LONG:
        return True
    return None if stops is None or stops >= STOP_LOW or marked else False


def _decide_unmarked(body: list[Block], spans: list[_Span]) -> list[bool | None]:
    """First pass over a page without a marked article.

    Where no block reaches the stop density of an article, the long ones that are no list of links
    are measured against each other. Under a median of ``STOP_LOW`` the page is in a language of
    which the stop words know nothing, and length and links decide alone.
    """
    labels = [_decide(b) for b in body]
    able = [not b.aside and b.linked <= LINK_SHARE * len(b.text) and _length(b.text) >= SHORT and _is_wording(b.text) and not (_length(b.text) <= LONG and _NOTICE.match(b.text)) for b in body]
    prose = [i for i, a in enumerate(able) if a]
    if not prose:
        # nothing but short blocks: sentences without a link
        return [label if label is False else bool(_SENTENCE.match(b.text)) and not b.linked for b, label in zip(body, labels, strict=True)]
    if True not in labels:
        seeds = [i for i in prose if _length(body[i].text) > LONG] or prose
        stops = {i: _stop_density(body[i].text) or 0.0 for i in prose}
        median = sorted(stops[i] for i in seeds)[(len(seeds) - 1) // 2]
        least = median * RELATIVE_LOW if median >= STOP_LOW else 0.0
        for i in prose:
            labels[i] = None
        for i in seeds:
            labels[i] = stops[i] >= least
    else:
        stops = {i: _stop_density(body[i].text) or 0.0 for i in prose}
        median = sorted(stops.values())[(len(prose) - 1) // 2] if prose else 0.0
        begin, end = _reach(body, spans, labels)
        for i in prose:
            if labels[i] is False and (begin <= i < end or _length(body[i].text) > LONG) and stops[i] >= median * RELATIVE_LOW:
                labels[i] = None
    # stop words alone reject nothing between two blocks of the article
    sure = [label if label or not a else None for label, a in zip(labels, able, strict=True)]
    for i, inside in enumerate(_enclosed(sure)):
        labels[i] = None if able[i] and inside and not labels[i] else labels[i]
    # a long undecided block goes by text beside it that is sure, not by elements that are set aside
    sure = [label if label or not a else None for label, a in zip(labels, able, strict=True)]
    outside = [i for i, b in enumerate(body) if not b.aside]
    for i, kept in zip(outside, _inherit([sure[i] for i in outside], default=False), strict=True):
        labels[i] = kept if able[i] and labels[i] is None else labels[i]
    return labels


def _reach(body: list[Block], spans: list[_Span], labels: list[bool | None]) -> tuple[int, int]:
    """From where to where a page without a marked article has it: the least container of all blocks that are sure.

    It begins with its title where that stands above the container and nothing inside does for one.
    """
    sure = [i for i, label in enumerate(labels) if label]
    if not sure:
        return 0, len(body)
    span = spans[body[sure[0]].within]
    while span.parent >= 0 and (span.end <= sure[-1] or span.end - span.begin == 1):
        span = spans[span.parent]
    begin, end = span.begin, span.end
    if not any(b.heading for b in body[begin : sure[0]]):
        between = 0
        for i in range(begin - 1, -1, -1):
            b = body[i]
            if b.heading and not b.aside and not b.linked:
                begin = i
                break
            between += len(b.text)
            if between > HEADING_REACH or b.aside:
                break
    return begin, end


def _enclosed(labels: list[bool | None]) -> list[bool]:
    """Whether the next decided blocks before and after are both of the article."""
    sides = []
    for step in (1, -1):
        last, side = False, []
        for label in labels[::step]:
            side.append(last)
            last = last if label is None else label
        sides.append(side[::step])
    return [a and b for a, b in zip(*sides, strict=True)]


def _inherit(labels: list[bool | None], default: bool) -> list[bool]:
    """Second pass: the label of the nearest decided block; between two as near, article wins."""
    n = len(labels)
    before: list[tuple[int, bool] | None] = []
    last = None
    for i, label in enumerate(labels):
        last = (i, label) if label is not None else last
        before.append(last)
    out: list[bool] = [default] * n
    last = None
    for i in range(n - 1, -1, -1):
        last = (i, labels[i]) if labels[i] is not None else last
        near = [(abs(j - i), not label) for j, label in filter(None, (before[i], last))]
        if near:
            out[i] = not min(near)[1]
    return out


def _article(found: list[Block]) -> list[Block]:
    """The blocks of marked articles; of wrapped ones, mostly teasers, those longer than every article around them and all that is not wrapped."""
    sizes: dict[str, int] = {}
    for b in found:
        if b.marked:
            sizes[b.zone] = sizes.get(b.zone, 0) + len(b.text)
    kept = set()
    for zone, size in sizes.items():
        steps = zone.split("/")
        around = ["main", *("/".join(steps[:k]) for k in range(2, len(steps)))]
        if zone == "main" or all(size > sizes.get(z, 0) for z in around):
            kept.add(zone)
    return [b for b in found if b.zone in kept]


def main_text(html: str | None) -> str:
    """The article's blocks joined by single spaces; empty if there is none."""
    found, spans = _blocks_and_spans(html) if html else ([], [])
    inside = _article(found)
    # a page that marks its article has nothing else of it outside
    body = inside or found
    if inside:
        # the mark speaks for what is undecided, not a list of links beside it
        kept = [_decide(b) is not False for b in body]
    else:
        labels = _decide_unmarked(body, spans)
        begin, end = _reach(body, spans, labels)
        # above and below the article's container only sentences may belong to it
        for i, b in enumerate(body):
            if labels[i] is None and not begin <= i < end and not _SENTENCE.match(b.text):
                labels[i] = False
        nearest = _inherit(labels[begin:end], default=False)
        kept = _inherit(labels, default=False)
        kept[begin:end] = nearest
        reach = 0
        for i in range(len(body) - 1, -1, -1):
            reach = 0 if kept[i] else reach + len(body[i].text)
            follows = any(kept[i + 1 :]) if reach <= HEADING_REACH and body[i].heading else False
            kept[i] = kept[i] or (follows and begin <= i < end and not body[i].aside and not body[i].linked)
    for i, b in enumerate(body):
        if b.heading and _LEADING_AWAY.fullmatch(b.text.rstrip(" :.…")) and i + 1 < len(body) and body[i + 1].listed:
            kept[i] = False
            for j in range(i + 1, len(body)):
                if not body[j].listed:
                    break
                kept[j] = False
    return " ".join(b.text for b, keep in zip(body, kept, strict=True) if keep)


def _extract(html: str, text: str, n_chars: str):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(html)
            texts = [main_text(x) for x in batch.column(at).to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns = {n: c for n, c in columns.items() if n not in (html, text, n_chars)}
            columns[text] = pa.array(texts, pa.string())
            columns[n_chars] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def extract(pages: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The pages without ``html`` and with ``text`` and ``n_chars``, its code points.

    Null, empty and article-less pages have an empty text. Equal rows give equal results; an empty
    table gives no rows. Columns of the new names are replaced.
    """
    kept = [f for f in pages.schema.fields if f.name not in (html, text, n_chars)]
    schema = T.StructType([*kept, T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())])
    return pages.mapInArrow(_extract(html, text, n_chars), schema)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return extract(pages.select("page_id", "url", "html"))
