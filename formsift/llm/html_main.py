"""Main text of web pages by paths that the pages of a host agree on.

Every page scores its containers by the running text of their blocks and votes for the generalised tag-class paths of
all of them; votes are added up per host in Spark. A host's winning paths are that of most votes and all that lead for
LEADS pages or more, one for each of its templates; each page is extracted again along that which it ranks first.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formsift.llm import base

# Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template svg math select object canvas audio video xmp noembed button".split())
#: Of these, what is left open takes the rest of the page with it; of the others only the tag itself is left out.
TO_THE_END = {"script", "style", "textarea", "title"}
BLOCKS = set(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead "
    "tr ul caption".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
RUNNING = HEADINGS | set("p pre blockquote li dd dt td th figcaption".split())
CONTAINERS = set("html body article main section div td blockquote center".split())
#: Elements that hold no part of an article wherever they stand.
ASIDE = set("nav aside footer form button dialog menu search head".split())
# Words of classes, ids and roles that mark what is no part of an article.
MARKS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar footer sidebar aside ad ads advert adverts "
    "advertisement advertising adsense sponsor sponsored promo promoted promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus replies "
    "respond reply share sharing social related recommended recommendations trending widget widgets outbrain taboola "
    "contentinfo complementary search dialog masthead skip hidden paywall toc".split()
)
HEADER = {"header", "masthead", "banner"}
#: Words beside a mark that only say where on the page it is: site-footer, but not search-strategy.
PLACES = set(
    "site page main global top bottom left right primary secondary post article entry blog user wp area box block list bar "
    "section header inner outer container wrap wrapper".split()
)
#: Marks of what readers write: it may be longer than the article and is still none.
READERS = {"comment", "comments", "disqus", "replies", "respond", "reply"}
#: A name says what else is on the page from such a word on: has-sidebar, page-with-comments.
BESIDES = {"has", "with", "no", "without"}
#: An end of one of these is implied by the begin of another; a paragraph ends where any block begins.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}

#: Pages that a path must lead for to win beside the one of most votes.
LEADS = 2
#: Characters from which on a paragraph is running text; a block of no such kind needs four times as many.
RUNNING_CHARS = 25

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")
_BODY = re.compile(r"<body[\s/>]", re.I)


@dataclass
class Element:
    tag: str
    parent: Element | None
    path: str
    dropped: bool  # it or one around it is no part of an article
    heading_only: bool  # a header: only its headings count
    main: bool
    away: bool = False  # it or one around it is none by its tag or since it is hidden, whatever it holds
    named: bool = False  # its own names say that it is none
    readers: bool = False  # they say that readers wrote it


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    known: str | None = None

    def text(self) -> str:
        if self.known is None:
            self.known = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
        return self.known


def _attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): m[1] or m[2] or m[3] for m in reversed(_ATTRIBUTE.findall(raw))} if raw.strip(" /") else {}


def _names(value: str) -> list[list[str]]:
    """Words of each class or id name; those from has, with, no or without on tell of something else on the page."""
    names = []
    for name in value.split():
        words = [w.lower() for w in _NAME.findall(name)]
        names.append(words[: next((i for i, w in enumerate(words) if w in BESIDES), len(words))])
    return names


def _marks(names: list[list[str]], leading: bool) -> set[str]:
    """Marks among names: a name whose words are all marks or places counts, and one that begins with a mark if `leading`.

    A word within a name says little: related-work and search-strategy are headings of an article.
    """
    marks: set[str] = set()
    for words in names:
        own = [w for w in words if w in MARKS or w in HEADER]
        if own and all(w in MARKS or w in PLACES for w in words):
            marks.update(w for w in own if w in MARKS or len(own) == 1)
        elif leading and words and words[0] in MARKS | HEADER:
            marks.add(words[0])
    return marks


def opened(tag: str, raw: str, parent: Element | None) -> Element:
    own = _attributes(raw)
    classes = sorted({_DIGITS.sub("#", c.lower()) for c in html.unescape(own.get("class", "")).split()})
    step = ".".join([tag, *classes])
    path = f"{parent.path}>{step}" if parent else step
    role = _names(own.get("role", ""))
    names = _names(own.get("class", ""))
    # of headings and paragraphs only a whole name tells: notice-period and share-price are what they are about
    marks = _marks(names, tag not in RUNNING) | _marks(role, tag not in RUNNING)
    if tag not in RUNNING:  # their ids are made of their words
        marks |= _marks(_names(own.get("id", "")), False)
    main = tag in {"article", "main"} or ["main"] in role or own.get("itemprop") == "articleBody"
    header = tag == "header" or bool(marks & HEADER)
    named = bool(marks & (MARKS - HEADER))
    away = tag in ASIDE or "hidden" in own or own.get("aria-hidden") == "true"
    away |= "display:none" in own.get("style", "").replace(" ", "").lower()
    if tag in {"html", "body"} or (main and tag == "article"):
        away = named = header = False
    if main:
        named = header = False
    # the header of a post is that of an article, too
    inside = (parent and parent.main) or any(w and w[0] in {"post", "entry", "article"} and "header" in w for w in names)
    named |= header and not inside
    away |= bool(parent and parent.away)
    return Element(
        tag, parent, path, bool(parent and parent.dropped) or away or named,
        bool(parent and parent.heading_only) or (header and bool(inside)), main or bool(parent and parent.main), away, named,
        bool(marks & READERS) or bool(parent and parent.readers),
    )


def running_text(block: Block) -> int:
    """Characters of a block that are not linked."""
    return max(0, len(block.text()) - 2 * block.linked)


def settle(blocks: list[Block]) -> None:
    """Takes back what names say where they cannot be right: a wrapper around the article is no sidebar.

    A named element counts as a wrapper if it holds more than half of the page's running text and this is in one article
    or main element, or little is left without it. What is marked within it is still dropped.
    """
    elements: dict[int, tuple[Element, dict[int, int]]] = {}  # by named element: text below, by the article in it (0: none)
    total = rest = 0
    for block in blocks:
        e = block.element
        if e.away or not (worth := running_text(block)):
            continue
        total += worth
        rest += 0 if e.dropped else worth
        article = 0
        while e is not None and e.tag:
            if e.named:
                sums = elements.setdefault(id(e), (e, {}))[1]
                sums[article] = sums.get(article, 0) + worth
            if e.tag in {"article", "main"} or (e.main and not (e.parent and e.parent.main)):
                article = id(e)
            e = e.parent
    wrappers = []
    for e, sums in elements.values():
        whole, article = sum(sums.values()), max((n for a, n in sums.items() if a), default=0)
        if not e.readers and (2 * article > total or (2 * whole > total and 4 * rest < whole)):
            wrappers.append(e)
            e.named = False
    if not wrappers:
        return
    for block in blocks:
        e = block.element
        around = []
        while e is not None:
            around.append(e)
            e = e.parent
        dropped = False
        for e in reversed(around):
            dropped = e.dropped = dropped or e.away or e.named


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, with the element that each stands in. A page without a body tag is one body."""
    root = Element("", None, "", False, False, False)
    stack = [root] if _BODY.search(page) else [root, opened("body", "", None)]
    blocks: list[Block] = []
    now = Block(stack[-1])
    unclosed: set[str] = set()  # elements that nothing from here on closes
    links = 0  # open links
    at = 0

    def write(text: str) -> None:
        if text:
            now.parts.append(text)
            if links:
                now.linked += len(text.strip())

    def finish() -> None:
        nonlocal now
        if now.parts:
            blocks.append(now)
        now = Block(stack[-1])

    def close(to: int) -> None:
        del stack[to:]
        finish()

    while token := _TOKEN.search(page, at):
        write(page[at : token.start()])
        at = token.end()
        end, tag, raw = token[1] or token[4], (token[2] or token[5] or "").lower(), token[3] or token[6] or ""
        if not tag:
            continue
        if end:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "p" and all(e.tag != "p" for e in stack):
                finish()
            elif tag in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        close(i)
                        break
            continue
        if tag in RAW:
            if not raw.endswith("/") and tag not in unclosed:
                closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if closing:
                    at = closing.end()
                elif tag in TO_THE_END:
                    at = len(page)
                else:
                    unclosed.add(tag)
            continue
        if tag == "br":
            write("\n")
        elif tag == "a":
            links = 1
        elif tag in BLOCKS:
            links = 0 if tag not in HEADINGS else links
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or (stack[i].tag in HEADINGS and tag in HEADINGS):
                    del stack[i:]
                    break
                if stack[i].tag in CONTAINERS:
                    break
            if tag in SIBLINGS:
                same, around = SIBLINGS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in same:
                        del stack[i:]
                        break
                    if stack[i].tag in around:
                        break
            if tag == "body" and any(e.tag == "body" for e in stack):
                continue
            if tag != "hr":
                stack.append(opened(tag, raw, stack[-1] if stack[-1].tag else None))
            finish()
    write(page[at:])
    finish()
    if any(b.element.dropped and not b.element.away for b in blocks):
        settle(blocks)
    return blocks


def kept(block: Block) -> bool:
    e = block.element
    if e.dropped:
        return False
    if not e.heading_only:
        return True
    while e is not None:
        if e.tag in HEADINGS:
            return True
        e = e.parent
    return False


def container_scores(blocks: list[Block]) -> dict[str, float]:
    """Score of each generalised path: the running text below it, less links; the next containers outwards get less.

    Each container outwards counts half of the one within, but an article or main element, which says what it is,
    counts in full whatever lies between.
    """
    scores: dict[str, float] = {}
    for block in blocks:
        if not kept(block):
            continue
        worth = len(block.text()) - 2.0 * block.linked
        if worth <= 0:
            continue
        if block.element.tag not in RUNNING and not block.element.main:
            worth /= 2
        e, share = block.element, 1.0
        while e is not None and e.tag:
            if e.tag in CONTAINERS:
                said = e.tag in {"article", "main"}
                scores[e.path] = scores.get(e.path, 0.0) + worth * (1.5 if said else share)
                share /= 2
            e = e.parent
    return scores


def best_path(blocks: list[Block], scores: dict[str, float]) -> str:
    """The path of the best score, or that of a container around it which adds a title or running text.

    Scores halve outwards, so that the best container may be one part of an article. An outer one is taken if what it
    adds is headings before the part and running text with few links, rather than links and scraps. What follows an
    article or main element is none of it.
    """
    best = min(scores, key=lambda p: (-scores[p], p))
    level: dict[str, int] = {}  # the best path and those around it, from within
    around: list[Element] = []
    for block in blocks:
        e = block.element
        while e is not None and e.path != best:
            e = e.parent
        if e is not None and e.tag:
            while e is not None and e.tag:
                level[e.path] = len(around)
                around.append(e)
                e = e.parent
            break
    good, poor = [0] * len(around), [0] * len(around)
    begun = False
    for block in blocks:
        if not kept(block) or not (text := block.text()):
            continue
        e = block.element
        while e is not None and e.path not in level:
            e = e.parent
        if e is None:
            continue
        at, n, tag = level[e.path], len(text), block.element.tag
        begun |= at == 0
        if 3 * block.linked > n or (begun and around[0].main):
            fits = False
        elif tag in HEADINGS:
            fits = not begun
        else:
            fits = n >= (RUNNING_CHARS if tag in RUNNING else 4 * RUNNING_CHARS)
        (good if fits else poor)[at] += n
    taken, more, less = best, 0, 0
    for i in range(1, len(around)):
        more, less = more + good[i], less + poor[i]
        if around[i].tag in CONTAINERS and more > less:
            taken, more, less = around[i].path, 0, 0
    return taken


def votes(page: str) -> list[tuple[str, float]]:
    """The page's paths, best first, each with its share of the best score; a container around the best takes its place."""
    return ranked(blocks_of(page))


def ranked(blocks: list[Block]) -> list[tuple[str, float]]:
    """Every path of a container with text; those whose text has no score come last and vote with 0."""
    scores = container_scores(blocks)
    holding: set[str] = set()
    for block in blocks:
        if kept(block) and block.text():
            e = block.element
            while e is not None and e.tag:
                if e.tag in CONTAINERS:
                    holding.add(e.path)
                e = e.parent
    rest = [(p, 0.0) for p in sorted(holding - scores.keys())]
    if not scores:
        return rest
    top = best_path(blocks, scores)
    best = max(scores.values())
    others = sorted(((-n, p) for p, n in scores.items() if p != top))
    # what lies within the container that is taken has no more votes than that had by itself
    return [(top, 1.0), *((p, min(-n, scores[top]) / best) for n, p in others), *rest]


def below(blocks: list[Block], paths: list[str]) -> tuple[list[str], list[list[int]]]:
    """The texts that are kept, in page order, and for each path the places of those that lie below it."""
    texts: list[str] = []
    places: dict[str, list[int]] = {p: [] for p in paths}
    for block in blocks:
        if not kept(block) or not (text := block.text()):
            continue
        around = set()
        e = block.element
        while e is not None:
            around.add(e.path)
            e = e.parent
        for path in around & places.keys():
            places[path].append(len(texts))
        texts.append(text)
    return texts, [places[p] for p in paths]


def own_or_all(own: list[tuple[str, float]], texts: list[str], places: list[list[int]]) -> list[int]:
    """Where a page has nothing along the paths of its host: its own best one, or all of it where no container scores."""
    return places[0] if own and own[0][1] > 0 else list(range(len(texts)))


def main_text(page: str, path: str | None) -> str:
    """The text along the host's path, or along the page's own best one where the page has nothing there."""
    blocks = blocks_of(page)
    own = ranked(blocks)
    texts, places = below(blocks, [p for p, _ in own])
    along = dict(zip((p for p, _ in own), places, strict=True)).get(path) or own_or_all(own, texts, places)
    return "\n\n".join(texts[i] for i in along)


def kind_of(paths: list[str]) -> str:
    """128 bits that stand for a ranking."""
    return blake2b("\n".join(paths).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for every row, from its whole html.

    Blocks are in page order with an empty line between them, white space within a block is one space. A null or empty
    html gives an empty text; a null url is a host of its own name (empty); key and url are passed on as they are,
    repeated rows too; an empty table gives an empty one; other columns are not read.
    """
    base.short_batches(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{page}`"), F.lit("")).alias("text")
    ).withColumn("host", host_of(F.col("url")))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch):
                sums: dict[tuple[str, str], tuple[list[str], list[int]]] = {}
                for host, page in zip(part.column("host").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if own := votes(page):
                        paths = [path for path, _ in own]
                        _, added = sums.setdefault((host, kind_of(paths)), (paths, [0] * (len(own) + 1)))
                        added[0] += 1
                        for i, (_, share) in enumerate(own, 1):
                            added[i] += round(share * 1_000_000)  # whole numbers: the order of rows does not show
                columns = [pa.array([h for h, _ in sums], pa.string()), pa.array([k for _, k in sums], pa.string())]
                columns += [pa.array([p for p, _ in sums.values()], pa.list_(pa.string()))]
                columns += [pa.array([v[0] for _, v in sums.values()], pa.int64())]
                columns += [pa.array([v[1:] for _, v in sums.values()], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["host", "kind", "paths", "pages", "votes"])

    # pages of a host that rank the same paths alike are one row of each slice
    cast = rows.select("host", "text").mapInArrow(vote, "host string, kind string, paths array<string>, pages long, votes array<long>")
    cast = base.staged(cast, "host-ranks")
    paths = cast.select("host", "kind", "pages", "votes", F.posexplode("paths").alias("place", "path"))
    added = paths.groupBy("host", "path").agg(
        F.sum(F.expr("votes[place]")).alias("votes"), F.sum(F.when(F.expr("place = 0 and votes[0] > 0"), F.col("pages")).otherwise(0)).alias("leads")
    )
    added = base.staged(added, "host-votes")
    # of equal votes the first path by name
    first = added.where("votes > 0").groupBy("host").agg(F.min(F.struct(-F.col("votes"), "path")).alias("best")).select("host", F.col("best.path").alias("path"))
    first = base.staged(first, "host-paths")
    winners = added.where(F.col("leads") >= LEADS).select("host", "path").unionByName(first).distinct()
    places = paths.join(winners, ["host", "path"]).groupBy("host", "kind").agg(F.min("place").alias("place"))
    key_type = dict(rows.dtypes)["page_id"]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in base.slices(batch):
                kinds, texts, spans, others = [], [], [], []
                for page in part.column("text").to_pylist():
                    blocks = blocks_of(page)
                    own = ranked(blocks)
                    around = [p for p, _ in own]
                    kept_texts, along = below(blocks, around)
                    kinds.append(kind_of(around))
                    texts.append(kept_texts)
                    spans.append(along)
                    others.append(own_or_all(own, kept_texts, along))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in ("page_id", "url", "host")), pa.array(kinds, pa.string()),
                        pa.array(texts, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                        pa.array(others, pa.list_(pa.int32())),
                    ],
                    ["page_id", "url", "host", "kind", "texts", "spans", "other"],
                )

    found = rows.mapInArrow(
        extract,
        f"page_id {key_type}, url string, host string, kind string, texts array<string>, spans array<array<int>>, other array<int>",
    )
    found = found.join(base.staged(places, "host-places"), ["host", "kind"], "left")
    along = F.coalesce(F.when(F.size(F.expr("spans[place]")) > 0, F.expr("spans[place]")), F.col("other"))
    found = found.select("page_id", "url", F.array_join(F.transform(along, lambda i: F.get("texts", i)), "\n\n").alias("text"))
    return found.select("*", F.length("text").cast("long").alias("n_chars"))
