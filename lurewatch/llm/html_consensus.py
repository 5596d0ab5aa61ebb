"""Main text of web pages by consensus of each host's pages.

1. Each page's containers are scored: a block of text counts fully for the
   container that holds it, half for the next one up, and so on; text inside
   links does not count. Lists, tables, quotes and the like belong to what is around
   them, all inside an article to the article, and a container to the one around it
   that holds paragraphs or headings of its own, or several divs of plain text
   (``_levels``). Menus, adverts and the like are left out by tag and by the words of
   class and id; a container with such words stays if it holds most of the page's
   text, and if it is named after comments, cookies or the like only together with
   the page's heading. Names of a state (``comments-open``, ``ad-free``) do not count,
   and beside a class of articles (``post``, ``content``) all words are just weighed.
   A header stays inside an article or main, and beside paragraphs.
2. The pages of a host vote, with the share of the score, for container paths whose
   steps are tag and classes without digits. Spark sums the votes by host and path
   (a third of all pages on one host leave each task as a few rows).
3. Every page is extracted anew from the path that won on its host; a page without
   such a container uses the best of its own.

The winners are one small row for each host. They are written first, so Spark knows
their size and broadcasts them only below its threshold; otherwise it shuffles, and
adaptive execution splits a host that many pages share.

Null html gives empty text; null URL, or one without a host, votes in the group of
the empty host. Repeated rows are extracted one by one, ties of votes go to the
smaller path, an empty table gives an empty result, and columns besides id, URL
and html are not read. Pages are read whole.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lurewatch.llm.common import stored
from lurewatch.llm.url_filter import host_of

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea|noscript|template|iframe|svg|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[!?/][^>]*>|<[a-z][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_CONTAINERS = frozenset(
    "html body main article section div header footer nav aside form table tbody tr td th ul ol dl li "
    "blockquote figure fieldset details center head menu dialog".split()
)
_BLOCKS = _CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 pre dt dd hr figcaption address summary caption legend option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What never belongs to the article, by tag and by words of class, id or role.
_LEFT_OUT_TAGS = frozenset("head nav footer aside form menu dialog button select".split())
_LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent notice notices alert popup modal overlay sidebar sidebars menu menus nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead comment comments disqus respond reply replies related recommended "
    "share sharing social newsletter subscribe subscription signup login search pagination pager widget toolbar "
    "complementary contentinfo".split()
)
#: Words that leave text out however much it is, unless the container holds the page's heading too.
_STRICT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising cookie cookies consent popup modal overlay nav navbar navigation "
    "comment comments disqus respond reply replies".split()
)
#: Words of articles: beside a class of these, the others tell a state and are only weighed.
_OWN_WORDS = frozenset("article post content entry story text hentry single body main page".split())
#: Classes that tell what stands beside the container, or in what state the page is.
_BESIDE = re.compile(r"(?:has|have|with|without|no)[-_]|.*[-_](?:open|closed|free|enabled|disabled|allowed|off)\Z")
#: Containers that never are the article by themselves.
_WRAPPERS = frozenset("header ul ol dl li table tbody tr blockquote figure fieldset details center".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
_CLOSED_BY_SAME = frozenset(("li", "tr", "td", "th", "option"))


class Block:
    """A run of text: the container that holds it directly (``owner``) and the one around that (``parent``)."""

    __slots__ = ("steps", "out", "text", "linked", "prose", "owner", "parent")

    def __init__(self, steps: tuple[str, ...], out: bool, text: str, linked: int, prose: bool, owner: int, parent: int):
        self.steps, self.out, self.text, self.linked, self.prose = steps, out, text, linked, prose
        self.owner, self.parent = owner, parent

    @property
    def plain(self) -> int:
        return len(self.text) - self.linked


class Doubt:
    """A container that its name, or its place, leaves out unless the page says otherwise."""

    __slots__ = ("kind", "parent", "holds", "heading")

    def __init__(self, kind: str, parent: int):
        self.kind, self.parent, self.holds, self.heading = kind, parent, 0, False

    def drops(self, total: int, with_prose: set[int]) -> bool:
        if self.kind == "header":
            return self.parent not in with_prose
        return 2 * self.holds <= total or self.kind == "strict" and not self.heading


class Open:
    """A container that is not closed yet."""

    __slots__ = ("tag", "steps", "out", "doubts", "number", "parent")

    def __init__(self, tag: str, steps: tuple[str, ...], out: bool, doubts: tuple[Doubt, ...], number: int, parent: int):
        self.tag, self.steps, self.out, self.doubts, self.number, self.parent = tag, steps, out, doubts, number, parent


def _step(tag: str, attrs: str) -> tuple[str, str]:
    """Tag with its classes less digits, and how the words of class, id and role count."""
    tokens, classes = [], []
    for name, value in _NAMED.findall(attrs):
        value = value.strip("\"'").lower()
        tokens += [set(re.findall(r"[a-z]+", token)) for token in value.split() if not _BESIDE.match(token)]
        if name.lower() == "class":
            classes = sorted({re.sub(r"\d+", "#", c) for c in value.split()})
    kind = ""
    if any(words & _LEFT_OUT_WORDS for words in tokens):
        own = any(words & _OWN_WORDS and not words & _LEFT_OUT_WORDS for words in tokens)
        kind = "strict" if not own and any(words & _STRICT_WORDS for words in tokens) else "weighed"
    return ".".join([tag, *classes]), kind


def page_blocks(source: str) -> list[Block]:
    """Blocks of text in page order with the path of the container that holds each."""
    blocks: list[Block] = []
    stack, opened = [Open("", (), False, (), 0, 0)], 0
    under: list[tuple[Doubt, ...]] = []
    parts: list[str] = []
    in_link, linked, at, prose = 0, 0, 0, False

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            blocks.append(Block(top.steps, top.out, text, min(linked, len(text)), prose, top.number, top.parent))
            under.append(top.doubts)
        parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        linked += len(text) if in_link else 0

    for m in _TOKEN.finditer(source):
        if m.start() > at:
            add(source[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = 0 if m["close"] else 1
        elif tag in _BLOCKS:
            flush()
            prose = tag in _PROSE and not m["close"]
            if tag in ("h1", "main") and not m["close"]:
                for doubt in stack[-1].doubts:
                    doubt.heading = True
            if tag not in _CONTAINERS:
                continue
            if m["close"]:
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
                if depth:
                    del stack[depth:]
                    in_link = 0
            elif tag not in _VOID:
                if tag in _CLOSED_BY_SAME and stack[-1].tag == tag:
                    stack.pop()
                step, kind = _step(tag, m["attrs"] or "")
                top, doubts = stack[-1], stack[-1].doubts
                if kind and tag not in ("html", "body", "article", "main"):
                    doubts = (*doubts, Doubt(kind, top.number))
                if tag == "header" and not any(_tag(s) in ("article", "main") for s in top.steps):
                    # a header beside the paragraphs of an article holds its title
                    doubts = (*doubts, Doubt("header", top.number if top.tag not in ("", "html", "body") else -1))
                opened += 1
                stack.append(Open(tag, (*top.steps, step), top.out or tag in _LEFT_OUT_TAGS, doubts, opened, top.number))
    if at < len(source):
        add(source[at:])
    flush()
    total = 0
    for b, doubts in zip(blocks, under):
        if not b.out:
            total += b.plain
            for doubt in doubts:
                doubt.holds += b.plain
    with_prose = {b.owner for b in blocks if b.prose and not b.out and b.plain}
    for b, doubts in zip(blocks, under):
        b.out = b.out or any(doubt.drops(total, with_prose) for doubt in doubts)
    return blocks


def _tag(step: str) -> str:
    return step.split(".", 1)[0]


def _levels(steps: tuple[str, ...], direct: set[tuple[str, ...]]) -> list[int]:
    """Depths of the containers that may be the article of a block, the nearest first.

    ``direct`` names the containers with paragraphs of their own (``_with_paragraphs``).
    """
    levels = [d for d in range(len(steps), 0, -1) if _tag(steps[d - 1]) not in _WRAPPERS]
    article = next((d for d in levels if _tag(steps[d - 1]) == "article"), 0)
    if article:
        return [d for d in levels if d <= article]
    while len(levels) > 1:
        inner, outer = _tag(steps[levels[0] - 1]), _tag(steps[levels[1] - 1])
        page = outer in ("html", "body")
        own = steps[: levels[1]] in direct
        # cells side by side may lay out the page, and body holds more than the article
        if own and (not page or inner in ("section", "td", "th")) or inner == "section" and not page:
            levels.pop(0)
        else:
            break
    return levels or [1] * bool(steps)


def _with_paragraphs(blocks: list[Block]) -> set[tuple[str, ...]]:
    """Containers with paragraphs or headings of their own, or whose paragraphs are divs of plain text."""
    direct, divs = set(), {}
    for b in blocks:
        if b.out or not b.plain:
            continue
        depth = next((d for d in range(len(b.steps), 0, -1) if _tag(b.steps[d - 1]) not in _WRAPPERS), 0)
        if b.prose:
            direct.add(b.steps[:depth])
        elif depth == len(b.steps) > 1 and _tag(b.steps[-1]) == "div" and _tag(b.steps[-2]) not in ("html", "body"):
            divs.setdefault((b.parent, b.steps[:-1]), set()).add(b.owner)
    return direct | {steps for (_, steps), owners in divs.items() if len(owners) > 1}


def container_scores(blocks: list[Block]) -> dict[str, float]:
    scores: dict[str, float] = {}
    direct = _with_paragraphs(blocks)
    for b in blocks:
        if b.out:
            continue
        share = float(b.plain)
        for depth in _levels(b.steps, direct):
            path = "/".join(b.steps[:depth])
            scores[path] = scores.get(path, 0.0) + share
            share /= 2
    return {p: s for p, s in scores.items() if s > 0}


def article_text(blocks: list[Block], winner: str | None) -> str:
    inside = lambda path: [b.text for b in blocks if not b.out and ("/".join(b.steps) + "/").startswith(path + "/")]
    texts = inside(winner) if winner else []
    if not texts:
        scores = container_scores(blocks)
        texts = inside(min(scores, key=lambda p: (-scores[p], p))) if scores else [b.text for b in blocks if not b.out]
    return "\n\n".join(texts)


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Winning container path of each host: host, path."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, shares = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
                scores = container_scores(page_blocks(source.as_py() or ""))
                total = sum(scores.values())
                for path, score in scores.items():
                    hosts.append(host)
                    paths.append(path)
                    # whole millionths, so that sums do not depend on their order
                    shares.append(round(1e6 * score / total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())],
                ["host", "path", "share"],
            )

    cast = pages.select(host_of(pages[url_col]).alias("host"), pages[html_col].cast("string").alias("html"))
    summed = cast.mapInArrow(votes, "host string, path string, share long").groupBy("host", "path").agg(
        F.sum("share").alias("votes")
    )
    return summed.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("best")).select(
        "host", F.col("best.path").alias("path")
    )


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row: id, url, text, n_chars."""
    winners = stored(host_paths(pages, url_col, html_col), "host-paths").withColumnsRenamed({"host": "__host", "path": "__path"})

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                article_text(page_blocks(source.as_py() or ""), winner)
                for source, winner in zip(batch.column(2), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    named = pages.select(
        pages[id_col].alias(id_col), pages[url_col].alias(url_col), pages[html_col].cast("string").alias("__html"),
        host_of(pages[url_col]).alias("__host"),
    )
    joined = named.join(winners, "__host", "left").select(id_col, url_col, "__html", "__path")
    return joined.mapInArrow(extract, f"`{id_col}` {kind}, `{url_col}` string, text string, n_chars long")
