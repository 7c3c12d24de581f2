"""Main text of web pages by consensus paths of their host.

1. Each page's containers are scored by the running text they hold (text in links, menus,
   forms, notices, adverts and comments does not count).
2. Every container votes for its generalised tag-class path on its host; votes are summed per
   task before they are shuffled, so a host with a third of all pages costs a row per path and
   task.
3. The host's winning path is read again on each page; a page without it uses its own best one.
"""
from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aspectra.llm.batches import column, slices
from aspectra.plans.materialize import materialize

#: Elements whose content is never text of a page.
RAW = "script|style|noscript|template|iframe|textarea|title|svg|object|canvas|xmp|math"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CONTAINER = frozenset("html body main article section div td center".split())
#: A start tag of the key ends an open element of the same group.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())
SCOPE = frozenset("html body main article section div td table ul ol dl aside nav form".split())
DROPPED_TAGS = frozenset("head nav footer aside form menu button select option fieldset dialog".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist respond reply replies "
    "discussion disqus widget widgets toolbar pagination pager search copyright disclaimer skip paywall".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
ARTICLE_NAMES = frozenset("article content post entry story body main text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


@lru_cache(maxsize=20_000)
def _element(tag: str, attrs: str) -> tuple[str, bool, float]:
    """(generalised label, dropped, weight of its text) of a start tag."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), entities.unescape(a or b or c))
    classes = sorted({re.sub(r"\d+", "", x) for x in found.get("class", "").lower().split()} - {""})
    label = tag + "".join("." + c for c in classes)
    names = {w for w in re.split(r"[^a-z]+", (found.get("class", "") + " " + found.get("id", "")).lower()) if w}
    bad = names & DROPPED_NAMES
    dropped = tag in DROPPED_TAGS or bool(bad) or found.get("role", "").lower() in DROPPED_ROLES
    if tag in ("html", "body", "main"):
        dropped = False
    elif tag == "article":
        dropped = bool(bad & {"ad", "ads", "advert", "advertisement", "sponsored", "promo", "comment", "comments", "reply", "related", "recommended"})
    dropped |= "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "").lower()) is not None
    weight = 1.25 if tag in ("article", "main") else 1.1 if names & ARTICLE_NAMES else 1.0
    return label, dropped, weight


class Page:
    """One pass over a page's tags: its containers and the text blocks that lie in them."""

    def __init__(self, page: str):
        #: (parent, path key, label, weight, dropped within its parent)
        self.containers: list[tuple[int, str, str, float, bool]] = [(-1, "", "", 1.0, False)]
        #: (container, text, characters in links, dropped within the container, heading, in a header)
        self.blocks: list[tuple[int, str, int, bool, bool, bool]] = []
        self._read(page)

    def _read(self, page: str) -> None:
        # open block elements: (tag, container, dropped within the container, heading, in a header)
        stack: list[tuple[str, int, bool, bool, bool]] = [("", 0, False, False, False)]
        text: list[str] = []
        link, link_chars, at = False, 0, 0
        hidden, depth = "", 0  # a dropped inline element and how many of its kind are open

        def flush() -> None:
            nonlocal link, link_chars, hidden
            if text:
                block = " ".join(entities.unescape("".join(text)).split())
                if block:
                    self.blocks.append((stack[-1][1], block, link_chars, *stack[-1][2:]))
                text.clear()
            link, link_chars, hidden = False, 0, ""

        def close(tags: tuple[str, ...], scope: frozenset[str]) -> None:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in tags:
                    del stack[k:]
                    return
                if stack[k][0] in scope:
                    return

        def take(piece: str) -> None:
            nonlocal link_chars
            if not hidden:
                text.append(piece)
                if link:
                    link_chars += len(piece.strip())

        for m in TOKEN.finditer(page):
            if m.start() > at:
                take(page[at : m.start()])
            at = m.end()
            tag = (m[3] or m[6] or "").lower()
            if not tag:
                continue
            ending = bool(m[2] or m[5])
            if tag in VOID and tag != "hr":
                if tag == "br":
                    take(" ")
            elif tag in INLINE:
                if tag == "a":
                    link = not ending
                if hidden == tag:
                    depth += -1 if ending else 1
                    if not depth:
                        hidden = ""
                elif not ending and not hidden and _element(tag, (m[4] or m[7] or "").strip())[1]:
                    hidden, depth = tag, 1
            elif ending:
                flush()
                close((tag,), frozenset())
            else:
                flush()
                if tag in ENDS:
                    close(ENDS[tag], SCOPE - {tag})
                elif tag in ENDS_P:
                    close(("p",), SCOPE)
                if tag in VOID:
                    continue
                label, dropped, weight = _element(tag, (m[4] or m[7] or "").strip())
                _, c, drop, heading, header = stack[-1]
                if tag in CONTAINER:
                    key = hashlib.blake2b(f"{self.containers[c][1]}/{label}".encode(), digest_size=8).hexdigest()
                    self.containers.append((c, key, label, weight, dropped or drop))
                    stack.append((tag, len(self.containers) - 1, False, heading, header))
                else:
                    stack.append((tag, c, drop or dropped, heading or tag in HEADINGS, header or tag == "header"))
        if at < len(page):
            take(page[at:])
        flush()

    def scores(self) -> dict[str, tuple[float, str]]:
        """path key: (score, label) of the containers that hold running text.

        A container counts the text directly in it and three quarters of its children's.
        """
        held, gone = [0.0] * len(self.containers), []
        for parent, _, _, _, dropped in self.containers:
            gone.append(dropped or (parent >= 0 and gone[parent]))
        for c, block, link_chars, dropped, _, header in self.blocks:
            if not (dropped or header):
                held[c] += max(0, len(block) - 2 * link_chars)
        found: dict[str, tuple[float, str]] = {}
        for c in range(len(held) - 1, -1, -1):
            parent, key, label, weight, _ = self.containers[c]
            if held[c] > 0 and not gone[c]:
                if parent >= 0:
                    held[parent] += 0.75 * held[c]
                found[key] = max(found.get(key, (0.0, label)), (held[c] * weight, label))
        return found

    def text(self, path: str) -> str:
        """The blocks of the containers of ``path``, without dropped parts, one line each."""
        kept: list[int] = []  # -1: in a dropped part, 0: outside, 1: in a container of the path, 2: in one for articles
        for parent, key, _, weight, dropped in self.containers:
            outer = kept[parent] if parent >= 0 else 0
            kept.append(-1 if dropped else outer or (key == path) * (2 if weight > 1 else 1))
        return "\n".join(
            block for c, block, _, dropped, heading, header in self.blocks
            if kept[c] > 0 and not dropped and not (header and (kept[c] < 2 or not heading))
        )


def best_path(found: dict[str, tuple[float, str]]) -> str | None:
    return max(found, key=lambda k: (found[k][0], k)) if found else None


def _vote_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, str, str], int] = defaultdict(int)
        for part in slices(batch, "html"):
            for host, page in zip(column(part, "host"), column(part, "html")):
                if host.is_valid:
                    found = Page(page.as_py()).scores()
                    top = max((s for s, _ in found.values()), default=1.0)
                    for key, (s, label) in found.items():
                        votes[host.as_py(), key, label] += round(1000 * s / top)
        yield pa.RecordBatch.from_pydict({
            "host": pa.array([k[0] for k in votes], pa.string()), "path": pa.array([k[1] for k in votes], pa.string()),
            "label": pa.array([k[2] for k in votes], pa.string()), "votes": pa.array(list(votes.values()), pa.int64()),
        })


def _text_task(carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                out = []
                for path, raw in zip(column(part, "path"), column(part, "html")):
                    page = Page(raw.as_py())
                    text = page.text(path.as_py()) if path.is_valid else ""
                    if not text:
                        own = best_path(page.scores())
                        text = page.text(own) if own is not None else ""
                    out.append(text)
                yield pa.RecordBatch.from_arrays([column(part, c) for c in carry] + [pa.array(out, pa.string())], [*carry, "text"])

    return run


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, label, votes): the winning path of each host; ties go to the larger key."""
    named = pages.select(_host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    votes = named.mapInArrow(_vote_task, "host string, path string, label string, votes long").groupBy("host", "path", "label").agg(F.sum("votes").alias("votes"))
    top = F.max(F.struct("votes", "path", "label")).alias("top")
    return votes.groupBy("host").agg(top).select("host", "top.path", "top.label", "top.votes")


def _host():
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.when(host != "", host)


def main_text(pages: DataFrame, carry: tuple[str, ...] = ("page_id", "url"), small: int = 32 << 20) -> DataFrame:
    """``carry`` columns and ``text`` (empty if none): one row per row of ``pages`` (url, html).

    Null and empty pages give an empty text. A page whose url names no host is judged by itself.
    Blocks stand in page order, one line each, white space inside a block as one space,
    character references decoded. The winning paths, a row per host, are sent to all tasks only
    while they take under ``small`` bytes; else they are joined by host.
    """
    winners = materialize(host_paths(pages).select("host", "path"), "html-paths")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 64)).first()[0] or 0
    rows = pages.select(*carry, _host().alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    joined = rows.join(F.broadcast(winners) if size <= small else winners, "host", "left").select(*carry, "path", "html")
    schema = pages.select(*carry, F.lit("").alias("text")).schema
    return joined.mapInArrow(_text_task(carry), schema)
