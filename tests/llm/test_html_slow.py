"""Consensus extraction against a slow walk over a tree that the standard library's parser builds."""
import hashlib
import html
import random
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser
from itertools import chain, takewhile

import pytest

from aspectra.llm import html as fixed
from aspectra.llm.html import main_text
from aspectra.llm.queries import QUERIES

RAW = set(fixed.RAW.split("|"))
CUT = object()  # a block boundary that opens or closes nothing


class Node:
    def __init__(self, tag, attrs=(), parent=None):
        given = dict(reversed([(k, v or "") for k, v in attrs]))
        self.tag, self.parent, self.children = tag, parent, []
        words = given.get("class", "").lower().split()
        self.label = ".".join([tag, *sorted({re.sub(r"\d", "", w) for w in words} - {""})])
        names = set(re.findall("[a-z]+", (given.get("class", "") + " " + given.get("id", "")).lower()))
        style = given.get("style", "").lower().replace(" ", "")
        self.dropped = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
        if tag == "article":
            self.dropped |= bool(names & set("ad ads advert advertisement sponsored promo comment comments reply related recommended".split()))
        elif tag not in ("html", "body", "main"):
            self.dropped |= tag in fixed.DROPPED_TAGS or bool(names & fixed.DROPPED_NAMES) or given.get("role", "").lower() in fixed.DROPPED_ROLES
        self.weight = 1.25 if tag in ("article", "main") else 1.1 if names & fixed.ARTICLE_NAMES else 1.0

    def up(self):
        node = self
        while node is not None:
            yield node
            node = node.parent


class Tree(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.root = self.at = Node("")
        self.whole = False  # does a new piece of text go on the last one?
        self.feed(page)
        self.close()

    def block(self):
        """The innermost open block; inline elements end at its boundaries."""
        while self.at.tag in fixed.INLINE:
            self.at = self.at.parent

    def ends(self, tags, scope):
        for node in self.at.up():
            if node.tag in tags:
                self.at = node.parent
                return
            if node.tag in scope or node.parent is None:
                return

    def handle_starttag(self, tag, attrs):
        self.whole = False
        if tag in fixed.VOID and tag != "hr":
            self.at.children += [" "] if tag == "br" else []
            return
        if tag not in fixed.INLINE and tag not in RAW:
            self.block()
            self.at.children.append(CUT)
            if tag in fixed.ENDS:
                self.ends(fixed.ENDS[tag], fixed.SCOPE - {tag})
            elif tag in fixed.ENDS_P:
                self.ends(("p",), fixed.SCOPE)
        if tag != "hr":
            self.at = Node(tag, attrs, self.at)
            self.at.parent.children.append(self.at)

    def handle_endtag(self, tag):
        self.whole = False
        if tag in fixed.VOID:
            return
        if tag not in fixed.INLINE and tag not in RAW:
            self.block()
            self.at.children.append(CUT)
        self.ends((tag,), fixed.SCOPE | fixed.ENDS_P if tag in fixed.INLINE else ())

    def handle_comment(self, data):
        self.whole = False

    def handle_data(self, data):
        if self.whole:
            data = self.at.children.pop() + data
        self.at.children.append(data)
        self.whole = True

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def container(node):
    return next(n for n in node.up() if n.tag in fixed.CONTAINER or not n.tag)


def path(node):
    if not node.tag:
        return ""
    return hashlib.blake2b(f"{path(container(node.parent))}/{node.label}".encode(), digest_size=8).hexdigest()


def blocks(node):
    """(block element, text, characters in links) below ``node`` in page order."""
    run = []

    def inline(n):
        for child in n.children:
            if child is CUT or isinstance(child, Node) and child.tag not in fixed.INLINE and child.tag not in RAW:
                yield child
            elif isinstance(child, str):
                around = list(takewhile(lambda a: a.tag in fixed.INLINE, n.up()))
                if not any(a.dropped for a in around):
                    run.append((child, any(a.tag == "a" for a in around)))
            elif child.tag not in RAW:
                yield from inline(child)

    for child in chain(inline(node), [CUT]):
        text = " ".join(html.unescape("".join(t for t, _ in run)).split())
        if text:
            yield node, text, sum(len(t.strip()) for t, linked in run if linked)
        run.clear()
        if child is not CUT:
            yield from blocks(child)


def gone(node):
    return any(n.dropped for n in node.up())


def inside(node, tags):
    return any(n.tag in tags for n in node.up())


def scores(tree):
    found, own = defaultdict(float), defaultdict(float)
    for node, text, linked in blocks(tree.root):
        if not gone(node) and not inside(node, ("header",)):
            share = float(max(0, len(text) - 2 * linked))
            at = container(node)
            while at is not None:
                own[at] += share
                share *= 0.75
                at = container(at.parent) if at.parent is not None else None
    for node, held in own.items():
        if held:
            found[path(node)] = max(found[path(node)], held * node.weight)
    return found


def text_of(tree, chosen):
    lines = []
    for node, text, _ in blocks(tree.root):
        match = [n for n in node.up() if (n.tag in fixed.CONTAINER or not n.tag) and path(n) == chosen]
        title = match and match[0].weight > 1 and inside(node, fixed.HEADINGS)
        if match and not gone(node) and (title or not inside(node, ("header",))):
            lines.append(text)
    return "\n".join(lines)


def slow(rows):
    """[(page_id, text)] of [(page_id, url, html)]."""
    trees, votes = [Tree(page or "") for _, _, page in rows], defaultdict(Counter)
    hosts = [(re.match(r"[A-Za-z][\w+.-]*://([^/?#]+)", url or "") or [None, ""])[1].lower() for _, url, _ in rows]
    for host, tree in zip(hosts, trees):
        found = scores(tree)
        for p, s in found.items():
            votes[host][p] += round(1000 * s / max(found.values()))
    out = []
    for (page_id, *_), host, tree in zip(rows, hosts, trees):
        text = text_of(tree, max(votes[host], key=lambda p: (votes[host][p], p))) if host and votes[host] else ""
        if not text:
            found = scores(tree)
            text = text_of(tree, max(found, key=lambda p: (found[p], p))) if found else ""
        out.append((page_id, text))
    return out


NAMES = ["content", "c7", "post-12", "box", "wrap", "entry", "comments", "ad", "sidebar", "promo1", "x y2"]


def markup(rng, depth=0):
    words = lambda: " ".join(rng.choice(["wort", "text", "a &lt; b", "caf&eacute;", "&#8212;", "eins&nbsp;zwei", "fin."]) for _ in range(rng.randint(1, 25)))
    inline = lambda: rng.choice(["{}", "<b>{}", "<a href='/q'>{}</a>", "<em>{}</em><br>", "<span class=ad>{}<span>z</span></span>", "<!-- {} -->", "<i>{}</i>"]).format(words())
    name = lambda: rng.choice(["", "", f" class='{rng.choice(NAMES)}'", f' id="{rng.choice(NAMES)}"', " hidden", " style='display: none'", " role=main"])
    kinds = ["p"] * 5 + ["ul", "script", "hr", "h2", "stray"] + (["div", "section", "article", "table", "header", "nav", "aside", "main", "form"] * 2 if depth < 4 else [])
    out = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.choice(kinds)
        if kind == "p":
            out.append(f"<p{name()}>{inline()} {inline()}" + rng.choice(["</p>", "", "\n"]))
        elif kind == "ul":
            out.append(f"<ul{name()}><li>{inline()}<li>{inline()}</ul>")
        elif kind == "table":
            out.append(f"<table><tr><td{name()}>{inline()}<td>{markup(rng, depth + 1)}</table>")
        elif kind == "script":
            out.append("<script>if (a < b) document.write('<p>no</p>')</script>")
        elif kind == "hr":
            out.append("<hr>" + words())
        elif kind == "stray":
            out.append(inline() + "</em>")
        else:
            out.append(f"<{kind}{name()}>{words() if kind == 'h2' else markup(rng, depth + 1)}</{kind}>")
    return "".join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_pages_as_by_slow_walk(spark, seed):
    rng = random.Random(seed)
    layout = [markup(rng) for _ in range(3)]
    rows = []
    for i in range(90):
        page = f"<!DOCTYPE html><html><body class=p{i}>{rng.choice(['', '<header><h1>Site</h1></header>'])}{layout[i % 3] if rng.random() < 0.5 else ''}{markup(rng)}</body></html>"
        rows.append((i, f"https://h{i % 3 if i % 2 else 0}.example/{i}", page))
    rows += [rows[4], rows[4], (90, None, rows[7][2]), (91, "no host", rows[8][2]), (92, "https://h1.example", None), (93, "https://h1.example", ""), (None, "https://h9.example", rows[9][2])]
    rows.append((94, "https://h0.example/long", "<html><body class=p>" + "<p>long text here" * 4000))
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, votes int").repartition(5)
    assert Counter((r.page_id, r.text) for r in main_text(pages).collect()) == Counter(slow(rows))


def test_whole_table_as_by_slow_walk(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op9_html_consensus"](spark, sf_dir).collect()
    assert Counter((r.page_id, r.text) for r in got) == Counter(slow(rows))
    assert all(r.n_chars == len(r.text) for r in got)


def test_winning_path_in_a_dropped_part(spark):
    rows = [(i, "https://a.example/", f"<body><div id=x{i}><div class=content><p>{'good words ' * 9}{i}</p></div></div></body>") for i in range(3)]
    rows.append((3, "https://a.example/", "<body><div id=x><div class=content><p>the article</p></div></div><div id=comments><div class=content><p>a reader said</p></div></div></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in main_text(pages).collect()}[3] == "the article"
    assert slow(rows)[3] == (3, "the article")
