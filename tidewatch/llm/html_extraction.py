"""Main text of web pages: boosted trees judge the blocks of a page's tree, a decoding over the tree decides.

A page is parsed into blocks. Each block is described by its tag, the words of its class, id and role, its depth, the
density of text, links and blocks below it, and its siblings. Trees give it a probability of being main text. The
decoding then finds the best consistent answer for the whole page: below a block that is not main text nothing is,
below one that is some parts may not be (an advert between paragraphs), and only blocks whose ancestors are neither
may go either way.

The trees are fitted on the driver, from a bounded sample of pages that mark their article themselves: these pages,
and pages laid out anew from their parts, with menus, notices, forms, comments and so on in known places.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.boosting import BoostSettings, Trees, fit

# Elements of HTML by how they take part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript svg math iframe object canvas audio video textarea select button datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter output progress q "
    "ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr area embed link meta param source track".split()
)
CLOSED_BY_BLOCK = frozenset(["p", "h1", "h2", "h3", "h4", "h5", "h6"])
# An element of the key ends an open one of its values, up to the nearest holder of such elements.
SIBLINGS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
    "option": {"option"},
}
HOLDERS = frozenset("ul ol dl table article section main div body aside nav form blockquote".split())

# Words in class, id and role, by what they say.
ATTRIBUTE_WORDS = {
    "content": "content article main post entry story text body prose page-content maincontent articlebody blogpost".split(),
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs pager pagination tabs toc sitemap topbar".split(),
    "frame": "header masthead footer foot bottom copyright legal colophon contentinfo banner branding logo site-header".split(),
    "side": "sidebar side aside rail widget widgets related recommended complementary secondary trending tags popular".split(),
    "advert": "ad ads adv advert advertisement advertising adbox sponsor sponsored promo promotion promoted dfp teaser".split(),
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert newsletter subscribe paywall disclaimer".split(),
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback review reviews thread".split(),
    "form": "form search searchbox login signup signin register contact input field".split(),
    "share": "share sharing social follow like facebook twitter buttons toolbar tools meta byline author".split(),
}
_WORD_KIND = {word: k for k, words in enumerate(ATTRIBUTE_WORDS.values()) for word in words}
TAGS = (
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd div section article main nav header footer aside form fieldset table tr td th "
    "blockquote pre figure figcaption address details body #text".split()
)
_TAG = {tag: k + 1 for k, tag in enumerate(TAGS)}
TAG_GROUPS = (
    frozenset(["p", "blockquote", "pre"]),
    frozenset(["h1", "h2", "h3", "h4", "h5", "h6"]),
    frozenset(["li", "ul", "ol", "dl", "dt", "dd"]),
    frozenset(["article", "main"]),
    frozenset(["nav"]),
    frozenset(["header", "footer", "address"]),
    frozenset(["aside"]),
    frozenset(["form", "fieldset"]),
    frozenset(["table", "tr", "td", "th", "tbody", "thead"]),
)


class Block:
    __slots__ = ("tag", "kinds", "parent", "items", "depth", "text", "linked", "inputs", "hidden", "chars", "links", "blocks", "ends", "paragraphs", "controls")

    def __init__(self, tag: str, parent: Block | None, attributes=()):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.items: list[Block] = []
        self.text: list[str] = []  # direct text, of blocks without blocks below
        self.linked = self.inputs = 0
        self.hidden = False
        self.kinds = [0] * len(ATTRIBUTE_WORDS)
        for name, value in attributes:
            if name in ("class", "id", "role", "aria-label", "itemprop") and value:
                for word in value.lower().replace("_", "-").split():
                    for piece in {word, *word.split("-")}:
                        if piece in _WORD_KIND:
                            self.kinds[_WORD_KIND[piece]] = 1
            elif name == "hidden" or (name == "style" and value and "display:none" in value.replace(" ", "").lower()):
                self.hidden = True


class _Reader(HTMLParser):
    """Builds the tree of blocks; inline elements only leave their text, and whether it is in a link."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Block("#root", None)
        self.open: list[tuple[str, Block | None]] = []  # every open element, with its block if it is one
        self.places: dict[str, list[int]] = {}  # where in it the elements of each name are
        self.block = self.root
        self.run: Block | None = None
        self.unseen = self.links = 0

    def _enter(self, tag: str, block: Block | None) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, block))
        if block is not None:
            self.block, self.run = block, None

    def _leave(self, keep: int) -> None:
        while len(self.open) > keep:
            tag, block = self.open.pop()
            self.places[tag].pop()
            if tag == "a":
                self.links -= 1
            if tag in UNSEEN:
                self.unseen -= 1
            if block is not None:
                self.block, self.run = block.parent, None

    def _newest(self, tags) -> int:
        """Where the newest open element of these names is."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close(self, tags, stop) -> None:
        place = self._newest(tags)
        if place >= 0 and place >= self._newest(stop):
            self._leave(place)

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if tag == "body":
                self._close({"head"}, ())
            return
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], HOLDERS - {"div"})
        if tag not in INLINE and tag not in UNSEEN:
            self._close(CLOSED_BY_BLOCK, HOLDERS)
        if tag in ("input", "select", "textarea", "button"):
            self.block.inputs += 1
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif tag == "hr":
                self.run = None
            return
        if tag in UNSEEN:
            self.unseen += 1
            self._enter(tag, None)
        elif tag in INLINE:
            self.links += tag == "a"
            self._enter(tag, None)
        else:
            block = Block(tag, self.block, attrs)
            self.block.items.append(block)
            self._enter(tag, block)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in ("html", "body"):
            self._close({tag}, () if tag not in INLINE else HOLDERS | CLOSED_BY_BLOCK | {"li", "td"})

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)  # no page stops the job with one
        return end + 1 if end >= 0 else -1

    def handle_data(self, data):
        if self.unseen:
            return
        if self.run is None:
            if not data.strip():
                return
            self.run = Block("#text", self.block)
            self.block.items.append(self.run)
        self.run.text.append(data)
        if self.links:
            self.run.linked += len("".join(data.split()))


def parse(html: str) -> Block:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.root


def listed(root: Block) -> list[Block]:
    """All blocks in page order, each before what is below it, with sums of what is below."""
    order, stack = [], [root]
    while stack:
        block = stack.pop()
        items = block.items
        if len(items) == 1 and items[0].tag == "#text" and block.parent is not None:  # text of its own only
            block.text, block.linked, block.items = items[0].text, items[0].linked, []
        order.append(block)
        stack.extend(reversed(block.items))
    for block in reversed(order):
        text = " ".join("".join(block.text).split())
        block.text = text
        block.chars, block.links, block.blocks = len(text), block.linked, 1
        block.ends = text.count(".") + text.count("!") + text.count("?") + text.count(",")
        block.paragraphs = int(block.tag == "p" and len(text) > 40)
        block.controls = block.inputs
        for below in block.items:
            block.chars += below.chars
            block.links += below.links
            block.blocks += below.blocks
            block.ends += below.ends
            block.paragraphs += below.paragraphs
            block.controls += below.controls
    return order


def described(order: list[Block]) -> np.ndarray:
    """The features of every block."""
    whole = max(1, order[0].chars)
    places = {id(item): at for block in order for at, item in enumerate(block.items)}
    rows, above = [], {}
    for block in order:
        parent = block.parent
        if parent is None:
            kinds, tags, siblings = [0] * len(ATTRIBUTE_WORDS), [0] * len(TAG_GROUPS), [block]
        else:
            up_kinds, up_tags = above[id(parent)]
            kinds = [max(a, b) for a, b in zip(up_kinds, block.kinds, strict=True)]
            tags = [max(a, block.tag in group) for a, group in zip(up_tags, TAG_GROUPS, strict=True)]
            siblings = parent.items
        above[id(block)] = (kinds, tags)
        at = places.get(id(block), 0)
        before = siblings[at - 1].chars if at else 0
        after = siblings[at + 1].chars if at + 1 < len(siblings) else 0
        rows.append(
            [
                _TAG.get(block.tag, 0),
                block.depth,
                np.log1p(block.chars),
                block.links / max(1, block.chars),
                block.chars / block.blocks,
                block.blocks,
                block.ends / max(1, block.chars),
                block.paragraphs,
                block.controls,
                block.chars / whole,
                len(siblings),
                at / len(siblings),
                np.log1p(before),
                np.log1p(after),
                block.chars / max(1, parent.chars if parent else whole),
                int(block.hidden),
                *block.kinds,
                *kinds,
                *[int(block.tag in group) for group in TAG_GROUPS],
                *tags,
            ]
        )
    return np.array(rows, float)


def decoded(order: list[Block], p: np.ndarray) -> list[str]:
    """The texts of the most likely consistent set of blocks.

    A block is main text, is not, or holds both. Main text may hold blocks that are not, at a cost, so a short
    paragraph goes with its article; what is not main text holds nothing else.
    """
    p = np.clip(p, 1e-4, 1 - 1e-4)
    main, other, both, apart = np.log(p), np.log(1 - p), np.log(0.3), np.log(0.05)
    index = {id(block): k for k, block in enumerate(order)}
    best = [None] * len(order)
    for k in range(len(order) - 1, -1, -1):
        below = [best[index[id(b)]] for b in order[k].items]
        as_other = other[k] + sum(b[1] for b in below)
        as_main = main[k] + sum(max(b[0], b[1] + apart) for b in below)
        as_both = both + sum(max(b) for b in below) if below or order[k].parent is None else -np.inf
        if order[k].parent is None:
            as_main = as_other = -np.inf
        best[k] = (as_main, as_other, as_both)
    texts, chosen = [], [2] * len(order)
    for k, block in enumerate(order):
        if block.parent is not None:
            up = chosen[index[id(block.parent)]]
            allowed = {0: (0, 1), 1: (1,), 2: (0, 1, 2)}[up]
            cost = apart if up == 0 else 0.0
            chosen[k] = max(allowed, key=lambda s: best[k][s] + cost * (s == 1))
        if chosen[k] == 0 and block.text and not block.hidden:
            texts.append(block.text)
    return texts


# --- training pages


@dataclass(frozen=True)
class ExtractSettings:
    sample_pages: int = 300  # the most pages that are learned from
    page_chars: int = 30_000  # longer pages are not learned from
    layouts: int = 3  # pages laid out anew from each
    seed: int = 3
    boost: BoostSettings = field(default_factory=lambda: BoostSettings(trees=60, depth=5, rate=0.25))


def _marked(order: list[Block]) -> np.ndarray | None:
    """Which blocks are main text, by the page's own marks; None if it has not one article or main element."""
    roots = [b for b in order if b.tag == "article"] or [b for b in order if b.tag == "main"]
    if len(roots) != 1:
        return None
    inside, out = {id(roots[0])}, np.zeros(len(order), bool)
    for k, block in enumerate(order):
        apart = block.tag in ("nav", "aside", "footer", "form", "header") or any(block.kinds[1:])
        if block.parent is not None and id(block.parent) in inside and not apart:
            inside.add(id(block))
        out[k] = id(block) in inside
    return out


def _texts_of(order: list[Block], mark: np.ndarray) -> tuple[list[str], list[str]]:
    good = [b.text for b, m in zip(order, mark, strict=True) if m and b.text]
    bad = [b.text for b, m in zip(order, mark, strict=True) if not m and b.text]
    return good, bad


_MARK = "data-main"


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def laid_out(good: list[str], bad: list[str], rand: random.Random) -> str:
    """A page of some other layout. Blocks of main text carry a mark that is taken off before they are described."""
    pick = rand.choice
    short = lambda: _escaped(" ".join(pick(bad or good).split()[: rand.randint(1, 12)]))
    long = lambda: _escaped(" ".join(pick(good).split()[: rand.randint(6, 60)]))
    links = lambda tag, n: "".join(f"<{tag}><a href='/x'>{short()}</a></{tag}>" for _ in range(n))
    name = lambda kind: pick(ATTRIBUTE_WORDS[kind])

    def shell(tag: str, kind: str, body: str) -> str:
        named = pick([f' class="{name(kind)}"', f' id="{name(kind)}"', f' class="{pick(["x", "block", "box"])}-{name(kind)} c{rand.randint(1, 9)}"'])
        return f"<{tag}{named}>{body}</{tag}>"

    def said(n: int) -> str:
        return "".join(f"<{pick(['p', 'p', 'div'])}>{long()}</p>" if rand.random() < 0.5 else f"<p>{long()}</p>" for _ in range(n))

    def menu():
        body = f"<ul>{links('li', rand.randint(2, 9))}</ul>"
        return pick([f"<nav>{body}</nav>", shell("div", "menu", body), shell("ul", "menu", links("li", 5)), shell("nav", "menu", body)])

    def top():
        body = f"<{pick(['h1', 'div', 'p'])}>{short()}</{pick(['h1', 'div', 'p'])}>" + pick(["", menu(), f"<p>{short()}</p>"])
        return pick([f"<header>{body}</header>", shell("div", "frame", body), shell("header", "frame", body)])

    def bottom():
        body = pick([f"&copy; 2020 {short()}", f"<p>{short()}</p>{links('span', 3)}", f"<p>{long()}</p>", menu() + f"<p>{short()}</p>"])
        return pick([f"<footer>{body}</footer>", shell("div", "frame", body), shell("footer", "frame", body)])

    def side():
        body = f"<h3>{short()}</h3>" + pick([f"<ul>{links('li', 4)}</ul>", f"<p>{long()}</p>", said(2)])
        return pick([f"<aside>{body}</aside>", shell("div", "side", body), shell("aside", "side", body)])

    def advert():
        return shell(pick(["div", "section", "p", "aside"]), "advert", pick([short(), long(), f"<p>{long()}</p>", f"<a href='/b'>{short()}</a>"]))

    def notice():
        return shell(pick(["div", "section", "p"]), "notice", pick([long(), f"<p>{long()}</p><button>OK</button>", f"<p>{short()}</p>"]))

    def form():
        body = f"<label>{short()}</label><input name='q'><button>{short()}</button>" + pick(["", f"<p>{short()}</p>"])
        return pick([f"<form action='/s'>{body}</form>", shell("div", "form", f"<form>{body}</form>"), shell("form", "form", body)])

    def comments():
        one = lambda: pick([f"<li><p>{long()}</p></li>", shell("div", "comment", f"<b>{short()}</b><p>{long()}</p>"), f"<p>{long()}</p>"])
        body = pick(["", f"<h{rand.randint(2, 4)}>{short()}</h3>"]) + "".join(one() for _ in range(rand.randint(1, 6)))
        return shell(pick(["div", "section", "ol", "ul", "aside"]), "comment", body)

    def shared():
        return shell(pick(["div", "ul", "p"]), "share", links(pick(["span", "li"]), rand.randint(1, 4)))

    def block(text: str) -> str:
        tag = pick(["p"] * 12 + ["h2", "h3", "blockquote", "li", "pre", "div"])
        body = pick([_escaped(text), f"<b>{_escaped(text)}", f"<em>{_escaped(text)}</em>"])
        if tag == "li":
            return f"<ul {_MARK}><li {_MARK}>{_escaped(text)}</li></ul>"
        return f"<{tag} {_MARK}>{body}" + ("" if tag == "p" and rand.random() < 0.3 else f"</{tag}>")

    body = [f"<h1 {_MARK}>{_escaped(good[0])}</h1>", *[block(t) for t in good[1:]]]
    for part in rand.sample([advert, notice, form, shared, comments, side, menu], rand.randint(0, 3)):
        body.insert(len(body) if part in (comments, shared, form) and rand.random() < 0.6 else rand.randint(1, len(body)), part())
    if rand.random() < 0.2:
        body = [f"<section {_MARK}>{''.join(body)}</section>"]
    tag = pick(["article", "article", "main", "div", "div", "div", "section"])
    named = f' class="{name("content")}"' if tag == "div" and rand.random() < 0.85 or rand.random() < 0.3 else ""
    main = f"<{tag}{named} {_MARK}>{''.join(body)}</{tag}>"
    outside = [part() for part in (menu, top, bottom, side, advert, notice, form, comments, shared) if rand.random() < 0.45]
    cut = rand.randint(0, len(outside))
    rand.shuffle(outside)
    page = "".join(outside[:cut]) + main + "".join(outside[cut:])
    for _ in range(rand.randint(0, 2)):
        page = f"<div class='{pick(['wrap', 'container', 'page', 'row', 'outer'])}'>{page}</div>"
    return f"<html><head><title>{short()}</title></head><body>{page}</body></html>"


class _MarkReader(_Reader):
    """Also remembers which blocks are marked."""

    def __init__(self):
        super().__init__()
        self.marked: set[int] = set()

    def handle_starttag(self, tag, attrs):
        was = self.block
        super().handle_starttag(tag, [a for a in attrs if a[0] != _MARK])
        if self.block is not was and self.block.tag == tag and any(a[0] == _MARK for a in attrs):
            self.marked.add(id(self.block))


def training_rows(pages: list[str], settings: ExtractSettings) -> tuple[np.ndarray, np.ndarray]:
    rand = random.Random(settings.seed)
    xs, ys = [], []
    for html in pages:
        order = listed(parse(html))
        mark = _marked(order)
        if mark is None or not any(b.text for b, m in zip(order, mark, strict=True) if m):
            continue
        xs.append(described(order)[1:])
        ys.append(mark[1:])
        good, bad = _texts_of(order, mark)
        good = [" ".join(t.split()[: rand.randint(1, 4)]) if rand.random() < 0.2 else t for t in good]
        for _ in range(settings.layouts):
            reader = _MarkReader()
            reader.feed(laid_out(good, bad, rand))
            reader.close()
            order_2 = listed(reader.root)
            inside = set(reader.marked)
            for block in order_2:  # text runs go with the block around them
                if block.tag == "#text" and block.parent is not None and id(block.parent) in inside:
                    inside.add(id(block))
            keep = [k for k, b in enumerate(order_2) if b.parent is not None and not (b.items and id(b) not in inside and any(id(c) in inside for c in _all(b)))]
            xs.append(described(order_2)[keep])
            ys.append(np.array([id(order_2[k]) in inside for k in keep]))
    if not xs:
        return np.zeros((0, 1)), np.zeros(0)
    return np.concatenate(xs), np.concatenate(ys).astype(float)


def _all(block: Block) -> Iterator[Block]:
    for below in block.items:
        yield below
        yield from _all(below)


def learn(pages: DataFrame, settings: ExtractSettings = ExtractSettings(), html: str = "html") -> Trees:
    """Trees from the ``sample_pages`` first different pages by the hash of their content, of those that are not too
    long. They are chosen by hash alone, so only the chosen ones leave their partitions. Where no page marks its article
    there is nothing to learn, and every block is as likely main text as not."""
    body = pages.select(pages[html].cast("string").alias("html")).where(F.col("html").isNotNull() & (F.length("html") <= settings.page_chars))
    body = body.withColumn("name", F.xxhash64("html"))
    chosen = body.select("name").distinct().orderBy("name").limit(settings.sample_pages)
    some = body.join(F.broadcast(chosen), "name", "left_semi").groupBy("name").agg(F.min("html").alias("html"))
    return fit(*training_rows([r.html for r in some.orderBy("name").collect()], settings), settings.boost)


def main_text(html: str, trees: Trees) -> str:
    order = listed(parse(html))
    if len(order) == 1:
        return ""
    return "\n".join(decoded(order, trees.probabilities(described(order))))


def extract(pages: DataFrame, trees: Trees, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``; ``text`` has one block per line.

    Null or empty html, and pages without main text, give the empty text. Rows that repeat an id, or have none, get a
    row each; equal pages give equal texts. Other columns do not matter; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):  # many pages at once on the way down the trees
                some = batch.slice(a, 64)
                orders = [listed(parse(h or "")) for h in some.column(2).to_pylist()]
                p = trees.probabilities(np.concatenate([described(o) for o in orders]))
                ends = np.cumsum([len(o) for o in orders])
                texts = ["\n".join(decoded(o, p[e - len(o) : e])) for o, e in zip(orders, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(pages[id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[html].cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
