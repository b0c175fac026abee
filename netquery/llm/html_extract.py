"""Main text of web pages by a recurrent block labeller in numpy.

A page becomes the sequence of its leaf blocks. Each block is a vector: hashed
tags and class words of all its open elements, hashed words of its text, and a few numbers
(length, links, place). A bidirectional LSTM reads the whole sequence in both
directions and labels every block with the page's context as article or not.
Article blocks are joined in page order.

The network is trained on the driver from at most `TRAIN_PAGES` pages of the table
(smallest hashed ids, html up to `TRAIN_CHARS` characters): the pages that mark an
article element themselves, and layouts drawn at random that set the pages' own
sentences into article and non-article places under many tag and class names, with
parts of the paths left out so that context counts. Every page's whole html is
read when it is labelled.

Defined results: null, empty and blank html, and pages without an article block,
give an empty text; unclosed and misnested tags are closed as browsers do for
paragraphs, list items and table cells; a script or style without end runs to the end
of the page, any other element whose content is hidden counts only if its end tag
follows; character references are decoded, white space in a block becomes one space,
blocks are joined by an empty line; without usable training pages the layouts
are set from a few fixed words; repeated rows are extracted alike; an empty table
gives no rows; other columns play no part."""

from __future__ import annotations

import functools
import html as entities
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import text_slices, word_hashes

TRAIN_PAGES, TRAIN_CHARS, LAYOUTS = 150, 30_000, 500
PATH, OWN, WORDS, NUMBERS = 128, 32, 32, 8
DIM = PATH + OWN + WORDS + NUMBERS
HIDDEN, EPOCHS, BATCH, RATE = 16, 6, 16, 8e-3

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>", re.S | re.I)
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())      # their content is no markup, and no text of the page
UNSEEN = frozenset("head template select button svg".split())                            # neither is the text of these
CONTROL = frozenset("div option legend hr".split())                                      # blocks that do not end an open button or select
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 "
                  "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html article section div main nav aside".split())
INNER = ("nav", "aside", "form", "footer")              # parts that are not text of the article around them


class Path(NamedTuple):
    """The open elements above a block, however many."""
    bits: int                    # bit k: a tag or name of an element has slot k
    own: str                     # tag and names of the innermost element
    marked: bool                 # an article element is open
    article: bool                # and no element of INNER


ROOT = Path(0, "", False, False)


class Elements:
    """Open elements with counts that change as one opens or closes, so a path costs the same at any depth."""

    def __init__(self):
        self.stack, self.names, self.open = [], [], Counter()
        self.slots, self.bits = [0] * PATH, 0

    def push(self, tag: str, name: str) -> None:
        self.stack.append(tag)
        self.names.append(name)
        self.open[tag] += 1
        for w in name.split(" "):
            k = _slot(w, PATH)
            self.slots[k] += 1
            self.bits |= 1 << k

    def pop(self) -> str:
        tag = self.stack.pop()
        self.open[tag] -= 1
        for w in self.names.pop().split(" "):
            k = _slot(w, PATH)
            self.slots[k] -= 1
            if not self.slots[k]:
                self.bits ^= 1 << k
        return tag

    def path(self) -> Path:
        marked = self.open["article"] > 0
        return Path(self.bits, self.names[-1], marked, marked and not any(self.open[t] for t in INNER)) if self.names else ROOT


@functools.lru_cache(maxsize=64)
def _end_tag(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I)


def blocks(page: str | None) -> list[tuple[str, Path, float]]:
    """(text, path, share of characters in links) of a page's leaf blocks in page order."""
    out, opened = [], Elements()
    stack = opened.stack
    parts, link, path, links = [], 0, ROOT, 0
    at, skip = 0, 0

    def flush():
        nonlocal link, path
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, path, min(1.0, link / max(1, len(text)))))
            parts.clear()
        link, path = 0, ROOT

    def take(piece):
        nonlocal link, path
        if not skip and piece:
            if path == ROOT and not piece.isspace():
                path = opened.path()
            parts.append(piece)
            if links:
                link += len(piece)

    def pop():
        nonlocal links, skip
        tag = opened.pop()
        links -= tag == "a"
        skip -= tag in UNSEEN

    page = page or ""
    last_end: dict[str, int] = {}

    def ends_later(tag):
        """Whether an end tag of this name stands anywhere behind."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in _end_tag(tag).finditer(page, at)), default=-1)
        return last_end[tag] >= at

    while m := TOKEN.search(page, at):
        take(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not (m[1] or m[4]):
            if ends_later(tag):
                at = _end_tag(tag).search(page, at).end()
            elif tag in ("script", "style"):                                    # code without an end runs to the end of the page
                at = len(page)
            continue
        if tag in BLOCK:
            flush()
        elif tag == "br":
            take(" ")
        if m[1] or m[4]:
            if opened.open[tag]:
                while stack[-1] != tag:
                    pop()
                pop()
            continue
        if tag in BLOCK and skip:                                               # an article's block does not stand in these
            while opened.open["svg"] and not opened.open["foreignobject"] or tag not in CONTROL and (opened.open["button"] or opened.open["select"]):
                pop()
        if tag in BLOCK:
            while stack and stack[-1] not in BLOCK or stack and stack[-1] == "p":      # a block ends a paragraph and what is open in it
                if stack[-1] != "p" and not opened.open["p"]:
                    break
                pop()
            if tag in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k] in CLOSES[tag]:
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k] in SCOPE:
                        break
        if tag == "body" and skip:
            while opened.open["head"]:
                pop()
        attrs = m[3] or m[6] or ""
        if tag in VOID or attrs.endswith("/") and tag not in BLOCK or tag in UNSEEN and tag != "head" and not ends_later(tag):
            continue
        words = [] if not attrs else re.findall(r"[a-z]+", " ".join(a or b or c for a, b, c in NAMES.findall(attrs)).lower())
        opened.push(tag, " ".join([tag, *words]))
        links += tag == "a"
        skip += tag in UNSEEN
    take(page[at:])
    flush()
    return out


@functools.lru_cache(maxsize=1 << 16)
def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


def path_vector(path: Path) -> np.ndarray:
    v = np.zeros(PATH + OWN, np.float32)
    v[:PATH] = np.unpackbits(np.frombuffer(path.bits.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little")
    if path.own:
        for w in path.own.split(" "):
            v[PATH + _slot("own " + w, OWN)] = 1
    return v


def vectors(page: list[tuple[str, Path, float]]) -> np.ndarray:
    """blocks x DIM."""
    n = len(page)
    x = np.zeros((n, DIM), np.float32)
    if not n:
        return x
    known: dict[Path, np.ndarray] = {}
    for i, (_, path, _) in enumerate(page):
        if path not in known:
            known[path] = path_vector(path)
        x[i, :PATH + OWN] = known[path]
    raw = [t.encode() for t, _, _ in page]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    h, _, first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), off, kind="alnum")
    count = np.diff(first)
    owner = np.repeat(np.arange(n), count)
    x[:, PATH + OWN:PATH + OWN + WORDS] = np.bincount(owner * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS) / np.maximum(count, 1)[:, None]
    length = np.array([len(t) for t, _, _ in page])
    place = np.arange(n) / max(1, n - 1)
    x[:, -NUMBERS:] = np.column_stack([np.log1p(count) / 5, np.log1p(length) / 7, [k for _, _, k in page], place, np.log1p(n) / 5 * np.ones(n),
                                       [t[-1] in ".!?" for t, _, _ in page], [t.count(",") / len(t) * 10 for t, _, _ in page], np.arange(n) == 0])
    return x


class Labeller:
    """Bidirectional LSTM over block vectors, one logit for each block."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        f = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"], self.p[f"h{d}"], self.p[f"b{d}"] = f(DIM, 4 * HIDDEN), f(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32)
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1
        self.p["out"], self.p["out_b"] = f(2 * HIDDEN, 1)[:, 0], np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States (pages x steps x HIDDEN) of one direction, and what its gradient needs."""
        pages, steps, _ = x.shape
        pre = x.reshape(-1, DIM) @ self.p["x" + d] + self.p["b" + d]
        pre = pre.reshape(pages, steps, -1)
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, saved = np.zeros((pages, steps, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ self.p["h" + d]
            s = 1 / (1 + np.exp(-z))
            i, f, o, g = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:3 * HIDDEN], np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t:t + 1]
            c2 = f * c + i * g
            k = np.tanh(c2)
            if keep:
                saved.append((t, h, c, i, f, o, g, k, m))
            c, h = m * c2 + (1 - m) * c, m * (o * k) + (1 - m) * h
            out[:, t] = h
        return out, saved

    def logits(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, sf = self._run(x, mask, "f", keep)
        b, sb = self._run(x, mask, "b", keep)
        s = np.concatenate([f, b], 2)
        return s @ self.p["out"] + self.p["out_b"], s, sf, sb

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        z, s, sf, sb = self.logits(x, mask, True)
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * mask / mask.sum()
        g = {"out": np.einsum("pt,pth->h", dz, s), "out_b": np.array([dz.sum()], np.float32)}
        ds = dz[:, :, None] * self.p["out"]
        for d, saved, part in (("f", sf, ds[:, :, :HIDDEN]), ("b", sb, ds[:, :, HIDDEN:])):
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            dpre = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
            dw = np.zeros_like(self.p["h" + d])
            for t, h, c, i, f, o, gg, k, m in reversed(saved):
                dh = dh + part[:, t]
                new = dh * m
                dc2 = dc * m + new * o * (1 - k * k)
                da = np.concatenate([dc2 * gg * i * (1 - i), dc2 * c * f * (1 - f), new * k * o * (1 - o), dc2 * i * (1 - gg * gg)], 1)
                dpre[:, t] = da
                dw += h.T @ da
                dh = dh * (1 - m) + da @ self.p["h" + d].T
                dc = dc * (1 - m) + dc2 * f
            g["h" + d] = dw
            g["x" + d] = x.reshape(-1, DIM).T @ dpre.reshape(-1, 4 * HIDDEN)
            g["b" + d] = dpre.sum((0, 1))
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 3) -> None:
        r = np.random.default_rng(seed)
        t = 0
        m, v = [{k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2)]
        for _ in range(EPOCHS):
            order = r.permutation(len(pages))
            for i in range(0, len(pages), BATCH):
                x, mask, y = _padded([pages[j] for j in order[i:i + BATCH]])
                g, t = self.gradients(x, mask, y), t + 1
                scale = min(1.0, 5 / (1e-9 + np.sqrt(sum(float((w * w).sum()) for w in g.values()))))
                for k in self.p:
                    w = g[k] * scale
                    m[k], v[k] = 0.9 * m[k] + 0.1 * w, 0.99 * v[k] + 0.01 * w * w
                    self.p[k] = (self.p[k] - RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-7)).astype(np.float32)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Article flags of every block of every page, in groups of pages of like length."""
        out: list = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            longest, end = len(pages[order[at]]), at + 1
            while end < len(order) and end - at < 128 and (end - at + 1) * len(pages[order[end]]) <= 16_384:
                longest, end = len(pages[order[end]]), end + 1
            some = order[at:end]
            x, mask = np.zeros((len(some), longest, DIM), np.float32), np.zeros((len(some), longest), np.float32)
            for k, i in enumerate(some):
                x[k, :len(pages[i])], mask[k, :len(pages[i])] = pages[i], 1
            z = self.logits(x, mask)[0]
            for k, i in enumerate(some):
                out[i] = z[k, :len(pages[i])] > 0
            at = end
        return out


def _padded(pages):
    steps = max(len(x) for x, _ in pages)
    x, mask, y = np.zeros((len(pages), steps, DIM), np.float32), np.zeros((len(pages), steps), np.float32), np.zeros((len(pages), steps), np.float32)
    for i, (a, b) in enumerate(pages):
        x[i, :len(a)], mask[i, :len(a)], y[i, :len(a)] = a, 1, b
    return x, mask, y


# Names that authors give to the parts of a page.
ARTICLE_PARTS = ["article", "main", "div class=content", "div class=post", "div class=entry content", "section class=story", "div id=article body", "div class=text", "td class=content", "div role=main", "div class=blog post"]
OTHER_PARTS = {
    "menu": ["nav", "ul class=menu", "div class=navbar", "div id=navigation", "div class=breadcrumb", "div class=toc"],
    "header": ["header", "div class=header", "div id=masthead", "div class=site title", "div class=topbar"],
    "notice": ["div class=cookie notice", "div class=banner", "div role=alert", "div class=consent", "div class=newsletter subscribe", "div class=popup modal", "div class=notice"],
    "advert": ["div class=ad", "div class=ads", "div class=advert", "aside class=sponsored", "div class=promo", "ins class=adsbygoogle", "div id=ad top"],
    "form": ["form", "form class=search", "div class=login form", "form class=contact", "fieldset"],
    "side": ["aside", "div class=sidebar", "div class=widget", "div class=related", "div class=share social", "div class=tags", "div class=recommended"],
    "comments": ["div class=comments", "section id=comments", "ol class=comment list", "div class=reply", "div class=disqus thread"],
    "footer": ["footer", "div class=footer", "div id=colophon", "div class=copyright", "div class=legal"],
}


def _path(elements: list[str]) -> Path:
    opened = Elements()
    for e in elements:
        opened.push(e.split(" ")[0], e)
    return opened.path()


def _layout(r: np.random.Generator, sentences: list[str]) -> list[tuple[str, Path, float, int]]:
    """Blocks (text, path, link share, article) of one random page."""
    def say(least, most):
        return " ".join(sentences[j] for j in r.integers(0, len(sentences), int(r.integers(least, most + 1))))

    def words(n):
        return " ".join(say(1, 1).split()[:n]) or "page"
    element = lambda e: e.replace(" class=", " ").replace(" id=", " ").replace(" role=", " ")
    pick = lambda xs: element(xs[int(r.integers(len(xs)))])
    root = ["html", "body"] + ([pick(["div class=page", "div id=wrapper", "div class=container", "div"])] if r.random() < 0.4 else [])
    out = []

    def part(kind):
        e = pick(OTHER_PARTS[kind])
        if r.random() < 0.15:
            e = e.split(" ")[0]                         # the name is missing: context has to tell
        base = root + [e]
        if kind in ("menu", "footer", "side") and r.random() < 0.7:
            for _ in range(int(r.integers(2, 9))):
                w = words(int(r.integers(1, 4)))
                out.append((w, [*base, "ul", "li", "a"] if r.random() < 0.8 else [*base, "a"], 1.0, 0))
        elif kind == "comments":
            for _ in range(int(r.integers(1, 6))):
                out.append((words(2), [*base, pick(["div class=comment", "li", "div"]), pick(["b", "span class=author", "p"])], 0.0, 0))
                out.append((say(1, 3), [*base, pick(["div class=comment", "li", "div"]), "p"], 0.0, 0))
        elif kind == "form":
            for _ in range(int(r.integers(1, 4))):
                out.append((words(int(r.integers(1, 5))), [*base, pick(["label", "p", "div", "legend"])], 0.0, 0))
        else:
            for _ in range(int(r.integers(1, 3))):
                out.append((say(1, 2) if r.random() < 0.7 else words(5), base + ([pick(["p", "div", "span", "h2"])] if r.random() < 0.5 else []), float(r.random() < 0.2), 0))

    for kind in ("header", "menu", "notice", "advert", "form", "side"):
        if r.random() < 0.55:
            part(kind)
    a = pick(ARTICLE_PARTS)
    base = root + ([pick(["main", "div id=main", "div class=row"])] if r.random() < 0.3 else []) + [a if r.random() > 0.1 else a.split(" ")[0]]
    if r.random() < 0.85:
        out.append((say(1, 1), [*base, pick(["h1", "h1", "h2", "h1 title"])], 0.0, 1))
    for i in range(int(r.integers(1, 22))):
        kind = r.random()
        text = say(1, 5) if kind < 0.8 else words(int(r.integers(1, 7)))
        out.append((text, base + [pick(["p", "p", "p", "p", "p", "h2", "h3", "li", "blockquote", "div", "pre", "td", "figcaption"])] + (["b"] if kind > 0.93 else []), float(kind < 0.05) * 0.3, 1))
        if r.random() < 0.03:
            inner = pick(OTHER_PARTS["advert"] + OTHER_PARTS["side"])
            out.append((say(1, 1), [*base, inner, "p"], float(r.random() < 0.3), 0))
    for kind in ("side", "advert", "comments", "form", "notice", "footer"):
        if r.random() < 0.55:
            part(kind)
    return [(t, _path(p), k, y) for t, p, k, y in out]


def train(pages: list[str], seed: int = 1) -> Labeller:
    r = np.random.default_rng(seed)
    parsed = [blocks(p) for p in pages]
    sentences = [s for p in parsed for t, _, _ in p for s in re.split(r"(?<=[.!?])\s+", t) if s][:20_000]
    sentences = sentences or ["Some words stand here.", "More of them follow, with a comma.", "Home", "About us"]
    data = []
    for p in parsed:
        if any(path.marked for _, path, _ in p):
            data.append((vectors(p), np.array([path.article for _, path, _ in p], np.float32)))
    for _ in range(LAYOUTS):
        p = _layout(r, sentences)
        x = vectors([(t, path, k) for t, path, k, _ in p])
        if r.random() < 0.2:
            x[:, :PATH] *= r.random(PATH) > 0.3
        data.append((x, np.array([y for *_, y in p], np.float32)))
    net = Labeller()
    net.fit(data)
    return net


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", labeller: Labeller | None = None) -> DataFrame:
    """page_id, url, text of every row."""
    spark = pages.sparkSession
    pages = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    if labeller is None:
        fit = pages.where((F.length("html") > 0) & (F.length("html") <= TRAIN_CHARS))
        ids = fit.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES)       # ids alone reach the driver first
        some = fit.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).orderBy(F.xxhash64("page_id"), "page_id")
        labeller = train([r.html for r in some.collect()])                     # at most TRAIN_PAGES pages
    net = spark.sparkContext.broadcast(labeller)
    schema = pa.schema([("page_id", to_arrow_type(pages.schema["page_id"].dataType)), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        for b in text_slices(batches, "html", 4 << 20):
            parsed = [blocks(p) for p in b.column(2).to_pylist()]
            flags = net.value.label([vectors(p) for p in parsed])
            text = ["\n\n".join(t for (t, _, _), f in zip(p, y, strict=True) if f) for p, y in zip(parsed, flags, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.string()), pa.array(text, pa.string())], schema=schema)
    return pages.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string")


def op2_html_extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
