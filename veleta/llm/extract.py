"""HTML extraction with a recurrent block labeller.

A page is a sequence of leaf blocks.  A block's vector joins the mean of its tag-path vectors, the mean of
its hashed-word vectors and a few measures; a bidirectional LSTM in numpy reads the sequence both ways,
so every block is classified with the whole page as context.  Tag-path, word and network weights are
trained together on a bounded sample of the pages.

Training pages need labels that no table has.  They come from the sample's own markup: text that its
authors put into ``article`` or ``main`` is content and text in navigation, footers and the like is not.  Half of the
training pages are the sample itself, half rearrange its texts in other containers (menus, side bars,
notices, forms, comments under other names), so the network learns names and context rather than one site.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import arrow_map
from veleta.llm.htmlblocks import Block, blocks

PATHS, WORDS, PATH_DIM, WORD_DIM, DENSE, HIDDEN = 2048, 2048, 12, 6, 7, 16

# Names that authors give to parts of a page that are not the article (fixed values for labels).
BOILER_TAGS = frozenset("nav footer aside form header menu dialog".split())
BOILER_NAMES = frozenset("ad ads advert advertisement banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs "
                         "footer header masthead sidebar aside widget related comment comments reply replies disqus respond cookie "
                         "consent gdpr notice alert popup modal newsletter subscribe signup login share social toolbar pagination".split())
CONTENT_NAMES = frozenset("article main content post entry story body text".split())


def known_label(block: Block) -> int | None:
    """1 or 0 where the markup itself says what a block is, else None."""
    content = None
    for token in block.path:
        if token in BOILER_TAGS or token[1:] in BOILER_NAMES and token[0] == ".":
            return 0
        if token in ("article", "main"):
            content = 1
    return content


# -- vectors ---------------------------------------------------------------------------------------

def _slot(token: str, size: int) -> int:
    return xxhash.xxh3_64_intdigest(token) % size


@lru_cache(maxsize=1 << 14)
def _tokens(path: tuple[str, ...], tag: str) -> list[int]:
    return [_slot(t, PATHS) for t in [*dict.fromkeys(path), "^" + tag]]


def _measures(b: Block, k: int, n: int) -> list[float]:
    size = len(b.text)
    marks = sum(b.text.count(c) for c in ".,;:!?")
    return [1.0, min(3.0, np.log1p(size) / 3), min(2.0, np.log1p(b.words) / 3), b.linked,
            min(1.0, marks / max(1, b.words)), k / max(1, n - 1), float(b.text[-1:] in ".!?")]


@dataclass
class Batch:
    """Pages of similar length, one column each; tokens are listed with the cell they belong to."""

    shape: tuple[int, int]
    path: np.ndarray
    path_cell: np.ndarray
    word: np.ndarray
    word_cell: np.ndarray
    dense: np.ndarray
    mask: np.ndarray


def batch(pages: list[list[Block]]) -> Batch:
    steps, width = max(map(len, pages)), len(pages)
    path, path_cell, words, word_n, word_at, dense = [], [], [], [], [], np.zeros((steps, width, DENSE))
    mask = np.zeros((steps, width, 1))
    for j, page in enumerate(pages):
        for i, b in enumerate(page):
            cell = i * width + j
            t = _tokens(b.path, b.tag)
            path += t
            path_cell += [cell] * len(t)
            own = b.text.lower().split()
            words += own
            word_n.append(len(own))
            word_at.append(cell)
            dense[i, j] = _measures(b, i, len(page))
            mask[i, j] = 1
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return Batch((steps, width), np.array(path, int), np.array(path_cell, int),
                 (hashed % np.uint64(WORDS)).astype(int), np.repeat(word_at, word_n).astype(int), dense, mask)


# -- network ---------------------------------------------------------------------------------------

def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Labeller:
    """Bidirectional LSTM over block vectors with a logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        size = PATH_DIM + WORD_DIM + DENSE
        self.p = {"path": r.normal(0, 0.3, (PATHS, PATH_DIM)), "word": r.normal(0, 0.1, (WORDS, WORD_DIM)),
                  "out": r.normal(0, 0.3, 2 * HIDDEN + size), "bias": np.zeros(1)}
        for way in "fb":
            self.p["x" + way] = r.normal(0, 0.3, (size, 4 * HIDDEN))
            self.p["h" + way] = r.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
            self.p["c" + way] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]

    @staticmethod
    def _mean(table: np.ndarray, index: np.ndarray, cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        count = np.maximum(1, np.bincount(cell, minlength=cells))
        out = np.stack([np.bincount(cell, table[index, d], minlength=cells) for d in range(table.shape[1])], 1)
        return out / count[:, None], count

    def inputs(self, b: Batch):
        cells = b.shape[0] * b.shape[1]
        path, np_ = self._mean(self.p["path"], b.path, b.path_cell, cells)
        word, nw = self._mean(self.p["word"], b.word, b.word_cell, cells)
        x = np.concatenate([path.reshape(*b.shape, -1), word.reshape(*b.shape, -1), b.dense], 2)
        return x, np_, nw

    def _run(self, x, mask, way, keep):
        steps, width, _ = x.shape
        wx = x @ self.p["x" + way] + self.p["c" + way]
        h, c = np.zeros((width, HIDDEN)), np.zeros((width, HIDDEN))
        hs, trace = np.zeros((steps, width, HIDDEN)), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = wx[t] + h @ self.p["h" + way]
            g = _sigmoid(z[:, :3 * HIDDEN])
            i, f, o, u = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
            c_new = f * c + i * u
            th = np.tanh(c_new)
            m = mask[t]
            if keep:
                trace.append((t, h, c, i, f, o, u, th))
            h = m * (o * th) + (1 - m) * h
            c = m * c_new + (1 - m) * c
            hs[t] = h
        return hs, trace

    def probabilities(self, b: Batch, x=None, keep=False):
        x = self.inputs(b)[0] if x is None else x
        hf, tf = self._run(x, b.mask, "f", keep)
        hb, tb = self._run(x, b.mask, "b", keep)
        every = np.concatenate([hf, hb, x], 2)
        p = _sigmoid(every @ self.p["out"] + self.p["bias"])
        return (p, every, tf, tb) if keep else p

    def gradients(self, b: Batch, y: np.ndarray, weight: np.ndarray):
        x, n_path, n_word = self.inputs(b)
        p, every, tf, tb = self.probabilities(b, x, True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        ds = (p - y) * weight / max(1.0, weight.sum())
        g["out"] = np.einsum("tb,tbd->d", ds, every)
        g["bias"] = np.array([ds.sum()])
        de = ds[:, :, None] * self.p["out"]
        dx = de[:, :, 2 * HIDDEN:].copy()
        for way, trace, dh_out in (("f", tf, de[:, :, :HIDDEN]), ("b", tb, de[:, :, HIDDEN:2 * HIDDEN])):
            dh, dc = np.zeros_like(dh_out[0]), np.zeros_like(dh_out[0])
            for t, h, c, i, f, o, u, th in reversed(trace):
                m = b.mask[t]
                dh = dh + dh_out[t]
                dc_new = m * (dc + dh * o * (1 - th * th))
                dz = np.concatenate([dc_new * u * i * (1 - i), dc_new * c * f * (1 - f),
                                     m * dh * th * o * (1 - o), dc_new * i * (1 - u * u)], 1)
                g["h" + way] += h.T @ dz
                g["x" + way] += x[t].T @ dz
                g["c" + way] += dz.sum(0)
                dx[t] += dz @ self.p["x" + way].T
                dh = dz @ self.p["h" + way].T + (1 - m) * dh
                dc = dc_new * f + (1 - m) * dc
        flat = dx.reshape(-1, dx.shape[2])
        for name, index, cell, count, a, z in (("path", b.path, b.path_cell, n_path, 0, PATH_DIM),
                                               ("word", b.word, b.word_cell, n_word, PATH_DIM, PATH_DIM + WORD_DIM)):
            part = flat[:, a:z] / count[:, None]
            for d in range(z - a):
                g[name][:, d] = np.bincount(index, part[cell, d], minlength=len(g[name]))
        eps = 1e-9
        loss = -(weight * (y * np.log(p + eps) + (1 - y) * np.log(1 - p + eps))).sum() / max(1.0, weight.sum())
        return g, loss

    def fit(self, pages: list[list[Block]], labels: list[list[int | None]], epochs: int = 12, size: int = 16,
            rate: float = 0.01, seed: int = 7) -> "Labeller":
        """Adam over batches of pages of similar length; blocks without label are context only."""
        order = sorted(range(len(pages)), key=lambda k: len(pages[k]))
        groups = [order[k:k + size] for k in range(0, len(order), size)]
        ready = []
        for group in groups:
            b = batch([pages[k] for k in group])
            y, w = np.zeros(b.shape), np.zeros(b.shape)
            for j, k in enumerate(group):
                for i, label in enumerate(labels[k]):
                    if label is not None:
                        y[i, j], w[i, j] = label, 1
            ready.append((b, y, w))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        r, step = random.Random(seed), 0
        for epoch in range(epochs):
            pace = rate * (1 - epoch / epochs)
            r.shuffle(ready)
            for b, y, w in ready:
                g, _ = self.gradients(b, y, w)
                step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def label(self, pages: list[list[Block]], cells: int = 1 << 14) -> list[np.ndarray]:
        """Whether each block is content, page by page; pages are batched by length."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        while order:
            width = max(1, min(len(order), cells // len(pages[order[-1]])))
            group, order = order[-width:], order[:-width]
            p = self.probabilities(batch([pages[k] for k in group]))
            for j, k in enumerate(group):
                out[k] = p[:len(pages[k]), j] >= 0.5
        return out


# -- training pages --------------------------------------------------------------------------------

_MENU = ("Home", "About", "Contact", "News", "Archive", "Search", "Log in", "Next page", "Topics", "Imprint", "Privacy")
_SIDE = ("Related articles", "Most read", "Popular posts", "Follow us", "Tags", "Recent comments", "You may also like")
_NOTE = ("We use cookies to improve this site. Accept all cookies?", "Sign up for our newsletter today.",
         "This page has moved. Please update your bookmarks.", "Share this on social media", "Subscribe now for full access.")
_FORM = ("Your name", "Your e-mail", "Message", "Send", "Leave a reply", "Password", "Search this site")
_FOOT = ("All rights reserved.", "Terms of use", "Privacy policy", "Contact us", "Powered by a site builder")


def _wrapped(r: random.Random, kind: str, inner: str) -> str:
    choices = {
        "content": ("article", "main", 'div class="content"', 'div id="main"', 'div class="post-content"', 'section class="article-body"',
                    'div class="entry"', 'div role="main"', 'div class="story"', "div", "section", 'div class="text"', 'div class="col"',
                    'div class="post"', 'div class="middle"', "td"),
        "menu": ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="navbar"', 'div class="breadcrumbs"', "div", 'div class="top"', 'div class="left"'),
        "head": ("header", 'div class="header"', 'div id="masthead"', 'div class="site-header"', 'div class="top"'),
        "side": ("aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', "div", 'div class="right"'),
        "note": ('div class="notice"', 'div class="cookie-banner"', 'div id="alert"', 'div class="newsletter"', 'div class="popup"',
                 'div role="alert"', 'div class="share"', 'div class="promo"'),
        "ad": ('div class="ad"', 'div class="advert"', 'aside class="ads"', 'div id="sponsored"', 'section class="advertisement"'),
        "form": ("form", 'form class="login"', 'div class="signup"', 'form id="search"'),
        "comments": ('div id="comments"', 'section class="comments"', 'div class="comment-list"', 'ol class="replies"',
                     'div class="disqus"', 'section id="respond"', 'div class="discussion"', 'div class="responses"', 'ul class="commentlist"'),
        "foot": ("footer", 'div class="footer"', 'div id="footer"', 'div class="site-footer"', 'div class="bottom"', "div"),
        "shell": ('div class="site"', 'div id="page"', 'div class="wrap"', "table", "main"),
    }[kind]
    start = r.choice(choices)
    return f"<{start}>{inner}</{start.split()[0]}>"


def _links(r: random.Random, words: tuple[str, ...], n: int) -> str:
    return "<ul>" + "".join(f'<li><a href="/{i}">{r.choice(words)}</a></li>' for i in range(n)) + "</ul>"


def rearranged(r: random.Random, texts: list[str], loose: list[str]) -> tuple[list[Block], list[int]]:
    """A page made of ``texts`` as its article and of ``loose`` texts elsewhere, with its labels."""
    mark = ""   # tells the article's blocks apart and is taken out again
    paragraph = lambda t: f"<p>{mark}{t}</p>"
    # An article may hold very short blocks and what elsewhere is boilerplate.
    texts = [r.choice(_NOTE + _FOOT + _MENU + _SIDE) if (u := r.random()) < 0.08 else " ".join(t.split()[:r.randint(1, 4)])
             if u < 0.25 else t for t in texts]
    head = texts[0][:60] if r.random() < 0.6 else " ".join(texts[0].split()[:r.randint(1, 3)])
    body = [f"<h1>{mark}{head}</h1>"] if r.random() < 0.7 else []
    for k, t in enumerate(texts):
        kind = r.random()
        body.append(paragraph(t) if kind < 0.75 else f"<div>{mark}{t}</div>" if kind < 0.8 else f"<blockquote>{paragraph(t)}</blockquote>"
                    if kind < 0.85 else f"<ul><li>{mark}{t}</li></ul>" if kind < 0.92 else f"<h2>{mark}{t[:50]}</h2>" + paragraph(t))
        if r.random() < 0.06:   # a table or a list of short facts
            facts = [" ".join(t.split()[i:i + r.randint(1, 3)]) for i in range(0, 6, 2)]
            rows = "".join(f"<tr><td>{mark}{f}</td><td>{mark}{r.randint(1, 99)} {r.choice(('km', 'kg', 'years', 'EUR'))}</td></tr>" for f in facts if f)
            body.append(f"<table>{rows}</table>" if r.random() < 0.6 else "<ul>" + "".join(f"<li>{mark}{f}</li>" for f in facts if f) + "</ul>")
        if r.random() < 0.18:
            aside = f"<p>{r.choice(loose)[:120]}</p>" if r.random() < 0.6 else r.choice(_SIDE + tuple(t[:r.choice((8, 30))] for t in loose[:4]))
            body.append(_wrapped(r, r.choice(("ad", "note", "side", "side")), aside))
    talk = lambda: "<h3>Comments</h3>" * (r.random() < 0.5) + "".join(
        f'<div class="{r.choice(("comment", "reply", "item", "user-comment"))}"><p>{r.choice(loose)[:r.choice((20, 60, 400))]}</p></div>'
        if r.random() < 0.6 else f"<p>{r.choice(loose)[:r.choice((20, 60, 400))]}</p>" for _ in range(r.randint(1, 5)))
    nested = r.random() < 0.45
    if nested:                  # readers' comments inside the article's own element
        body.append(_wrapped(r, "comments", talk()))
    words = tuple(_MENU) + tuple(w for t in loose[:3] for w in t.split()[:6])
    parts = []
    maybe = lambda p, kind, inner: parts.append(_wrapped(r, kind, inner)) if r.random() < p else None
    maybe(0.3, "note", f"<p>{r.choice(_NOTE)}</p>")
    maybe(0.5, "head", f"<h1>{r.choice(words)}</h1><p>{r.choice(loose)[:60]}</p>")
    maybe(0.8, "menu", _links(r, words, r.randint(3, 9)))
    maybe(0.4, "ad", f"<p>{r.choice(loose)[:150]}</p>")
    side = lambda: f"<h3>{r.choice(_SIDE)}</h3>" + (_links(r, words, r.randint(2, 7)) if r.random() < 0.6 else f"<p>{r.choice(loose)[:200]}</p>")
    maybe(0.3, "side", side())
    parts.append(_wrapped(r, "content", "".join(body)))
    maybe(0.4, "ad", f"<p>{r.choice(loose)[:150]}</p>")
    maybe(0.4, "form", "".join(f"<p>{r.choice(_FORM)}</p>" for _ in range(r.randint(1, 4))))
    if not nested and r.random() < 0.5:
        parts.append(_wrapped(r, "comments", talk()))
    maybe(0.4, "side", side())
    maybe(0.8, "foot", f"<p>{r.choice(_FOOT)}</p><p>{r.choice(("&copy;", "Copyright 2020"))} {r.choice(loose)[:40]}</p>")
    inner = "".join(parts)
    if r.random() < 0.25:
        inner = _wrapped(r, "shell", inner)
    page = blocks("<html><body>" + inner + "</body></html>")
    labels = [int(mark in b.text) for b in page]
    for b in page:
        b.text = b.text.replace(mark, "")
    return page, labels


def training_pages(sample: list[str], seed: int = 7) -> tuple[list[list[Block]], list[list[int | None]]]:
    """The sample's pages as their markup labels them, twice, and as many rearranged ones."""
    r = random.Random(seed)
    pages = [p for p in map(blocks, sample) if p]
    labels: list[list[int | None]] = [[known_label(b) for b in p] for p in pages]
    articles = [[b.text.replace("<", " ").replace("&", " ") for b, y in zip(p, ys) if y == 1] for p, ys in zip(pages, labels)]
    articles = [a for a in articles if a] or [["A short text about nothing.", "It goes on, and then it ends."]]
    made = []
    for _ in range(3 * max(120, len(pages))):
        own, others = r.choice(articles), [t for _ in range(3) for t in r.choice(articles)]
        at = r.randrange(len(own))
        made.append(rearranged(r, own[at:at + r.randint(1, 14)], others))
    # The sample once more with texts of other lengths: what a block is does not hang on its length.
    cut = []
    for page in pages:
        again = []
        for b in page:
            words = b.text.split()
            text = " ".join(words[:r.randint(1, 4)]) if r.random() < 0.4 else b.text
            again.append(replace(b, text=text, words=text.count(" ") + 1))
        cut.append(again)
    return pages + cut + [p for p, _ in made], labels + labels + [list(y) for _, y in made]


def fit(pages: DataFrame, sample: int = 200, longest: int = 1 << 16, html_col: str = "html") -> Labeller:
    """A labeller trained on at most ``sample`` pages of at most ``longest`` characters, those of smallest
    hashed text, equal pages counted once; it bounds what is collected.  An empty table gives one trained on made-up pages."""
    rows = pages.select(F.col(f"`{html_col}`").alias("html")).filter(F.col("html").isNotNull() & (F.length("html") <= longest))
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 32))
    share = min(1.0, 4 * sample / max(1, rows.select(F.xxhash64("html")).distinct().count()))
    few = rows.filter(place < F.lit(share * (1 << 32))).distinct().orderBy(place, "html").limit(sample)
    found = training_pages([x[0] for x in few.collect()])
    return Labeller().fit(*found)


def extract(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Per page: id, url, text (the content blocks, white space inside a block as one blank, joined by
    one blank), n_chars and n_blocks (blocks of the page).

    Row by row over whole pages.  Null, empty and textless pages give an empty text; broken markup is read
    as far as it goes; repeated rows are extracted once each; an empty table gives an empty one;
    other columns are ignored.
    """
    held = pages.sparkSession.sparkContext.broadcast(labeller)   # weights of fixed size
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            parsed = [blocks(x) for x in b.column("html").to_pylist()]
            texts = [" ".join(block.text for block, good in zip(page, keep) if good)
                     for page, keep in zip(parsed, held.value.label(parsed))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in parsed], pa.int64())],
                ["id", "url", "text", "n_chars", "n_blocks"])

    return arrow_map(rows, run, f"id {kind}, url string, text string, n_chars long, n_blocks long").withColumnRenamed(
        "id", id_col)
