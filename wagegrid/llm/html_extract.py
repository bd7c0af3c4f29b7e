"""Main text of pages by a recurrent labeller of blocks.

A page is a sequence of leaf blocks.  A block is read as a vector: hashed words of its tag
path (tags, classes, ids, roles), hashed words of its text, a few figures.  A bidirectional
LSTM in numpy runs over the whole sequence, so every block is judged with all others
in view.  Blocks it takes for main text are joined by blanks in page order.

Training needs no labels at hand.  In a bounded sample of pages, what stands in an
``article`` or ``main`` element, and in no menu, header, footer, sidebar, form or advert inside it,
is main text.  The texts of these blocks are also set into made-up pages with other tags,
class names and orders, so that the labeller does not hang on one layout.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagegrid.llm.common import map_batches, slices
from wagegrid.llm.markup_blocks import Block, read_blocks

#: Pages the labeller is trained on, about (drawn by a hash of page_id), and made-up pages for each.
SAMPLE = 250
MADE = 3
EPOCHS = 14
HIDDEN = 24
_PATHS, _WORDS, _FIGURES, _INPUT = 512, 256, 8, 24
_BLOCKS = 20_000  # worked on at a time
_TRAIN_BLOCKS = 48 * 120  # in a training step, the blanks behind shorter pages counted

_MAIN = {"article", "main"}
_OTHER = {"nav", "header", "footer", "aside", "form"}

#: Words of class names for each part of a made-up page.
ROLES = {
    "main": "article content main post entry story body text page prose reading detail single copy",
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs links submenu dropdown",
    "header": "header masthead top branding logo site head hero title bar",
    "footer": "footer foot bottom copyright legal site info colophon imprint",
    "sidebar": "sidebar side aside widget related recommended rail secondary more trending popular tags archive recent teaser",
    "notice": "cookie consent notice gdpr alert popup modal newsletter subscribe paywall disclaimer warning message overlay banner privacy",
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted banner adsense dfp commercial",
    "form": "form search login signup contact survey poll feedback register",
    "comments": "comments comment replies reply discussion respond disqus reader thread responses",
    "share": "share social follow buttons toolbar meta author byline pagination",
}
_TAGS = {
    "main": ("article", "main", "div", "section"), "menu": ("nav", "ul", "div"), "header": ("header", "div"),
    "footer": ("footer", "div"), "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "p", "aside"),
    "advert": ("div", "aside", "section"), "form": ("form", "div"), "comments": ("section", "div", "ol", "ul"),
    "share": ("div", "ul"),
}


def page_label(block: Block) -> int:
    """1 for a block of main text, by its mark or by the elements that hold it."""
    if block.mark is not None:
        return block.mark
    names = [w for w in block.path if not w.startswith(".")]
    inside = max((i for i, n in enumerate(names) if n in _MAIN), default=-1)
    if inside < 0 or any(n in _OTHER for n in names[inside + 1 :]):
        return 0
    after = block.path[max(i for i, w in enumerate(block.path) if w in _MAIN) + 1 :]
    apart = {f".{w}" for role in ("advert", "comments", "sidebar", "menu") for w in ROLES[role].split()}
    return int(not any(w in apart for w in after))


def made_up_page(content: list[str], other: list[str], draw: random.Random) -> str:
    """A page that sets ``content`` into a random layout, with ``other`` texts around it."""

    def attributes(role: str) -> str:
        names = draw.sample(ROLES[role].split(), draw.choice((1, 1, 2)))
        name = draw.choice("-_ ").join(names) + draw.choice(("", "", "-wrap", "-box", "1"))
        return f' {draw.choice(("class", "class", "id"))}="{name}"'

    def wrapped(role: str, inner: str, mark: int) -> str:
        tag = draw.choice(_TAGS[role])
        plain = tag in ("nav", "header", "footer", "aside", "article", "main") and draw.random() < 0.5
        return f'<{tag}{"" if plain else attributes(role)} data-y="{mark}">{inner}</{tag}>'

    def some(most: int) -> list[str]:
        return [escape(draw.choice(other or ["more"])) for _ in range(draw.randint(1, most))]

    def links(n: int) -> str:
        items = [f'<a href="/{i}">{escape(" ".join(draw.choice(other or ["more"]).split()[:3]))}</a>' for i in range(n)]
        tag = draw.choice(("li", "span", "div"))
        listed = "".join(f"<{tag}>{i}</{tag}>" for i in items)
        return f"<ul>{listed}</ul>" if tag == "li" else listed

    def paragraphs(texts: list[str]) -> str:
        tag = draw.choice(("p", "p", "div"))
        return "".join(f"<{tag}>{t}</{tag}>" for t in texts)

    def part(role: str) -> str:
        if role in ("menu", "share") or role == "sidebar" and draw.random() < 0.5:
            inner = links(draw.randint(2, 8))
        elif role == "footer":
            inner = draw.choice(("&copy; ", "")) + some(1)[0] + draw.choice(("", links(3)))
        elif role == "form":
            inner = f'<label>{some(1)[0]}</label><input name="q"><button>{some(1)[0]}</button>'
        else:
            inner = draw.choice((paragraphs(some(4)), some(1)[0]))
            if role in ("sidebar", "comments") and draw.random() < 0.6:
                inner = f"<h3>{some(1)[0]}</h3>{inner}"
        return wrapped(role, inner, 0)

    body = []
    for i, text in enumerate(content):
        tag = draw.choice(("h1", "h1", "h2")) if i == 0 else draw.choice(("p",) * 9 + ("div", "h2", "li", "blockquote"))
        body.append(f"<{tag}>{escape(text)}</{tag}>")
        if draw.random() < 0.08:
            body.append(part(draw.choice(("advert", "share", "sidebar", "notice", "form"))))
    main = wrapped("main", "".join(body), 1)
    if draw.random() < 0.4:
        main = f"<{draw.choice(('div', 'main', 'section'))}{attributes('main')}>{main}</div>"
    before = [part(r) for r in ("notice", "header", "menu", "advert", "form", "sidebar") if draw.random() < 0.45]
    after = [part(r) for r in ("share", "comments", "sidebar", "advert", "notice", "form", "footer") if draw.random() < 0.45]
    draw.shuffle(before)
    return "<html><body>" + "".join([*before, main, *after]) + "</body></html>"


_hashed: dict[str, int] = {}


def _bucket(word: str, n: int) -> int:
    found = _hashed.get(word)
    if found is None:
        if len(_hashed) > 100_000:
            _hashed.clear()
        found = _hashed[word] = zlib.crc32(word.encode())
    return found % n


_ASIDE = re.compile(r"[©|»«→]")


def page_features(blocks: list[Block]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Buckets of path words, buckets of text words, and figures of every block."""
    paths, texts, figures = [], [], np.zeros((len(blocks), _FIGURES))
    cache: dict[tuple[str, ...], list[int]] = {}
    for i, block in enumerate(blocks):
        found = cache.get(block.path)
        if found is None:
            own = block.path
            found = cache[block.path] = [
                *(_bucket(w, _PATHS // 2) for w in own),
                *(_PATHS // 2 + _bucket(w, _PATHS // 2) for w in own[-4:]),
            ]
        paths.append(found)
        words = block.text.split()
        texts.append([_bucket(w, _WORDS) for w in block.text.lower().split()])
        last = block.text[-1]
        figures[i] = (
            np.log1p(len(words)) / 5, len(words) < 5, block.linked, last in ".!?…", bool(_ASIDE.search(block.text)),
            i / max(len(blocks) - 1, 1), len(block.path) / 20, 1.0,
        )
    return paths, texts, figures


@dataclass
class Batch:
    """Pages side by side: arrays of (step, page, ...); absent steps have mask 0."""

    path_at: np.ndarray
    paths: np.ndarray
    word_at: np.ndarray
    words: np.ndarray
    shares: np.ndarray
    figures: np.ndarray
    mask: np.ndarray
    steps: int
    pages: int


def batch_of(pages: list[list[Block]]) -> Batch:
    steps, n = max(len(p) for p in pages), len(pages)
    path_at, paths, word_at, words, shares = [], [], [], [], []
    figures, mask = np.zeros((steps * n, _FIGURES)), np.zeros((steps, n))
    for j, blocks in enumerate(pages):
        own_paths, own_words, own_figures = page_features(blocks)
        at = np.arange(len(blocks)) * n + j
        figures[at] = own_figures
        mask[: len(blocks), j] = 1
        for row, p, w in zip(at.tolist(), own_paths, own_words, strict=True):
            path_at += [row] * len(p)
            paths += p
            word_at += [row] * len(w)
            words += w
            shares += [1 / len(w)] * len(w)
    return Batch(
        np.array(path_at, np.int64), np.array(paths, np.int64), np.array(word_at, np.int64),
        np.array(words, np.int64), np.array(shares), figures, mask, steps, n,
    )


def _sums(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by ``at`` (equal values are neighbours)."""
    out = np.zeros((n, rows.shape[1]))
    if len(at):
        begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out[at[begin]] = np.add.reduceat(rows, begin, axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Labeller:
    """Embedding sums, one LSTM in each direction, one logistic output per block."""

    def __init__(self, seed: int = 5):
        draw = np.random.default_rng(seed)
        h, d = HIDDEN, _INPUT
        self.weights = {
            "paths": draw.normal(0, 0.15, (_PATHS, d)), "words": draw.normal(0, 0.15, (_WORDS, d)),
            "figures": draw.normal(0, 0.3, (_FIGURES, d)), "out": draw.normal(0, 0.2, (2 * h + d, 1)), "bias": np.zeros(1),
        }
        for way in ("f", "b"):
            self.weights[f"x{way}"] = draw.normal(0, d**-0.5, (d, 4 * h))
            self.weights[f"h{way}"] = draw.normal(0, h**-0.5, (h, 4 * h)) * 0.5
            self.weights[f"c{way}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])

    def forward(self, b: Batch, keep: bool = False):
        w, h = self.weights, HIDDEN
        raw = _sums(b.path_at, w["paths"][b.paths], b.steps * b.pages) * 0.3 + b.figures @ w["figures"]
        raw += _sums(b.word_at, w["words"][b.words] * b.shares[:, None], b.steps * b.pages)
        x = np.tanh(raw)
        states = {}
        for way in ("f", "b"):
            gates = (x @ w[f"x{way}"] + w[f"c{way}"]).reshape(b.steps, b.pages, 4 * h)
            hidden, cell = np.zeros((b.pages, h)), np.zeros((b.pages, h))
            all_h, all_c, all_g = (np.zeros((b.steps, b.pages, k * h)) for k in (1, 1, 4))
            for t in range(b.steps) if way == "f" else range(b.steps - 1, -1, -1):
                g = gates[t] + hidden @ w[f"h{way}"]
                g[:, : 3 * h] = _sigmoid(g[:, : 3 * h])
                g[:, 3 * h :] = np.tanh(g[:, 3 * h :])
                on = b.mask[t][:, None]
                cell = on * (g[:, h : 2 * h] * cell + g[:, :h] * g[:, 3 * h :])
                hidden = on * g[:, 2 * h : 3 * h] * np.tanh(cell)
                all_h[t], all_c[t], all_g[t] = hidden, cell, g
            states[way] = all_h, all_c, all_g
        joint = np.concatenate([states["f"][0].reshape(-1, h), states["b"][0].reshape(-1, h), x], axis=1)
        p = _sigmoid(joint @ w["out"] + w["bias"]).reshape(b.steps, b.pages)
        return (p, x, states, joint) if keep else p

    def gradients(self, b: Batch, wanted: np.ndarray) -> dict[str, np.ndarray]:
        w, h = self.weights, HIDDEN
        p, x, states, joint = self.forward(b, keep=True)
        off = ((p - wanted) * b.mask / b.mask.sum()).reshape(-1, 1)
        out = {"out": joint.T @ off, "bias": off.sum(axis=0)}
        back = off @ w["out"].T
        dx = back[:, 2 * h :]
        for k, way in enumerate(("f", "b")):
            all_h, all_c, all_g = states[way]
            from_above = back[:, k * h : (k + 1) * h].reshape(b.steps, b.pages, h)
            dgates = np.zeros_like(all_g)
            dh, dc = np.zeros((b.pages, h)), np.zeros((b.pages, h))
            order = list(range(b.steps)) if way == "f" else list(range(b.steps - 1, -1, -1))
            dwh = np.zeros_like(w[f"h{way}"])
            for place in range(b.steps - 1, -1, -1):
                t = order[place]
                prior = order[place - 1] if place else None
                on, g = b.mask[t][:, None], all_g[t]
                i, f, o, c = g[:, :h], g[:, h : 2 * h], g[:, 2 * h : 3 * h], g[:, 3 * h :]
                squashed = np.tanh(all_c[t])
                dh = (dh + from_above[t]) * on
                dc = (dc + dh * o * (1 - squashed**2)) * on
                before = all_c[prior] if prior is not None else np.zeros((b.pages, h))
                dg = np.concatenate([dc * c * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - c**2)], axis=1)
                dgates[t] = dg
                if prior is not None:
                    dwh += all_h[prior].T @ dg
                dh, dc = dg @ w[f"h{way}"].T, dc * f
            flat = dgates.reshape(-1, 4 * h)
            out[f"h{way}"], out[f"x{way}"], out[f"c{way}"] = dwh, x.T @ flat, flat.sum(axis=0)
            dx = dx + flat @ w[f"x{way}"].T
        draw = dx * (1 - x**2)
        out["figures"] = b.figures.T @ draw
        for name, at, which, by in (("paths", b.path_at, b.paths, 0.3), ("words", b.word_at, b.words, b.shares[:, None])):
            out[name] = np.zeros_like(w[name])
            np.add.at(out[name], which, draw[at] * by)
        return out

    def train(self, pages: list[list[Block]], epochs: int = EPOCHS, seed: int = 5) -> None:
        """Adam steps on batches of whole pages of like length, fewer the longer they are."""
        draw = random.Random(seed)
        pages = sorted((p for p in pages if p), key=len)
        batches, at = [], 0
        while at < len(pages):
            own = pages[at : at + 48]
            while len(own) > 1 and len(own) * len(own[-1]) > _TRAIN_BLOCKS:
                own = own[:-1]
            batches.append((batch_of(own), own))
            at += len(own)
        sides = []
        for b, own in batches:
            wanted = np.zeros((b.steps, b.pages))
            for j, blocks in enumerate(own):
                wanted[: len(blocks), j] = [page_label(x) for x in blocks]
            sides.append((b, wanted))
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        n = 0
        for epoch in range(epochs):
            draw.shuffle(sides)
            for b, wanted in sides:
                n += 1
                rate = 0.02 * (1 - 0.9 * epoch / max(epochs - 1, 1))
                for k, g in self.gradients(b, wanted).items():
                    g = np.clip(g, -1, 1)
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.01 * (g * g - second[k])
                    self.weights[k] -= rate * (first[k] / (1 - 0.9**n)) / (np.sqrt(second[k] / (1 - 0.99**n)) + 1e-8)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of main text for the blocks of every page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: -len(pages[i]))
        at = 0
        while at < len(order):
            n = max(1, _BLOCKS // len(pages[order[at]]))
            own = order[at : at + n]
            p = self.forward(batch_of([pages[i] for i in own]))
            for j, i in enumerate(own):
                out[i] = p[: len(pages[i]), j]
            at += n
        return out


def learn_labeller(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE, seed: int = 5) -> Labeller:
    """A labeller trained on about ``sample`` pages and ``MADE`` made-up ones for each.

    The sampled pages are brought together; their number is bounded, whatever the table's size.
    """
    held = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).alias("html")).where("html IS NOT NULL")
    rate = min(1.0, sample / max(held.count(), 1))
    chosen = F.pmod(F.xxhash64("page_id", F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30))
    rows = held.where(chosen).collect()
    texts = [r.html for r in sorted(rows, key=lambda r: (str(r.page_id), r.html))]
    read = [read_blocks(t) for t in texts]
    draw = random.Random(seed)
    contents = [[b.text for b in blocks if page_label(b)] for blocks in read]
    others = [b.text for blocks in read for b in blocks if not page_label(b)]
    sentences = [s for texts in contents for t in texts for s in t.split(". ") if s]
    made = []
    for content in contents:
        for _ in range(MADE if content else 0):
            around = draw.sample(others, min(len(others), 6)) + draw.sample(sentences, min(len(sentences), 8))
            around += draw.sample([t for texts in contents for t in texts[1:2]] or content, 1)
            made.append(read_blocks(made_up_page(content, around, draw), marked=True))
    found = Labeller(seed)
    if read:
        found.train(read + made, seed=seed)
    return found


def extract_text(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages``.

    A null or empty page, and one without main text, has an empty text.  Pages are read
    whole, however long.  Repeated rows each get their result; other columns are not
    looked at.  The weights (about 100 kB) are sent to the tasks.
    """
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(labeller)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        column = batch.column("html")
        for a, b in slices((len(t.as_buffer() or b"") if t.is_valid else 0 for t in column), 4 << 20):
            read = [read_blocks(t) for t in column[a:b].to_pylist()]
            for blocks, p in zip(read, shared.value.label(read), strict=True):
                texts.append(" ".join(x.text for x, q in zip(blocks, p.tolist(), strict=True) if q >= 0.5))
        return pa.record_batch({
            "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        })

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return map_batches(pages, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
