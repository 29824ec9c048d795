"""Main-text extraction: a bidirectional LSTM labels every leaf block of a page.

A block's vector holds its tag path (tags, and words of class, id, role and type,
hashed), its words (hashed, length 1), and a few shares (length, link text,
punctuation, place on the page). The LSTM reads a page's blocks in both
directions, so each label rests on the whole page. Blocks labelled as main text
are joined in page order.

The network is trained here, by numpy, on at most TRAIN_PAGES pages (least hash
of the url and id first, of those up to TRAIN_CHARS characters) whose article
element gives the labels; half of the training sequences lay out the blocks of
these pages anew, in containers named in CONTENT and BOILERPLATE below, with
forms, notices, sidebars and reader comments, so that the labels do not hang on
the layout of the sample. Fixed seeds; the same pages give the same weights.

Defined results: a null or empty page gives an empty text; repeated rows and null
ids are rows of their own; without any page that has an article element, training
uses only laid-out pages with fixed words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwise.llm.html import WORD, Block, blocks

PATH_DIMS = 96
WORD_DIMS = 48
OTHER = 7
INPUT = PATH_DIMS + WORD_DIMS + OTHER
HIDDEN = 20
TRAIN_PAGES = 120
TRAIN_CHARS = 20_000
STEPS = 260
BATCH = 12
LENGTH = 60
#: Padded blocks of one batch at labelling.
CELLS = 6_000

#: Containers of main text, from outside in.
CONTENT = [["article"], ["main"], ["main", "article"], ["div class=content"], ["div id=content"], ["div class=post-content"],
           ["div class=entry-content"], ["section class=article-body"], ["div id=main", "div class=story"],
           ["article class=post", "div class=text"], ["div class=page", "article"], ["div role=main"]]
#: Containers of all else; the last tag holds the text.
BOILERPLATE = [["nav", "ul", "li", "a"], ["header", "div class=logo"], ["header", "p"], ["header", "nav", "ul", "li", "a"],
               ["div class=menu", "ul", "li", "a"], ["div id=navbar", "a"], ["aside", "p"], ["aside", "h3"],
               ["aside", "ul", "li", "a"], ["div class=sidebar", "p"], ["div class=widget", "ul", "li", "a"], ["div class=ad"],
               ["div class=ads", "p"], ["div class=advert", "p"], ["div class=advertisement"], ["div class=sponsored", "p"],
               ["div class=promo", "p"], ["div class=banner"], ["div class=cookie-notice"], ["div class=cookie-banner", "p"],
               ["div id=consent", "p"], ["div class=notice", "p"], ["div class=alert"], ["form", "label"], ["form", "p"],
               ["form class=newsletter", "p"], ["div class=subscribe", "p"], ["form class=search", "label"],
               ["section class=comments", "p"], ["section id=comments", "div class=comment", "p"],
               ["div class=comments", "div class=comment"], ["div id=comments", "ul", "li class=comment", "p"],
               ["ol class=commentlist", "li", "p"], ["div class=reader-comments", "p"], ["section class=comments", "h2"],
               ["footer"], ["footer", "p"], ["footer", "ul", "li", "a"], ["div class=footer", "p"],
               ["div class=copyright"], ["div class=related", "ul", "li", "a"], ["section class=related", "p"],
               ["div class=share", "a"], ["div class=breadcrumb", "a"], ["div class=social", "a"], ["div class=disclaimer", "p"]]
#: Of these, what may stand inside the article as well.
INSIDE = [x for x in BOILERPLATE if x[0].split("=")[-1].split("-")[0] in
          ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "aside", "form", "related", "share", "comments",
           "notice", "newsletter", "social", "nav")]


def features(page: list[Block]) -> np.ndarray:
    """(blocks, INPUT) vectors of a page's blocks."""
    x = np.zeros((len(page), INPUT), np.float32)
    paths: dict[tuple, np.ndarray] = {}
    for k, b in enumerate(page):
        if b.path not in paths:
            v = np.zeros(PATH_DIMS, np.float32)
            for depth, entry in enumerate(reversed(b.path)):
                tag, *marks = entry.lower().split(" ")
                near = 1.0 if depth < 3 else 0.7
                for feature in [tag, *(w for m in marks for w in WORD.findall(m.partition("=")[2]))]:
                    h = zlib.crc32(feature.encode())
                    v[h % PATH_DIMS] += near if h >> 31 else -near
            paths[b.path] = v
        x[k, :PATH_DIMS] = paths[b.path]
        ws = b.text.split()
        h = np.fromiter((zlib.crc32(w.lower().encode()) for w in ws), np.uint32, len(ws))
        v = np.bincount(h % WORD_DIMS, 1.0 - 2.0 * (h >> 31), WORD_DIMS)
        x[k, PATH_DIMS:PATH_DIMS + WORD_DIMS] = v / max(1.0, float(np.sqrt(v @ v)))
        n = len(b.text)
        x[k, -OTHER:] = (np.log1p(n) / 6, np.log1p(len(ws)) / 5, min(1.0, b.linked / n), sum(b.text.count(c) for c in ".,;:!?") / n * 10,
                         k / len(page), 1 - k / len(page), len(b.path) / 10)
    return x


class BiLstm:
    """A bidirectional LSTM with one logit per step; batches are padded (time, batch, input) with a mask."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        if weights is None:
            rng = np.random.Generator(np.random.PCG64(seed))
            weights = {"out": rng.standard_normal(2 * HIDDEN) * 0.2, "bias": np.zeros(1)}
            for d in "fb":
                weights["w" + d] = rng.standard_normal((INPUT + HIDDEN, 4 * HIDDEN)) / np.sqrt(INPUT + HIDDEN)
                weights["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        self.weights = {k: v.astype(np.float32) for k, v in weights.items()}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        w, c = self.weights["w" + d], self.weights["c" + d]
        given = x @ w[:INPUT] + c
        steps, batch = mask.shape
        h = s = np.zeros((batch, HIDDEN), np.float32)
        out = np.zeros((steps, batch, HIDDEN), np.float32)
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = given[t] + h @ w[INPUT:]
            g = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:]
            u = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * s + i * u
            y = np.tanh(new)
            if keep is not None:
                keep.append((t, h, s, i, f, o, u, y))
            h, s = m * (o * y) + (1 - m) * h, m * new + (1 - m) * s
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = self.weights["out"]
        return (self._run(x, mask, "f") @ out[:HIDDEN] + self._run(x, mask, "b") @ out[HIDDEN:] + self.weights["bias"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, by backpropagation through time."""
        kept: dict[str, list] = {"f": [], "b": []}
        hid = {d: self._run(x, mask, d, kept[d]) for d in "fb"}
        out = self.weights["out"]
        z = hid["f"] @ out[:HIDDEN] + hid["b"] @ out[HIDDEN:] + self.weights["bias"]
        err = mask * (1 / (1 + np.exp(-z)) - label) / mask.sum()
        grad = {"out": np.concatenate([np.einsum("tb,tbh->h", err, hid[d]) for d in "fb"]), "bias": err.sum().reshape(1)}
        for d, head in (("f", out[:HIDDEN]), ("b", out[HIDDEN:])):
            w = self.weights["w" + d]
            dw, dc = np.zeros_like(w), np.zeros(4 * HIDDEN, np.float32)
            dh = ds = np.zeros((mask.shape[1], HIDDEN), np.float32)
            for t, h, s, i, f, o, u, y in reversed(kept[d]):
                m = mask[t][:, None]
                dh = dh + err[t][:, None] * head
                go = m * dh
                gs = m * ds + go * o * (1 - y * y)
                dz = np.concatenate([gs * u * i * (1 - i), gs * s * f * (1 - f), go * y * o * (1 - o),
                                     gs * i * (1 - u * u)], 1)
                dw[:INPUT] += x[t].T @ dz
                dw[INPUT:] += h.T @ dz
                dc += dz.sum(0)
                dh = dz @ w[INPUT:].T + (1 - m) * dh
                ds = gs * f + (1 - m) * ds
            grad["w" + d], grad["c" + d] = dw, dc
        return grad


def padded(xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(x) for x in xs)
    x = np.zeros((steps, len(xs), INPUT), np.float32)
    mask = np.zeros((steps, len(xs)), np.float32)
    for k, v in enumerate(xs):
        x[:len(v), k], mask[:len(v), k] = v, 1
    return x, mask


def _is_main(path: tuple[str, ...]) -> bool:
    """The training label of a page's own block: in an article, and not in a part of it that is none."""
    tags = [p.split(" ")[0] for p in path]
    return "article" in tags and not {"nav", "aside", "footer", "form"} & set(tags)


def _laid_out(rng: np.random.Generator, texts: list[str], short: list[str]) -> tuple[list[Block], list[int]]:
    """A page made of known texts: boilerplate, main text with some boilerplate inside, boilerplate."""
    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    outer = ["html", "body"] + ([pick(["div class=wrapper", "div id=page", "div class=container", "div"])] if rng.random() < 0.5 else [])
    page, label = [], []

    def boilerplate(chosen: list[str], within: list[str]) -> None:
        leaf = chosen[-1].split(" ")[0]
        for _ in range(int(rng.integers(1, 6 if leaf in ("a", "p") else 3))):
            text = pick(short) if leaf in ("a", "label", "h3") or rng.random() < 0.3 else pick(texts)
            page.append(Block(text, tuple(within + chosen), len(text) if leaf == "a" else 0))
            label.append(0)

    for _ in range(int(rng.integers(0, 5))):
        boilerplate(pick(BOILERPLATE), outer)
    main = outer + pick(CONTENT)
    if rng.random() < 0.8:
        inner = main + (["header"] if rng.random() < 0.1 else []) + [pick(["h1", "h1", "h2"])]
        page.append(Block(pick(texts)[:60], tuple(inner), 0))
        label.append(1)
    for _ in range(int(rng.integers(1, 16))):
        if rng.random() < 0.07:
            boilerplate(pick(INSIDE), main)
        leaf = pick([["p"], ["p"], ["p"], ["p"], ["p", "b"], ["h2"], ["blockquote", "p"], ["ul", "li"], ["div"], ["section", "p"]])
        text = pick(short) if rng.random() < 0.12 else pick(texts)
        page.append(Block(text, tuple(main + leaf), 0))
        label.append(1)
    for _ in range(int(rng.integers(0, 6))):
        boilerplate(pick(BOILERPLATE), main if rng.random() < 0.1 else outer)
    return page, label


def train(pages: list[str], steps: int = STEPS, seed: int = 11) -> dict[str, np.ndarray]:
    """Weights of a network trained on these pages and on laid-out ones."""
    rng = np.random.Generator(np.random.PCG64(seed))
    known = [b for p in pages if (b := blocks(p))]
    texts = [b.text for p in known for b in p if len(b.text) > 40] or ["some words of a text that goes on for a while."]
    short = [b.text for p in known for b in p if len(b.text) <= 40] or ["home", "more"]
    own = [(p, [int(_is_main(b.path)) for b in p]) for p in known]
    own = [(p, y) for p, y in own if any(y)]
    net = BiLstm()
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        batch = []
        for k in range(BATCH):
            page, y = own[int(rng.integers(len(own)))] if own and k % 2 else _laid_out(rng, texts, short)
            at = int(rng.integers(max(1, len(page) - LENGTH + 1)))
            batch.append((features(page)[at:at + LENGTH], y[at:at + LENGTH]))
        x, mask = padded([b[0] for b in batch])
        label = np.zeros_like(mask)
        for k, (_, y) in enumerate(batch):
            label[:len(y), k] = y
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in net.gradients(x, mask, label).items():
            g = np.clip(g, -1, 1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.weights[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                               / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net.weights


def label_pages(net: BiLstm, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, whether each block is main text; pages of like length share a batch."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        n = 1
        while at + n < len(order) and (n + 1) * len(pages[order[at + n]]) <= CELLS:
            n += 1
        some = order[at:at + n]
        z = net.logits(*padded([features(pages[k]) for k in some]))
        for j, k in enumerate(some):
            out[k] = z[:len(pages[k]), j] > 0
        at += n
    return out


def _extracted(weights: dict[str, np.ndarray], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    net = BiLstm(weights)
    for b in batches:
        for at in range(0, len(b), 200):
            part = b.iloc[at:at + 200]
            pages = [blocks(h) for h in part["html"]]
            texts = ["\n".join(x.text for x, y in zip(p, main) if y) for p, main in zip(pages, label_pages(net, pages))]
            yield pd.DataFrame({"page_id": part["page_id"].astype("Int64"), "url": part["url"], "text": texts,
                                "n_chars": [len(t) for t in texts],
                                "n_blocks": [len(p) for p in pages]})


def training_pages(pages: DataFrame, limit: int = TRAIN_PAGES) -> list[str]:
    """At most ``limit`` pages of at most TRAIN_CHARS characters, least hash of id and url first.

    The hashes are picked first, so that no task sends more than ``limit`` numbers; of pages
    with the same id and url, one is taken.
    """
    some = pages.filter(F.char_length("html").between(1, TRAIN_CHARS)) \
        .select(F.xxhash64("page_id", "url").alias("h"), "html")
    picked = [r[0] for r in some.select("h").distinct().orderBy("h").limit(limit).collect()]
    if not picked:
        return []
    return [r[1] for r in some.filter(F.col("h") <= picked[-1]).groupBy("h").agg(F.min("html")).orderBy("h").collect()]


def extract(pages: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars, n_blocks."""
    weights = weights or train(training_pages(pages))
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html").mapInPandas(
        lambda x: _extracted(weights, x), "page_id long, url string, text string, n_chars long, n_blocks long")
