"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is split into its DOM's leaf blocks: runs of text that no block-level tag interrupts.
Every block has features of its ancestors (tags, class and id words) and of its text
(length, link share, punctuation, place on the page). A two-label chain (article or not) is
trained on labelled pages by maximum likelihood and decoded by Viterbi; the article blocks,
joined by newlines, are the main text.

The labelled pages are made by :func:`labelled_pages` from a seed: layouts that vary in
containers, order, class names and noise, filled with invented words, so that no text of the
input is needed and a fit depends on its parameters alone (``TRAIN_PAGES`` bounds it).

Character references are decoded, white space inside a block becomes one space, scripts,
styles, comments and the head are dropped by the parser. Null or empty html gives an empty
text, and so does a page without article blocks. Unclosed tags, stray closings and a page cut
off inside a tag are taken as a browser would. Repeated rows are extracted each; an empty table gives
an empty result; extra columns are ignored. Pages are independent: nothing is shuffled, and
the model (a few thousand numbers) travels with the function.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 500
SEED = 7
#: Starts every article text of a made-up page.
MARK = "\ue000"

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/><]*)([^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)>"
    r"|<(/?)([a-zA-Z][^\s/><]*)([^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")
# fixed values: tag sets of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED = frozenset("script style noscript template head title svg iframe object math".split())
#: Of the dropped ones, those that may stand inside a paragraph and do not end it.
UNSEEN = DROPPED - {"head", "title"}
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
NO_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                         "nav ol p pre section table ul".split())
CLOSES_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
               "th": ("td", "th"), "option": ("option",)}


@dataclass
class Block:
    text: str
    linked: int  # code points inside links
    path: tuple[str, ...]  # ancestors: tags, and class, id and role words with a dot before


def leaf_blocks(page: str) -> list[Block]:
    """The page's blocks that hold text, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    state = {"linked": 0, "path": (), "links": 0}

    def text(raw: str) -> None:
        if not raw:
            return
        if "&" in raw:
            raw = htmllib.unescape(raw)
        if raw.isspace():
            parts.append(" ")
            return
        if not any(not p.isspace() for p in parts):
            state["path"] = tuple(x for tag, names in stack for x in (tag, *names))
        parts.append(raw)
        if state["links"]:
            state["linked"] += len(raw.strip())

    def flush() -> None:
        joined = " ".join("".join(parts).split())
        if joined:
            out.append(Block(joined, state["linked"], state["path"]))
        parts.clear()
        state["linked"] = 0

    def close(tag: str, within: frozenset[str] | tuple = ()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                state["links"] -= sum(t == "a" for t, _ in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at = 0
    while m := _MARKUP.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        shut, tag, attrs = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE and tag not in UNSEEN:
            flush()
        elif tag in ("br", "img", "wbr"):
            parts.append(" ")
            continue
        if shut:
            close(tag)
            continue
        if tag in DROPPED and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            body = re.compile(r"<body\b", re.I).search(page, at) if tag == "head" else None
            if body and (not end or body.start() < end.start()):
                at = body.start()
            else:
                at = end.end() if end else len(page)
            continue
        if tag in VOID or attrs.rstrip().endswith("/") and tag not in INLINE and tag in VOID:
            continue
        if tag in NO_PARAGRAPH:
            close("p", frozenset(("article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "td")))
        for same in CLOSES_LIKE.get(tag, ()):
            close(same, frozenset(("ul", "ol", "dl", "table", "select")))
        names = []
        if "=" in attrs:
            for a in _NAMES.finditer(attrs):
                names += ["." + w for w in _WORDS.findall((a.group(1) or a.group(2) or a.group(3) or "").lower())]
        stack.append((tag, tuple(names)))
        state["links"] += tag == "a"
    text(page[at:])
    flush()
    return out


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of every block."""
    out = []
    n = len(blocks)
    for i, b in enumerate(blocks):
        t = b.text
        own = next((x for x in reversed(b.path) if x[0] != "." and x not in INLINE), "")
        share = b.linked / len(t)
        words = t.count(" ") + 1
        ends = t[-1] in ".!?…:;\"'”»)" if t else False
        f = ["bias", f"own={own}", f"words={min(words.bit_length(), 8)}", f"link={min(int(share * 4), 4)}",
             f"ends={ends}", f"commas={min(t.count(','), 3)}", f"stops={min(t.count('. '), 3)}",
             f"first={i < 2}", f"last={i >= n - 2}", f"sign={'©' in t or '®' in t or '|' in t}",
             f"own={own},words={min(words.bit_length(), 8)}", f"own={own},ends={ends}"]
        f += [f"in={x}" for x in set(b.path)]
        out.append(f)
    return out


@dataclass
class Chain:
    """Weights of the two-label chain: label 0 scores 0, label 1 the sum of its features."""

    weights: dict[str, float] = field(default_factory=dict)
    start: float = 0.0  # for label 1
    change: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi; ties go to label 0)."""
        get = self.weights.get
        (s00, s01), (s10, s11) = self.change.tolist()
        back: list[tuple[int, int]] = []
        v0 = v1 = 0.0
        for i, f in enumerate(features(blocks)):
            e = sum(get(x, 0.0) for x in f)
            if i == 0:
                v0, v1 = 0.0, self.start + e
                continue
            a, b = v0 + s00, v1 + s10
            c, d = v0 + s01, v1 + s11
            back.append((int(b > a), int(d > c)))
            v0, v1 = max(a, b), max(c, d) + e
        if not blocks:
            return []
        labels = [int(v1 > v0)]
        for choice in reversed(back):
            labels.append(choice[labels[-1]])
        return labels[::-1]


def train(pages: list[tuple[list[Block], list[int]]], steps: int = 200, ridge: float = 2e-3, rate: float = 0.15) -> Chain:
    """Maximum likelihood by gradient steps (Adam) with forward-backward sums over all pages."""
    index: dict[str, int] = {}
    rows, cols, longest = [], [], max(len(b) for b, _ in pages)
    gold = np.zeros((len(pages), longest), dtype=np.int64)
    mask = np.zeros((len(pages), longest), dtype=bool)
    for p, (blocks, labels) in enumerate(pages):
        gold[p, :len(labels)], mask[p, :len(labels)] = labels, True
        for i, f in enumerate(features(blocks)):
            for x in f:
                rows.append(p * longest + i)
                cols.append(index.setdefault(x, len(index)))
    rows, cols = np.array(rows), np.array(cols)
    size = len(index)
    theta = np.zeros(size + 5)  # features, start, the four changes
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    both = mask[:, 1:] & mask[:, :-1]
    seen = np.array([[np.sum(both & (gold[:, :-1] == a) & (gold[:, 1:] == b)) for b in (0, 1)] for a in (0, 1)], dtype=float)
    for step in range(1, steps + 1):
        e = np.bincount(rows, theta[cols], len(pages) * longest).reshape(gold.shape)
        change = theta[size + 1:].reshape(2, 2)
        fwd = np.zeros((*gold.shape, 2))
        fwd[:, 0, 1] = theta[size] + e[:, 0]
        for t in range(1, longest):
            new = np.logaddexp(fwd[:, t - 1, :1] + change[0], fwd[:, t - 1, 1:] + change[1])
            new[:, 1] += e[:, t]
            fwd[:, t] = np.where(mask[:, t, None], new, fwd[:, t - 1])
        bwd = np.zeros_like(fwd)
        total = np.logaddexp(fwd[:, -1, 0], fwd[:, -1, 1])
        pairs = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            nxt = bwd[:, t + 1] + np.stack([np.zeros(len(pages)), e[:, t + 1]], axis=1)
            joint = fwd[:, t, :, None] + change + nxt[:, None, :] - total[:, None, None]
            pairs += np.exp(joint[both[:, t]]).sum(axis=0)
            old = np.logaddexp(change[:, 0] + nxt[:, :1], change[:, 1] + nxt[:, 1:])
            bwd[:, t] = np.where(mask[:, t + 1, None], old, bwd[:, t + 1])
        one = np.where(mask, np.exp(fwd[:, :, 1] + bwd[:, :, 1] - total[:, None]), 0)
        miss = np.where(mask, one - gold, 0).ravel()
        grad = np.concatenate([np.bincount(cols, miss[rows], size), [(one[:, 0] - gold[:, 0]).sum()],
                               (pairs - seen).ravel()]) / len(pages) + ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Chain({x: float(theta[i]) for x, i in index.items()}, float(theta[size]), theta[size + 1:].reshape(2, 2))


def labelled_pages(number: int = TRAIN_PAGES, seed: int = SEED) -> Iterator[tuple[list[Block], list[int]]]:
    """Made-up pages with the label of every leaf block (1: article).

    Texts are invented, so every block can carry a mark that tells its label: article texts
    start with a private-use character, which is taken off after parsing.
    """
    rng = random.Random(seed)
    pick, chance = rng.choice, rng.random

    def word() -> str:
        return "".join(pick(("an", "er", "ti", "lo", "é", "sch", "mu", "ra", "ing", "os", "ve", "th")) for _ in range(rng.randint(1, 4)))

    def phrase(lo: int, hi: int) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi)))

    def sentences(n: int) -> str:
        return " ".join(phrase(3, 18).capitalize() + pick((".", ".", ".", "!", "?", ",", "")) for _ in range(n))

    def tag(name: str, body: str, *names: str) -> str:
        label = pick((f' class="{" ".join(names)}"', f' id="{"-".join(names)}"')) if names else ""
        return f"<{name}{label}>{body}</{name}>"

    def links(n: int) -> str:
        return "".join(tag("li", f'<a href="/{word()}">{phrase(1, 3)}</a>') for _ in range(n))

    def notice() -> str:
        kind = pick((("ad",), ("advert",), ("ads", "banner"), ("sponsored",), ("promo",), ("cookie", "notice"), ("newsletter",),
                     ("notice",), ("alert",), ("share",), ("social",), ("related",), ("breadcrumb",), ("popup",)))
        body = pick((phrase(2, 8), sentences(1), sentences(2), f"<p>{sentences(1)}</p>", tag("ul", links(3))))
        return tag(pick(("div", "div", "section", "p", "aside")), body, *kind)

    def comments() -> str:
        one = lambda: tag(pick(("div", "li")), f"<p>{sentences(rng.randint(1, 3))}</p>", "comment")
        return tag(pick(("section", "div", "ol")), "<h3>" + phrase(1, 3) + "</h3>" + "".join(one() for _ in range(rng.randint(1, 5))),
                   pick(("comments", "discussion", "responses", "replies")))

    def form() -> str:
        return tag("form", f"<label>{phrase(1, 3)}</label><input><button>{word()}</button>" + pick(("", f"<p>{phrase(3, 9)}</p>")))

    def article() -> str:
        mark = MARK
        out = [f"<{(h := pick(('h1', 'h1', 'h2')))}>{mark}{pick((phrase(3, 9), sentences(1), ' | '.join(phrase(1, 2) for _ in range(6))))}</{h}>"]
        for _ in range(rng.randint(1, 14)):
            x = chance()
            body = pick((phrase(1, 2), phrase(1, 3) + ".", sentences(1), sentences(rng.randint(2, 12)),
                         " | ".join(phrase(1, 1) for _ in range(rng.randint(3, 30))), phrase(5, 60) + "$$$ ###"))
            if chance() < 0.15:
                body += f' <a href="#">{phrase(1, 3)}</a> ' + phrase(0, 5)
            if x < 0.72:
                out.append(pick((f"<p>{mark}{body}</p>", f"<p>{mark}{body}</p>", f"<p>{mark}<b>{body}<br>", f"<p>{mark}{body}")))
            elif x < 0.78:
                out.append(f"<h2>{mark}{phrase(2, 6)}</h2>")
            elif x < 0.84:
                out.append(tag(pick(("ul", "ol")), "".join(tag("li", mark + phrase(2, 14)) for _ in range(3))))
            elif x < 0.88:
                out.append(f"<blockquote>{mark}{body}</blockquote>")
            elif x < 0.91:
                out.append(f"<pre>{mark}{phrase(3, 20)}</pre>")
            elif x < 0.94:
                out.append(tag("table", "".join(f"<tr><td>{mark}{phrase(1, 4)}</td><td>{mark}{phrase(1, 4)}</td></tr>" for _ in range(2))))
            else:
                out.append(pick((notice, notice, form))())
        body = "".join(out)
        return pick((lambda: tag("article", body), lambda: tag("article", body), lambda: tag("main", body), lambda: tag("article", body, "post"),
                     lambda: tag("div", body, pick(("content", "main", "article", "entry", "post", "story"))),
                     lambda: tag("main", tag("article", body)), lambda: tag("div", body)))()

    for _ in range(number):
        top = [pick((tag("nav", tag("ul", links(rng.randint(3, 8)))), tag("header", phrase(1, 4) + tag("nav", tag("ul", links(4)))),
                     tag("div", tag("ul", links(5)), pick(("menu", "nav", "navbar"))), tag("header", tag("h1", phrase(1, 4))), ""))]
        top += [notice() for _ in range(rng.randint(0, 2))]
        side = [pick((tag("aside", tag("h3", phrase(1, 3)) + tag("ul", links(4))), tag("aside", f"<p>{sentences(2)}</p>"),
                      tag("div", tag("h4", phrase(1, 3)) + f"<p>{sentences(1)}</p>", "sidebar"), "", ""))]
        low = [pick((comments, str, str))()] + [pick((form, notice, str, str))()]
        foot = pick((tag("footer", f"&copy; {phrase(1, 3)} &middot; {sentences(rng.randint(1, 3))}"), tag("footer", tag("p", phrase(3, 12)) + tag("ul", links(3))),
                     tag("div", "&copy; " + phrase(2, 8), "footer"), ""))
        body = "".join(top + (side if chance() < 0.5 else []) + [article()] + low + (side if chance() < 0.3 else []) + [foot])
        blocks = leaf_blocks(f"<html><head><title>{phrase(2, 5)}</title></head><body>{body}</body></html>")
        labels = [MARK in b.text for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MARK, "").strip() or "-"
        yield blocks, [int(x) for x in labels]


def fit(number: int = TRAIN_PAGES, seed: int = SEED) -> Chain:
    return train(list(labelled_pages(number, seed)))


def main_text(page: str | None, chain: Chain) -> str:
    blocks = leaf_blocks(page) if page else []
    return "\n".join(b.text for b, y in zip(blocks, chain.decode(blocks), strict=True) if y)


def extract(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(chain or fit())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, shared.value) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
