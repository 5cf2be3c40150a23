"""Toxicity by maximum-scoring segments of token log-odds.

1. *Weights.* Tokens are counted by class over labelled documents. A token's weight is the
   log-odds ratio of the two classes under an informative Dirichlet prior (the pooled
   counts times ``PRIOR_SHARE``), kept when its z-score is at least
   ``MIN_Z``. Tokens that training never saw take the weight of their first ``STEM``
   characters, learned alike. All other tokens cost ``DRIFT``, so random text scores downwards.
2. *Segments.* A linear scan finds every maximal-scoring segment of a document (the segments
   that cannot be made better by growing or shrinking, none overlapping).
3. *Extreme values.* For scores with negative drift the best segment of n random tokens follows an extreme-value
   law, P(S >= x) = 1 - exp(-K n exp(-lambda x)). lambda solves E[exp(lambda w)] = 1 over the tokens of
   harmless documents; K is fitted to
   their segments. Segments with P below
   ``SIGNIFICANT`` are the toxic passages.
4. *Aggregation.* A document's score is a logistic function, fitted on labelled documents that had no part in
   the weights, of its best segment's surprise -log10 P and of the sum over its significant ones.

Learning uses labelled rows whose crc32(doc_id as text) mod 3 is not 1 only; of those,
remainder 0 teaches the weights and remainder 2 the calibration, each at most ``FIT_ROWS``
rows chosen by a digest of the id. Scoring uses every token of every document, and nothing
but its text. Null and empty texts have no segment: their score is the calibration's value
without evidence. Null labels teach nothing; several labels of one id count as toxic if any is. Without
labelled rows of both classes every score is 0. Rows with null ids are scored, and
``held_out`` is false for them. Repeated rows are scored each. Extra columns are ignored.

Broadcast: the weights, at most ``MAX_WEIGHTS`` tokens.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialize

FIT_ROWS = 20_000
MAX_WEIGHTS = 100_000
PRIOR_SHARE = 0.1
MIN_Z = 3.0
MIN_WEIGHT = 1.0
STEM, STEM_MIN_WORDS = 4, 3
DRIFT = -0.7
SIGNIFICANT = 1e-2
THRESHOLD = 0.7
MAX_SURPRISE = 12.0
WORD = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def segments(weights: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first token, token after the last), in order.

    ``weights`` are (position, weight) of the tokens that do not cost ``drift``; the cost of
    the tokens between them is implied. Candidates are held on a stack with the cumulative score
    before and after them, and a link to the nearest candidate below that started lower. A new hit is merged
    leftwards into the nearest candidate that started lower, as long as that gains; the links lead
    there, so every candidate is passed once and the scan is linear in the hits. Where no candidate started
    lower, all of them are final.
    """
    done: list[tuple[float, int, int]] = []
    stack: list[list] = []  # [score before, score after, first, end, link]
    total, at = 0.0, 0
    for pos, w in weights:
        total += (pos - at) * drift
        at = pos + 1
        before, total = total, total + w
        if w <= 0:
            continue
        new, j = [before, total, pos, pos + 1, -1], len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= new[0]:
                j = stack[j][4]
            if j < 0:
                done += [(s[1] - s[0], s[2], s[3]) for s in stack]
                stack = [new]
                break
            if stack[j][1] >= new[1]:
                new[4] = j
                stack.append(new)
                break
            low = stack[j]
            new = [low[0], new[1], low[2], new[3], -1]
            del stack[j:]
            j = low[4]
    return done + [(s[1] - s[0], s[2], s[3]) for s in stack]


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    known: set[str] = field(default_factory=set)
    lam: float = 1.0
    k: float = 1.0
    coef: tuple[float, float, float] | None = None

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        get, stem, known = self.words.get, self.stems.get, self.known
        out = []
        for i, w in enumerate(words):
            x = get(w)
            if x is None and w not in known:
                x = stem(w[:STEM])
            if x is not None:
                out.append((i, x))
        return out

    def surprise(self, score: float, n: int) -> float:
        """-log10 P(best of n random tokens reaches ``score``)."""
        e = self.k * max(n, 1) * math.exp(-self.lam * score)
        p = -math.expm1(-e)
        return MAX_SURPRISE if p <= 10.0 ** -MAX_SURPRISE else -math.log10(p)

    def passages(self, text: str) -> tuple[int, list[tuple[float, int, int, float]]]:
        """Number of tokens and every segment as (surprise, first, end, score)."""
        words = tokens(text)
        found = segments(self.hits(words), DRIFT)
        return len(words), [(self.surprise(s, len(words)), a, b, s) for s, a, b in found]

    def evidence(self, text: str) -> tuple[float, float, int]:
        """(best surprise, sum over significant segments, their number)."""
        _, found = self.passages(text)
        level = -math.log10(SIGNIFICANT)
        strong = [x[0] for x in found if x[0] >= level]
        return max((x[0] for x in found), default=0.0), math.log1p(sum(strong)), len(strong)

    def score(self, best: float, total: float) -> float:
        if self.coef is None:
            return 0.0
        a, b, c = self.coef
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, a + b * best + c * total))))


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def log_odds(counts: dict[str, tuple[float, float]], share: float) -> dict[str, tuple[float, float]]:
    """(log-odds ratio, z) of each token from its (toxic, other) counts under the pooled prior."""
    n1, n0 = (sum(c[i] for c in counts.values()) for i in (0, 1))
    whole = share * (n1 + n0)
    out = {}
    for w, (a, b) in counts.items():
        p = (a + b) * share
        l1 = math.log((a + p) / max(n1 + whole - a - p, 1e-9))
        l0 = math.log((b + p) / max(n0 + whole - b - p, 1e-9))
        out[w] = (l1 - l0, (l1 - l0) / math.sqrt(1 / (a + p) + 1 / (b + p)))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, learned from the bounded folds described above."""
    toxic = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    model = Model()
    sample = {}
    for part in (0, 2):
        rows = toxic.where(fold(F.col("doc_id")) == part).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        sample[part] = materialize(ids.join(F.broadcast(rows), "doc_id").where("text is not null"), f"fold{part}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: dict[str, list[int]] = {}
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for w in set(tokens(t)):  # documents, so that one document's repeats do not count
                    c.setdefault(w, [0, 0])[0 if y else 1] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c)), pa.array([x[0] for x in c.values()], pa.int64()),
                                              pa.array([x[1] for x in c.values()], pa.int64())], names=["w", "a", "b"])

    def best(table: DataFrame, limit: int) -> dict[str, tuple[float, float]]:
        """Counts of the tokens that the toxic class has at all, the most toxic ones first."""
        kept = table.where("a > 0").orderBy(F.desc(F.col("a") / (F.col("b") + 1.0)), F.desc("a"), "w").limit(limit)
        return {r["w"]: (float(r["a"]), float(r["b"])) for r in kept.collect()}

    table = materialize(sample[0].mapInArrow(count, "w string, a long, b long").groupBy("w")
                        .agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "token-counts")
    total = table.agg(F.sum("a"), F.sum("b")).first()
    if not total[0] or not total[1]:
        return model
    rest = "\0rest"  # what the limit leaves out keeps the totals right
    stems = (table.where(F.length("w") > STEM).groupBy(F.substring("w", 1, STEM).alias("w"))
             .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.count(F.lit(1)).alias("k"))
             .where(F.col("k") >= STEM_MIN_WORDS).drop("k"))
    for source, into in ((table, model.words), (stems, model.stems)):
        counts = best(source, MAX_WEIGHTS)
        counts[rest] = (max(0.0, total[0] - sum(x[0] for x in counts.values())),
                        max(0.0, total[1] - sum(x[1] for x in counts.values())))
        odds = log_odds(counts, PRIOR_SHARE)
        odds.pop(rest)
        into.update({w: x for w, (x, z) in odds.items() if z >= MIN_Z and x >= MIN_WEIGHT})
    # frequent harmless words must not fall back to their stem
    model.known = {r["w"] for r in table.where("b > 0").orderBy(F.desc("b"), "w").limit(MAX_WEIGHTS).select("w").collect()}
    _calibrate(model, sample[2])
    return model


def _calibrate(model: Model, sample: DataFrame) -> None:
    """lambda and K from harmless documents, then the logistic function; bounded by the fold's rows."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                words = tokens(t)
                hits = shared.value.hits(words)
                found = segments(hits, DRIFT)
                rows.append((len(words), [x for _, x in hits], [s for s, _, _ in found]))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.list_(pa.float64())),
                 pa.array(list(cols[2]), pa.list_(pa.float64()))], names=["toxic", "n", "hits", "found"])

    rows = sample.select("text", "toxic").mapInArrow(scan, "toxic int, n long, hits array<double>, found array<double>").collect()
    calm = [r for r in rows if r["toxic"] == 0]
    if not calm or len(calm) == len(rows):
        model.words, model.stems = {}, {}
        return
    hits = np.array([x for r in calm for x in r["hits"]])
    n = sum(r["n"] for r in calm)
    model.lam = karlin_lambda(hits, n)
    # E[number of segments >= x] = K n exp(-lambda x), matched at the harmless segments' median
    calm_segments = np.array([v for r in calm for v in r["found"]])
    middle = float(np.median(calm_segments)) if len(calm_segments) else 0.0
    reached = max(int((calm_segments >= middle).sum()), 1)
    model.k = reached / max(n, 1) * math.exp(min(model.lam * middle, 300.0))
    x, y = [], []
    level = -math.log10(SIGNIFICANT)
    for r in rows:
        s = [model.surprise(v, r["n"]) for v in r["found"]]
        x.append((1.0, max(s, default=0.0), math.log1p(sum(v for v in s if v >= level))))
        y.append(r["toxic"])
    model.coef = tuple(logistic(np.array(x), np.array(y, dtype=float)))


def karlin_lambda(hits: np.ndarray, n: int) -> float:
    """The positive root of E[exp(lambda w)] = 1 for n tokens, ``hits`` of which do not cost DRIFT."""
    rest = max(n - len(hits), 1)

    def excess(lam: float) -> float:
        return (rest * math.exp(lam * DRIFT) + float(np.exp(np.minimum(lam * hits, 300)).sum())) / (rest + len(hits)) - 1

    lo, hi = 1e-6, 1.0
    while excess(hi) < 0 and hi < 8:
        hi *= 2
    if excess(hi) < 0:  # (almost) no positive token among the harmless
        return 8.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if excess(mid) < 0 else (lo, mid)
    return max(hi, 0.05)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-6) * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, n_passages (significant ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.evidence(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([m.score(x, s) for x, s, _ in got], pa.float64()),
                 pa.array([k for _, _, k in got], pa.int32())], names=["doc_id", "score", "n_passages"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = ids.mapInArrow(run, "doc_id long, score double, n_passages int")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "n_passages")


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant toxic passage: doc_id, first_word, end_word, segment_score, surprise."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    level = -math.log10(SIGNIFICANT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, a, e, s, p) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)
                    for p, a, e, s in shared.value.passages(t or "")[1] if p >= level]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            types = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)],
                                             names=["doc_id", "first_word", "end_word", "segment_score", "surprise"])

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(run, "doc_id long, first_word int, end_word int, segment_score double, surprise double")
