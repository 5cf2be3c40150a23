"""Mixing sources to target weights by soft domain membership.

1. A classifier learns domains from the labelled table: Gaussian naive Bayes over a few
   measures of the whole text, among them how many words of a learned list per domain the
   text holds. It gives every document its domain posteriors p_dk.
2. Rates r_d >= 0 are fitted so that the expected domain token totals match the targets:
   minimise 1/2 * sum_k (sum_d r_d w_d p_dk / T - target_k)^2, w_d the document's tokens and T
   their total, by projected gradient in the metric of w_d / T, from r_d = 1. A step is
   r_d <- max(0, r_d - eta * sum_k p_dk * residual_k): it needs only the few residuals, so
   each iteration is one distributed sum, and a rate is a fold over the residuals so far.
   The start at 1 and the small steps keep rates near 1 where the targets allow it.

Domains: ``toxic`` (toxic = 1), else ``high`` or ``low`` by quality; rows with null labels
teach nothing. The word lists are learned from a bounded sample of labelled rows
(``LEXICON_ROWS``, taken by a digest of the id); all else uses every row.

Null or empty texts have no tokens: their rate does not matter to the totals and they get
the rate of their posteriors. Repeated rows each get a rate. Without usable labels every
posterior is equal. An empty table gives an empty result. Only built-in expressions run.
Driver values: word lists of ``LEXICON_WORDS`` per domain, class moments, residuals.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialize, neutral

DOMAINS = ("high", "low", "toxic")
#: Target token shares of the mix, as parts of the tokens that go in.
TARGETS = {"high": 0.80, "low": 0.12, "toxic": 0.08}
LEXICON_ROWS = 20_000
LEXICON_WORDS = 24
ITERATIONS, TOLERANCE, SAFE_STEPS = 60, 1e-4, 6
MIN_VARIANCE = 1e-2
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """Lower-case words of a text, apart from common punctuation; may hold one empty word."""
    return F.split(F.trim(F.translate(F.lower(text), "\n\t\r.,;:!?\"()", " " * 12)), " +")


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, "toxic").when((toxic == 0) & (quality == 1), "high") \
        .when((toxic == 0) & (quality == 0), "low")


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, domain of the usable labels; one per id (of contradicting rows the least)."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          domain_of(F.col("quality"), F.col("toxic")).alias("domain"))
            .where("doc_id is not null and domain is not null")
            .groupBy("doc_id").agg(F.min("domain").alias("domain")))


def learn_lexicons(docs: DataFrame, known: DataFrame, rows: int = LEXICON_ROWS) -> list[list[str]]:
    """For every domain the words that most raise its odds (document counts, z of log odds)."""
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = texts.join(F.broadcast(sample), "doc_id")  # at most ``rows`` rows
    each = seen.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    counts = materialize(each.where("word != ''").groupBy("word")
                         .agg(*(F.sum((F.col("domain") == d).cast("double")).alias(d) for d in DOMAINS)), "words")
    total = {r["domain"]: r["count"] for r in seen.groupBy("domain").count().collect()}
    out = []
    for d in DOMAINS:
        n1 = total.get(d, 0) + 1.0
        n0 = sum(v for k, v in total.items() if k != d) + 1.0
        a, b = F.col(d) + 0.5, sum((F.col(x) for x in DOMAINS if x != d), F.lit(0.5))
        z = (F.log(a / n1) - F.log(b / n0)) / F.sqrt(1 / a + 1 / b)
        top = counts.select("word", z.alias("z")).where("z > 3").orderBy(F.desc("z"), "word").limit(LEXICON_WORDS)
        out.append([r["word"] for r in top.collect()])
    return out


def features(text: Column, lexicons: list[list[str]]) -> list[Column]:
    """Token count first, then the classifier's measures."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    w = words(text)
    n = F.size(w) - F.array_contains(w, "").cast("int")
    out = [n.cast("long"), F.log1p(n.cast("double")),
           10 * F.sqrt((chars - F.length(F.translate(text, SYMBOLS, ""))) / chars),
           10 * F.sqrt(F.length(F.translate(text, "0123456789", "")) / chars),
           F.log(chars / (n + 1)),
           10 * (chars - F.length(F.translate(text, "\n", ""))) / chars]
    for lex in lexicons:
        hit = F.size(F.array_intersect(w, F.array(*map(F.lit, lex)))) if lex else F.lit(0)
        out.append(F.log1p(hit.cast("double")))
    return out


def with_features(docs: DataFrame, lexicons: list[list[str]]) -> tuple[DataFrame, list[str]]:
    f = features(F.col("text"), lexicons)
    names = [f"_f{i}" for i in range(len(f) - 1)]
    return docs.withColumns(dict(zip(["_tokens", *names], f, strict=True))), names


def learn_classes(measured: DataFrame, known: DataFrame, names: list[str]) -> list[tuple | None]:
    """Per domain (log prior, means, variances) from every labelled row."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in names:
        aggs += [F.avg(c).alias(f"m{c}"), F.var_pop(c).alias(f"v{c}")]
    got = {r["domain"]: r for r in measured.join(known, "doc_id").groupBy("domain").agg(*aggs).collect()}
    total = sum(r["n"] for r in got.values())
    return [(math.log(got[d]["n"] / total), [got[d][f"m{c}"] for c in names],
             [max(got[d][f"v{c}"], MIN_VARIANCE) for c in names]) if d in got else None for d in DOMAINS]


def posteriors(classes: list[tuple | None], names: list[str]) -> list[Column]:
    if not any(classes):
        return [F.lit(1.0 / len(DOMAINS)) for _ in DOMAINS]
    logs = []
    for c in classes:
        if c is None:
            logs.append(F.lit(-1e9))
            continue
        prior, means, variances = c
        s = F.lit(prior - 0.5 * sum(math.log(v) for v in variances))
        for x, m, v in zip(names, means, variances, strict=True):
            s = s - (F.col(x) - m) * (F.col(x) - m) / (2 * v)
        logs.append(s)
    top = F.greatest(*logs)
    exps = [F.exp(x - top) for x in logs]
    return [e / sum(exps[1:], exps[0]) for e in exps]


def rate_of(p: list[Column], steps: list[list[float]]) -> Column:
    """The rate after the given (already scaled) residuals, folded from 1."""
    if not steps:
        return F.lit(1.0)
    # element i of the fold is (residual_1, ..., residual_K) of iteration i
    vectors = F.array(*[F.array(*map(F.lit, s)) for s in steps])
    return F.aggregate(vectors, F.lit(1.0), lambda r, g: F.greatest(
        F.lit(0.0), r - sum((p[k] * g[k] for k in range(1, len(p))), p[0] * g[0])))


def fit_rates(table: DataFrame, targets: dict[str, float], iterations: int = ITERATIONS,
              tolerance: float = TOLERANCE) -> tuple[list[list[float]], list[float]]:
    """The scaled residuals of every iteration, for :func:`rate_of`, and what is left per domain.

    What is left is the mix's token share less its target under the returned rates; where it
    exceeds ``tolerance`` the iterations did not suffice or no rates reach the targets.

    ``table`` holds ``_tokens`` and ``_p0 .. _pK-1``. The objective is quadratic with at most
    K nonzero eigenvalues, those of the token-weighted second moments of the posteriors, so
    step sizes go through their inverses: while no rate is held at zero, K steps solve it.
    Whenever a step has not lowered the residual, the next ``SAFE_STEPS`` take the inverse of
    the largest eigenvalue, which always descends.
    """
    k = len(DOMAINS)
    p = [F.col(f"_p{i}") for i in range(k)]
    w = F.col("_tokens").cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    total, *moments = table.agg(F.sum(w), *(F.sum(w * p[i] * p[j]) for i, j in pairs)).first()
    if not total:
        return [], []
    gram = np.zeros((k, k))
    for (i, j), m in zip(pairs, moments, strict=True):
        gram[i, j] = gram[j, i] = m / total
    eigen = np.linalg.eigvalsh(gram)[::-1]
    largest = max(float(eigen[0]), 1e-12)
    cycle = [1 / float(x) for x in eigen if x > 1e-6 * largest] or [1 / largest]
    goal = [targets[d] for d in DOMAINS]
    steps: list[list[float]] = []
    before, safe, turn = float("inf"), 0, 0
    while True:
        sums = table.select(w.alias("w"), *[x.alias(f"p{i}") for i, x in enumerate(p)], rate_of(p, steps).alias("r")) \
            .agg(*(F.sum(F.col("w") * F.col("r") * F.col(f"p{i}")) for i in range(k))).first()
        residual = [s / total - t for s, t in zip(sums, goal, strict=True)]
        if max(map(abs, residual)) <= tolerance or len(steps) == iterations:
            return steps, residual
        norm = sum(x * x for x in residual)
        if norm >= before and not safe:
            safe = SAFE_STEPS
        before = norm
        if safe:
            eta, safe = 1 / largest, safe - 1
        else:
            eta, turn = cycle[turn % len(cycle)], turn + 1
        steps.append([eta * x for x in residual])


class Mixer:
    """Classifier and rates fitted to one corpus; gives columns for any rows of that corpus."""

    def __init__(self, docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None):
        """``targets``: wanted share of the input's tokens per domain; None: ``TARGETS``.

        ``residual`` holds what the rates leave of each target; a warning tells where that is
        more than ``TOLERANCE``.
        """
        known = materialize(labelled(labels), "known")
        self.lexicons = learn_lexicons(docs, known)
        ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        measured, self.names = with_features(ids, self.lexicons)
        measured = materialize(measured.drop("text"), "features")
        self.classes = learn_classes(measured, known, self.names)
        p = posteriors(self.classes, self.names)
        self.table = materialize(measured.select("doc_id", "_tokens", *(x.alias(f"_p{i}") for i, x in enumerate(p))),
                                 "posteriors")
        self.targets = targets or TARGETS
        self.steps, left = fit_rates(self.table, self.targets)
        self.residual = dict(zip(DOMAINS, left, strict=False))  # empty without tokens
        if any(abs(x) > TOLERANCE for x in left):
            warnings.warn(f"mixing targets {self.targets} not reached in {len(self.steps)} iterations: "
                          f"share less target {self.residual}", stacklevel=2)

    def rates(self) -> DataFrame:
        """doc_id, n_tokens, the posteriors and the rate of every document."""
        p = [F.col(f"_p{i}") for i in range(len(DOMAINS))]
        return self.table.select("doc_id", F.col("_tokens").alias("n_tokens"),
                                 *(c.alias(f"p_{d}") for c, d in zip(p, DOMAINS, strict=True)),
                                 rate_of(p, self.steps).alias("rate"))

    def resample(self, docs: DataFrame) -> DataFrame:
        """``docs`` with each row as often as its rate says, all columns kept.

        A rate's whole part gives copies for certain and its fraction one more by a digest of
        the row, so a rate of one or more never loses a document and a re-run agrees. The
        rate follows from the row itself; nothing is joined or shuffled.
        """
        docs, names = neutral(docs)
        rows, _ = with_features(docs, self.lexicons)
        # written, so that the optimizer cannot copy the measures' expressions into each of their uses
        rows = materialize(rows, "rows")
        rows = rows.withColumns({f"_p{i}": x for i, x in enumerate(posteriors(self.classes, self.names))})
        rate = rate_of([F.col(f"_p{i}") for i in range(len(DOMAINS))], self.steps)
        draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30).cast("long")) / float(1 << 30)
        rows = materialize(rows.withColumn("_copies", F.floor(rate + draw).cast("int")).select(*docs.columns, "_copies"),
                           "copies")
        return (rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
                .select(*docs.columns).toDF(*names))
