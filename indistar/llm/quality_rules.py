"""Host-level quality rules: rule failures per host, shrunk by an empirical beta prior.

Every document is measured on its whole text, and a document that fails a base rule is
rejected. The failures are then added up by host. A host with few documents says little by
its raw failure rate, so the rate is shrunk: hosts' true rates are taken as draws from a
beta distribution whose two parameters are estimated from all hosts by moments, and a
host's rate is the posterior mean (failures + a) / (documents + a + b). A host whose
shrunk rate exceeds ``host_max_rate`` is condemned and takes its remaining documents along.

Null text: no words, fails the word-count rule. Null host: such documents have no host,
so only the base rules judge them and they enter no rate. Empty table: empty result.
Repeated rows are judged each. Extra columns are ignored by ``judge`` and kept by ``apply``.

The measures travel as one narrow row per document (never the text); host totals are
combined per task before the shuffle, so a host with a third of all rows costs one partial
row per task. The host join is left to Spark's size check and skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indistar.llm.common import append_columns, materialize, neutral

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Symbols counted by ``n_symbols``.
SYMBOLS = "#*$%&|<>"
HOST_MAX_RATE = 0.5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at space and \t \n \v \f \r only, as the rule asks
    n = len(words)
    symbols = sum(map(data.count, (c.encode() for c in SYMBOLS)))
    white = len(data) - sum(map(len, words))
    word_chars = len(text) - white

    seen: set[str] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)

    repeat = 0
    if n >= WINDOW:
        # positions of each window; those found twice or more cover their words once
        first: dict[tuple, int] = {}
        starts: list[int] = []
        for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)):
            j = first.setdefault(w, i)
            if j != i:
                starts.append(i)
                starts.append(j)
        if starts:
            repeat = len({p for s in set(starts) for p in (s, s + 1, s + 2)})
    return n, word_chars, symbols, dup, repeat


def _measure_texts(texts: list) -> list[list[int]]:
    rows = [measure(t) if t else (0, 0, 0, 0, 0) for t in texts]
    return [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in MEASURES]


def measured_rows(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the measures and ``_base_failed`` added under underscored names."""
    fields = T.StructType([T.StructField(f"_{m}", T.LongType()) for m in MEASURES])
    out = append_columns(rows, text, fields, _measure_texts)
    failed = (F.col("_n_words") < MIN_WORDS) | (
        100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))
    return out.withColumn("_base_failed", failed)


def host_rates(measured: DataFrame, host: str, host_max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """Host, documents, failures, shrunk failure rate and verdict ``_host_ok``.

    The prior's mean is the pooled rate m; its strength a + b comes from the spread of the
    raw rates beyond what binomial noise explains (moments, weighted by documents). Without
    such spread the strength is ``1e6`` (every small host gets the pooled rate); with more
    spread than a beta can have it is ``1e-6``. Only the prior's one row reaches the driver.
    """
    hosts = (measured.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("_host"))
             .agg(F.count(F.lit(1)).alias("_host_docs"),
                  F.sum(F.col("_base_failed").cast("long")).alias("_host_failed")))
    n, f = F.col("_host_docs").cast("double"), F.col("_host_failed").cast("double")
    t = hosts.agg(F.sum(n).alias("n"), F.sum(n * n).alias("n2"), F.sum(f).alias("f"),
                  F.sum(f * f / n).alias("f2"), F.count(F.lit(1)).alias("k")).first()
    mean, strength = beta_prior(t["n"], t["n2"], t["f"], t["f2"], t["k"])
    rate = (f + mean * strength) / (n + strength)
    return hosts.select("_host", "_host_docs", "_host_failed", rate.alias("_host_rate"),
                        (rate <= host_max_rate).alias("_host_ok"))


def beta_prior(n: float | None, n2: float, f: float, f2: float, k: int) -> tuple[float, float]:
    """(mean, strength) from the hosts' sums of n, n^2, f, f^2/n and their number."""
    if not n:
        return 0.0, 1e6
    mean = f / n
    noise = mean * (1 - mean)
    spread = f2 - n * mean * mean  # sum of n (p - mean)^2
    between = (spread - (k - 1) * noise) / max(n - n2 / n, 1e-9)
    if k < 2 or between <= noise * 1e-6:
        return mean, 1e6
    return mean, max(noise / between - 1, 1e-6)


def _verdicts(measured: DataFrame, host: str, host_max_rate: float) -> DataFrame:
    rates = host_rates(measured, host, host_max_rate)
    kept = ~F.col("_base_failed") & F.coalesce(F.col("_host_ok"), F.lit(True))
    return measured.join(rates, F.col(host) == F.col("_host"), "left").withColumn("_kept", kept)


def judge(docs: DataFrame, host: str = "source", host_max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """Per document: doc_id, the measures, ``base_failed``, ``kept`` and the host's figures."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col(host).cast("string").alias("host"), F.col("text").cast("string").alias("text"))
    measured = materialize(measured_rows(rows).drop("text"), "measures")
    names = [*MEASURES, "base_failed", "kept", "host_docs", "host_failed", "host_rate"]
    return _verdicts(measured, "host", host_max_rate).select(
        "doc_id", *(F.col(f"_{c}").alias(c) for c in names))


def apply(docs: DataFrame, host: str = "source", host_max_rate: float = HOST_MAX_RATE) -> DataFrame:
    """The documents that pass, with all their columns.

    The rows are written once together with their measures; the second pass joins only the
    hosts' verdicts, so no text is shuffled while the host table is small enough to
    broadcast by Spark's own size check.
    """
    rows, names = neutral(docs, host)
    measured = materialize(measured_rows(rows), "measured-rows")
    return _verdicts(measured, host, host_max_rate).where("_kept").select(*rows.columns).toDF(*names)
