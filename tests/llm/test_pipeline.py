"""The pipeline's run() on a small corpus, stage by stage against plain Python, with clashing extra columns."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from indistar.llm import decontamination, mixing, quality_rules, sharding
from indistar.llm.common import materialize

CLASHING = ("_n_words", "_host", "_id", "_copied", "_text", "_row", "_spans", "_p0", "_tokens", "_copies", "slot", "Shard",
            "_slot", "node", "component", "_kept", "host")


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Kept texts, exact and edited copies, leaked benchmark items, short texts, a bad host, nulls."""
    rng = random.Random(11)
    base = [_words(rng, 150) for _ in range(30)]
    for i in range(30):  # domains that a classifier can tell apart
        w = base[i].split()
        w[::6] = [rng.choice(["vile", "nasty", "hateful"]) if i % 5 == 4 else str(rng.randint(100, 999)) if i % 3 == 1 else x
                  for x in w[::6]]
        base[i] = " ".join(w)
    items = [_words(rng, 25) for _ in range(4)]
    edited = base[1].split()
    edited[75] = "changed"
    rows = [(i, t, "good") for i, t in enumerate(base)]
    rows += [(100, base[0], "good"), (101, " ".join(edited), "other"), (102, base[2].upper(), "good"), (3, base[3], "good")]
    rows += [(200 + i, base[10 + i] + " " + x + " " + _words(rng, 80), "good") for i, x in enumerate(items)]
    rows += [(300 + i, "too short", "bad") for i in range(20)] + [(320, _words(rng, 150), "bad")]
    rows += [(400, None, "good"), (401, "", None), (None, _words(rng, 150), None)]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHING)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 3 != 1), int(i % 5 == 4)) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, items


@pytest.fixture(scope="module")
def stages(spark, corpus):
    path = corpus[0]
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path), f"test-{name}")
        out.append(docs)
    return out


def _shingles(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_stages_match_plain_python(spark, corpus, stages):
    path, rows, items = corpus
    names = spark.read.parquet(f"{path}/documents.parquet").columns
    kept = [[(r["doc_id"], r["text"]) for r in s.select("doc_id", "text").collect()] for s in stages]
    assert all(s.columns == names for s in stages[:4])

    # quality: short texts go, and the one long text of a host on which nearly all fail
    want = [(i, t) for i, t, s in rows if len((t or "").split()) >= 50 and s != "bad"]
    assert Counter(kept[0]) == Counter(want)
    # near duplicates: the smallest id of every group of linked texts
    sets = [(i, t, _shingles(t)) for i, t in want]
    alone = []
    for i, t, x in sorted(sets, key=lambda r: (r[0] is None, r[0] or 0)):
        if not any(100 * len(x & y) >= 80 * len(x | y) for _, _, y in alone):
            alone.append((i, t, x))
    assert Counter(kept[1]) == Counter((i, t) for i, t, _ in alone)
    # decontamination: texts that hold an item go
    clean = [(i, t) for i, t, _ in alone if not any(x in t for x in items)]
    assert Counter(kept[2]) == Counter(clean) and len(clean) == len(alone) - len(items)
    # mixing: as often as the rate says, give or take the fraction's draw
    docs = spark.createDataFrame([(i, t) for i, t in clean], "doc_id long, text string")
    rates = {r["doc_id"]: r["rate"] for r in mixing.Mixer(docs, spark.read.parquet(f"{path}/labels.parquet")).rates().collect()}
    times = Counter(i for i, _ in kept[3])
    assert all(int(rates[i]) <= times[i] <= int(rates[i]) + 1 for i, _ in clean) and set(kept[3]) <= set(clean)
    # sharding: every row that mixing gave, in the shard of its slot
    table = sharding.lookup_table(sharding.shard_names(sharding.SHARDS))
    last = stages[4].collect()
    added = stages[4].columns[len(names):]
    assert Counter((r["doc_id"], r["text"]) for r in last) == Counter(kept[3])
    assert all(table[r[added[0]]] == r[added[1]] for r in last)


def test_run_gives_the_last_stage(spark, corpus, stages):
    got, want = corpus_pipeline.run(spark, corpus[0]), stages[-1]
    key = lambda rows: Counter(tuple(r) for r in rows)
    assert key(got.collect()) == key(want.collect()) and got.count() > 0


def test_empty_tables(spark, corpus, tmp_path):
    path, *_ = corpus
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_extra_columns_come_back(spark, corpus):
    path, *_ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    bench = spark.read.parquet(f"{path}/benchmark.parquet")
    for out in (quality_rules.apply(docs), decontamination.clean(docs, bench)):
        assert out.columns == docs.columns
        assert all(r[c] == f"extra {c}" for r in out.limit(5).collect() for c in CLASHING)
