"""Edge cases of the training-data operators, against brute force on small fixtures."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from indistar.llm import (
    chat_format,
    chunk_dedup,
    common,
    components,
    decontamination,
    html_extract,
    jaccard_join,
    mixing,
    quality_rules,
    sharding,
    suffix_dedup,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    """Originals, exact and edited copies, shared passages, nulls, blanks, one long text, repeated rows."""
    rng = random.Random(5)
    base = [_words(rng, 120) for _ in range(6)]
    passage = _words(rng, 90)
    edited = base[0].split()
    edited[60] = "changed"
    rows = [(i, t, "a") for i, t in enumerate(base)]
    rows += [(10, base[0], "a"), (11, " ".join(edited), "b"), (12, base[0].upper(), "b"), (13, None, "b"), (14, "", None),
             (15, " \t\n", "b"), (16, "few words", "c"), (17, "few  words", "c"), (18, _words(rng, 60) + " " + passage, "c"),
             (19, passage + " " + _words(rng, 60), "c"), (20, base[1] + " " + base[1], "c"), (21, _words(rng, 8000), "c"),
             (22, "é€𝄞 " * 200, "c"), (None, base[2], "c"), (None, "lone text", None), (5, base[5], "a"),
             (23, "x" * 3000, "d"), (24, "x" * 900, "d")]
    return rows


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard_components_match_brute_force(spark, texts):
    got = jaccard_join.components(_docs(spark, texts).withColumn("node", F.lit("clash"))).collect()
    sets = [_shingles(t) for _, t, _ in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    want = []
    for k, (i, _, _) in enumerate(texts):
        ids = [texts[m][0] for m in range(len(texts)) if group[m] == group[k] and texts[m][0] is not None]
        want.append((i, len(sets[k]), min(ids) if sets[k] and ids else i))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_jaccard_keeps_one_of_each_group_and_takes_an_empty_table(spark, texts):
    docs = _docs(spark, texts)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    gone = {10, 11, 12, 17, 20}
    want = {i for i, _, _ in texts if i is not None} - gone
    assert [i for null, i in ids if not null] == sorted(want)
    assert sum(null for null, _ in ids) == 1  # the lone text; the copy of base[2] has an id
    assert jaccard_join.components(docs.limit(0)).count() == 0


def test_jaccard_stages_hold_one_python_step(spark, texts, monkeypatch):
    """Two Python steps in a stage are two workers per core, and hashing all texts again is most of the join's time."""
    steps, write = {}, jaccard_join.materialize

    def written(df, name):
        steps.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
        return write(df, name)

    monkeypatch.setattr(jaccard_join, "materialize", written)
    kept = jaccard_join.keep_one(_docs(spark, texts))
    assert kept._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 0
    assert max(n for each in steps.values() for n in each) == 1
    assert steps["sketch"] and steps["set"] and steps["wanted-texts"]


def test_jaccard_keeps_one_of_repeated_rows_with_unlike_texts(spark):
    """Rows of one id (or none) whose texts differ in white space or case only are one document."""
    rows = [(1, "a b c d e f", "x"), (1, "A b  c d e f", "y"), (1, "a b c d e f", "z"), (2, "a b c d e  f", "x"),
            (None, "q r s t u v", "x"), (None, "q r s  t u v", "y"), (3, "lone text of some more words", "x"), (4, "", "x"), (4, None, "x")]
    kept = [(r.doc_id, (r.text or "").lower().split()) for r in jaccard_join.keep_one(_docs(spark, rows)).collect()]
    want = [(1, "a b c d e f"), (None, "q r s t u v"), (3, "lone text of some more words")]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(kept, key=key) == sorted([(i, t.split()) for i, t in want] + [(4, []), (4, [])], key=key)


def test_jaccard_schemes_find_every_linked_pair():
    """Random pairs at and above the bound share the promised number of buckets in a common scheme."""
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 5, 8, 13, 21, 40, 97, 250, 700):
        for _ in range(30):
            x = np.unique(rng.integers(1, 1 << 62, size, dtype=np.uint64))
            most = int(len(x) / 9) * 2
            drop = int(rng.integers(0, most // 2 + 1))
            y = np.unique(np.concatenate([x[drop:], rng.integers(1, 1 << 62, drop, dtype=np.uint64)]))
            inter = len(np.intersect1d(x, y))
            if 100 * inter < 80 * len(np.union1d(x, y)):
                continue
            small, large = sorted((x, y), key=len)
            band = jaccard_join.band_of(len(small))
            assert jaccard_join.band_of(len(large)) in (band, band + 1)
            a, b = (set(jaccard_join._signatures(s, band).tolist()) for s in (small, large))
            assert len(a & b) >= jaccard_join.allocation(band)[2]


def test_tile_pairs_split_over_blocks_lose_nothing(spark, monkeypatch):
    rng = random.Random(2)
    base = _words(rng, 100).split()
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(6):
            t[rng.randrange(100)] = f"w{rng.random()}"
        rows.append((i, " ".join(t), "a"))
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    got = {r.doc_id: r.component_id for r in jaccard_join.components(_docs(spark, rows)).collect()}
    sets = [_shingles(t) for _, t, _ in rows]
    group = list(range(60))
    for a in range(60):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    assert got == dict(enumerate(group))


def test_components_of_chains_and_odd_edges(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3), (101, 100)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _windows_removed(texts, width=400):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for s in range(len(b) - width + 1):
            seen[b[s:s + width]] = seen.get(b[s:s + width], 0) + 1
    out = []
    for b in data:
        cover = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if seen[b[s:s + width]] > 1:
                cover[s:s + width] = b"\1" * width
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((len(b), sum(cover), sum(c and (i == 0 or not cover[i - 1]) for i, c in enumerate(cover)),
                    hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("largest", [4096, 2])
def test_suffix_dedup_matches_brute_force(spark, texts, monkeypatch, largest):
    """With tiny collections every group is halved down to single windows."""
    monkeypatch.setattr(suffix_dedup, "LARGEST", largest)
    rng = random.Random(9)
    shared = _words(rng, 150)
    rows = texts + [(100 + i, _words(rng, 20 + i) + shared[i:] + _words(rng, 30), "z") for i in range(12)]
    got = suffix_dedup.report(_docs(spark, rows)).collect()
    assert all(r.n_repeated == r.n_removed for r in got)
    got = [tuple(r)[:-1] for r in got]
    want = [(r[0], *w) for r, w in zip(rows, _windows_removed([t for _, t, _ in rows]), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_suffix_dedup_of_texts_longer_than_a_piece(spark):
    """Repeats that lie across the ends of pieces, at other places in other texts."""
    rng = random.Random(8)
    n, shared = suffix_dedup.PIECE, _words(rng, 200)
    long = _words(rng, 40_000)[:n + 9_000]
    cut_in = long[:n - 350] + shared + long[n - 350:]
    rows = [(1, cut_in, "a"), (2, _words(rng, 60) + cut_in[n - 700:n + 900] + _words(rng, 60), "a"),
            (3, _words(rng, 300), "a"), (4, cut_in[n - 50:n + 349], "a"), (5, "é" * 250 + shared, "a"), (6, "é" * 250, "a")]
    got = suffix_dedup.report(_docs(spark, rows)).orderBy("doc_id").collect()
    assert [tuple(r)[1:-1] for r in got] == _windows_removed([t for _, t, _ in rows])


def test_suffix_order_of_a_collection():
    rng = random.Random(3)
    strings = [np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 12))]) for _ in range(25)]
    owner, length, shared = suffix_dedup.insert_columns(strings)
    rows = [list(strings[o][len(strings[o]) - n:]) for o, n in zip(owner, length, strict=True)]
    assert len(rows) == sum(len(s) + 1 for s in strings) and rows == sorted(rows)
    for i in range(1, len(rows)):
        n = 0
        while n < min(len(rows[i]), len(rows[i - 1])) and rows[i][n] == rows[i - 1][n]:
            n += 1
        assert shared[i] == n


def test_suffix_and_chunk_dedup_on_an_empty_table(spark, texts):
    docs = _docs(spark, texts).limit(0)
    assert suffix_dedup.report(docs).count() == 0 and chunk_dedup.report(docs).count() == 0


def test_chunks_cover_texts_and_resist_insertions():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 5000, dtype=np.uint8)
    ends = chunk_dedup.chunk_ends(data)
    sizes = np.diff(np.concatenate([[0], ends]))
    assert ends[-1] == len(data) and sizes.max() <= chunk_dedup.MAX_CHUNK
    moved = np.concatenate([data[:1000], rng.integers(97, 123, 7, dtype=np.uint8), data[1000:]])
    cut = lambda d: {d[a:b].tobytes() for a, b in zip(
        [0, *chunk_dedup.chunk_ends(d)[:-1]], chunk_dedup.chunk_ends(d), strict=True)}
    assert len(cut(data) - cut(moved)) <= 12


def test_chunk_dedup_keeps_the_first_copy(spark, texts):
    got = {}
    for r in chunk_dedup.report(_docs(spark, texts).withColumn("spans", F.lit(1))).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[0][0].n_removed == 0 and got[0][0].n_repeated > 500
    assert got[10][0].n_removed == got[10][0].n_bytes
    assert got[19][0].n_removed > 300 and got[18][0].n_removed == 0
    assert got[3][0].n_removed == 0 and got[13][0].n_bytes == 0
    assert sorted(r.n_removed > 0 for r in got[5]) == [False, True]  # a repeated row
    kept = {r.doc_id: r.text for r in chunk_dedup.remove(_docs(spark, texts)).collect()}
    assert kept[0] == texts[0][1] and kept[10] == ""


def test_chunk_dedup_removes_short_copies_and_shared_passages(spark):
    rng = random.Random(21)
    short = [_words(rng, 1 + i % 15)[:90] for i in range(40)] + ["x", "é"]
    rows = [(i, t, "a") for i, t in enumerate(short)] + [(100 + i, t, "b") for i, t in enumerate(short)]
    passages = [_words(rng, 51) for _ in range(300)]
    rows += [(1000 + i, _words(rng, 30) + " " + p + " " + _words(rng, 30), "c") for i, p in enumerate(passages)]
    rows += [(2000 + i, _words(rng, 30) + " " + p + " " + _words(rng, 30), "d") for i, p in enumerate(passages)]
    got = {r.doc_id: r for r in chunk_dedup.report(_docs(spark, rows)).collect()}
    for i in range(len(short)):
        assert got[100 + i].n_removed == got[100 + i].n_bytes > 0 == got[i].n_removed and got[i].n_repeated == got[i].n_bytes
    assert all(got[1000 + i].n_removed == 0 for i in range(len(passages)))
    text = {i: x.encode() for i, x, _ in rows}

    def chunks(data):
        ends = [0, *chunk_dedup.chunk_ends(np.frombuffer(data, np.uint8)).tolist()]
        return [data[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]

    for i in range(len(passages)):  # runs of chunks that the first copy has too, of 32 bytes or more
        seen, run, want = set(chunks(text[1000 + i])), 0, 0
        for c in [*chunks(text[2000 + i]), None]:
            if c in seen:
                run += len(c)
                continue
            want, run = want + (run if run >= 32 else 0), 0
        assert got[2000 + i].n_removed == want
    kept = {r.doc_id: r.text for r in chunk_dedup.remove(_docs(spark, rows)).collect()}
    assert all(kept[i] == t and kept[100 + i] == "" for i, t in enumerate(short))


def test_quality_rules(spark, texts):
    docs = _docs(spark, texts).withColumn("kept", F.lit("clash")).withColumn("host", F.lit("clash"))
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(texts)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[13].n_words == 0 and by[13].base_failed and not by[14].kept and by[0].kept
    assert by[20].n_repeat_words == 240 and by[20].base_failed
    assert quality_rules.measure("a b c\na b c\n\n\nx # é") == (9, 9, 1, 1, 6)
    assert quality_rules.measure("a a a a") == (4, 4, 0, 0, 4)
    kept = quality_rules.apply(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {r.doc_id for r in got if r.kept}
    assert quality_rules.judge(docs.limit(0)).count() == 0 and quality_rules.apply(docs.limit(0)).count() == 0


def test_hosts_are_condemned_by_shrunk_rates(spark):
    good, bad = "w " * 3 + " ".join(f"v{i}" for i in range(60)), "short"
    rows = [(i, good if i % 10 else bad, f"h{i % 5}") for i in range(500)]
    rows += [(1000 + i, bad if i % 20 else good, "spam") for i in range(200)]
    rows += [(2000, good, "one-good"), (2001, bad, "one-bad"), (2002, good, None)]
    by = {r.doc_id: r for r in quality_rules.judge(_docs(spark, rows)).collect()}
    assert not by[1020].base_failed and not by[1020].kept  # a good page of a bad host
    assert by[1].kept and by[2000].kept and by[2002].kept
    assert by[2001].host_rate < 1.0  # shrunk
    assert quality_rules.beta_prior(None, 0, 0, 0, 0) == (0.0, 1e6)


def test_decontamination_catches_edits_and_leaves_the_rest(spark, texts):
    rng = random.Random(8)
    item = _words(rng, 40)
    edited = item.split()
    for k in (5, 14, 23, 33):
        edited[k] = "other"
    rows = texts + [(300, _words(rng, 50) + " " + item + " " + _words(rng, 50), "q"),
                    (301, _words(rng, 30) + ". " + " ".join(edited).title() + "! " + _words(rng, 9), "q"), (302, item, "q"),
                    (303, " ".join(item.split()[:8]) + " " + _words(rng, 80), "q")]
    bench = spark.createDataFrame([(1, item), (2, _words(rng, 30)), (3, None), (4, ""), (None, "qqq zzz")], "item_id long, text string")
    docs = _docs(spark, rows).withColumn("score", F.lit("clash"))
    got = {(r.doc_id, r.item_id): r for r in decontamination.find(docs, bench).collect()}
    assert set(got) == {(300, 1), (301, 1), (302, 1)}
    assert (got[300, 1].first_word, got[300, 1].end_word, got[300, 1].score) == (50, 90, 1.0)
    assert got[301, 1].score < 1
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    assert decontamination.find(docs, bench.limit(0)).count() == 0
    assert decontamination.find(docs.limit(0), bench).count() == 0
    assert decontamination.clean(docs, bench.limit(0)).count() == len(rows)


def test_alignment_against_a_plain_table():
    rng = random.Random(6)
    for _ in range(20):
        a = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 20))])
        b = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 20))])
        h = np.zeros((len(b) + 1, len(a) + 1), dtype=int)
        for i in range(1, len(b) + 1):
            for j in range(1, len(a) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[j - 1] == b[i - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontamination.align(a, b)[0] == h.max()


def _align_score(a, b):
    h = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i, y in enumerate(b, 1):
        for j, x in enumerate(a, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_decontamination_matches_alignment_of_all_pairs(spark):
    """Copies with 10 to 30% of their words edited, with and without an exact copy beside them."""
    rng = random.Random(11)
    stock = _words(rng, 400).split()
    items = [[rng.choice(stock) for _ in range(40 + i)] for i in range(12)]
    docs = [(500 + i, " ".join(t)) for i, t in enumerate(items[:6])]
    for k, share in enumerate((0.1, 0.15, 0.2, 0.25, 0.3)):
        for i, t in enumerate(items):
            edited = list(t)
            if i % 3 == 2:  # spread at random, else at even spacing
                at = rng.sample(range(len(t)), int(share * len(t)))
            else:
                at = [int((j + 0.5) / share) for j in range(int(share * len(t)))]
            for j in at:
                edited[j] = "edited%d" % j if i % 2 else "two more edited%d" % j
            around = [rng.choice(stock) for _ in range(20)]
            docs.append((100 * k + i, " ".join(around[:10] + edited + around[10:])))
    split = list(items[0])
    split[20:20] = ["put"] * 14  # one insertion longer than a few words
    docs.append((900, " ".join(split)))
    want = {}
    for d, text in docs:
        w = decontamination.words(text)
        grams = {tuple(w[j:j + 3]) for j in range(len(w) - 2)}
        for i, t in enumerate(items):
            score = _align_score(w, t)
            shared = len({tuple(t[j:j + 3]) for j in range(len(t) - 2)} & grams)
            if score >= decontamination.MIN_SCORE * 2 * len(t) and shared >= 2:
                want[d, i] = (round(score / (2 * len(t)), 9), shared)
    assert len(want) >= 50
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = decontamination.find(table, bench).collect()
    assert {(r.doc_id, r.item_id): (round(r.score, 9), r.n_seeds) for r in got} == want
    assert {r.doc_id for r in decontamination.clean(table, bench).collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_mixing_meets_targets_natively(spark, texts):
    rng = random.Random(1)
    rows = [(i, _words(rng, 80) + (" idiot scum" if i % 5 == 0 else "") + (" ###$$$" * 30 if i % 4 == 1 else ""), "s") for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 1), int(i % 5 == 0)) for i in range(0, 400, 2)] + [(1, 0, 0), (5, 0, 1), (9, None, None),
                                   (13, 0, 0), (17, 0, 0), (21, 0, 0), (29, 0, 0), (33, 0, 0), (37, 0, 0)], "doc_id long, quality int, toxic int")
    docs = _docs(spark, rows + [(900, None, None), (901, "", None), (0, rows[0][1], "s")])
    want = {"high": 0.7, "low": 0.2, "toxic": 0.1}
    mixer = mixing.Mixer(docs, labels, want)
    plan = mixer.rates()._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    r = mixer.rates().toPandas()
    assert len(r) == docs.count() and (r.rate >= 0).all()
    for d, share in want.items():
        assert abs((r.n_tokens * r.rate * r[f"p_{d}"]).sum() / r.n_tokens.sum() - share) < 2e-3
    again = mixer.resample(docs)
    assert again.columns == docs.columns and 0.5 < again.count() / len(r) < 2
    bare = mixing.Mixer(docs.limit(0), labels.limit(0))
    assert bare.rates().count() == 0


def test_mixing_has_fixed_targets_and_tells_when_they_are_missed(spark, recwarn):
    rng = random.Random(3)
    rows = [(i, _words(rng, 60) + (" idiot scum" * 3 if i % 3 == 0 else "") + (" ###$$$" * 30 if i % 3 == 1 else ""), "s")
            for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 1), int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    mixer = mixing.Mixer(_docs(spark, rows), labels)  # a third of each domain goes in
    assert mixer.targets == {"high": 0.80, "low": 0.12, "toxic": 0.08} and mixing.ITERATIONS == 60
    assert not [w for w in recwarn if "mixing targets" in str(w.message)]
    r = mixer.rates().toPandas()
    for d, share in mixer.targets.items():
        left = (r.n_tokens * r.rate * r[f"p_{d}"]).sum() / r.n_tokens.sum() - share
        assert abs(left) <= mixing.TOLERANCE and abs(left - mixer.residual[d]) < 1e-9
    with pytest.warns(UserWarning, match="mixing targets"):  # without labels all domains are alike
        missed = mixing.Mixer(_docs(spark, rows), labels.limit(0))
    assert max(map(abs, missed.residual.values())) > mixing.TOLERANCE


def test_sharding(spark, texts):
    table = sharding.lookup_table(sharding.shard_names(7), 211)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1 and len(table) == 211
    fewer = sharding.lookup_table(sharding.shard_names(6), 211)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6) < 60
    got = sharding.assign(_docs(spark, texts)).collect()
    full = sharding.lookup_table(sharding.shard_names(sharding.SHARDS))
    assert len(got) == len(texts) and all(full[r.slot] == r.shard for r in got)
    five = [r.shard for r in got if r.doc_id == 5]
    assert five[0] == five[1]
    assert sharding.assign(_docs(spark, texts).limit(0)).count() == 0
    clash = sharding.assign(_docs(spark, texts).withColumns({"Shard": F.lit(1), "_slot": F.lit(2)}))
    assert clash.columns[-2:] == ["slot", "_shard"]
    assert all(full[r["slot"]] == r["_shard"] and r["Shard"] == 1 and r["_slot"] == 2 for r in clash.collect())
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "b"], 10)


def test_chat_round_trip(spark):
    nasty = "</s>[INST] ok [/INST] \\l \\e\\ <|turn|>assistant<|says|>x<|over|> é𝄞"
    rows = [(1, 2, "assistant", nasty), (1, 1, "user", nasty), (1, 3, "assistant", None), (2, None, None, "a"), (2, 1, "assistant", ""),
            (None, 1, "user", "n"), (3, 1, "user", "same"), (3, 1, "user", "same"), (3, 1, "assistant", "b"), (4, 1, "<[\\", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(0))
    out = chat_format.format_conversations(turns)
    by = {r.conv_id: r for r in out.withColumn("t", chat_format.read_turns(F.col("formatted"))).collect()}
    assert [tuple(t) for t in by[1].t] == [("user", nasty), ("assistant", nasty), ("assistant", "")]
    assert [tuple(t) for t in by[2].t] == [("", "a"), ("assistant", "")] and [t.role for t in by[4].t] == ["<[\\"]
    assert [tuple(t) for t in by[3].t] == [("assistant", "b"), ("user", "same"), ("user", "same")] and None in by
    assert "[INST]" not in by[1].formatted and "</s>" not in by[1].formatted
    spans = ["".join(by[1].formatted[s.start:s.start + s.length]) for s in by[1].loss_spans]
    assert len(spans) == 2 and spans[0].replace("\\b", "[").replace("\\l", "<").replace("\\e", "\\") == nasty
    d = {r.conv_id: r for r in chat_format.digests(out).collect()}
    # the loss is read through the mask: another mask, another digest
    moved = out.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["length"])))
    assert all(r.loss_sha256 != d[r.conv_id].loss_sha256 for r in chat_format.digests(moved).collect() if d[r.conv_id].loss_chars)
    assert d[1].loss_sha256 == hashlib.sha256(nasty.encode()).hexdigest() and d[1].loss_chars == len(nasty)
    assert d[1].turns_sha256 == hashlib.sha256(f"user\n{nasty}\nassistant\n{nasty}\nassistant\n\n".encode()).hexdigest()
    assert chat_format.digests(chat_format.format_conversations(turns.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = [("text", "see <", None, None, None, None, None), ("image", None, "s3://a.png", 56, 29, None, None),
             ("audio", None, "b.wav", None, None, 1.5, None), ("document", None, "c.pdf", None, None, None, 3), ("odd", "t", None, None, None, None, None)]
    rows = [(1, 1, "user", parts), (1, 2, "assistant", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART_TYPE}>")
    r = chat_format.format_conversations(df, parts="parts").first()
    assert "see \\l<|image:1|><|audio:2|><|document:3|>t" in r.formatted
    assert [(a.turn, a.type, a.uri, a.tokens) for a in r.attachments] == [
        (0, "image", "s3://a.png", 4), (0, "audio", "b.wav", 38), (0, "document", "c.pdf", 768)]
    assert r.expanded_tokens == 810


def test_segments_are_linear_in_the_hits():
    import time

    rng = random.Random(4)
    for every, weight in ((10, 3.0), (3, 2.0), (1, 0.5)):  # far apart, now and then merging, all merging
        hits = [(i * every, rng.uniform(0.5, 1.5) * weight) for i in range(200_000)]
        t = time.process_time()
        assert toxicity.segments(hits, -0.7)
        assert time.process_time() - t < 5


def test_segments_match_brute_force():
    """Every maximal-scoring segment, against the definition by recursion on the best segment."""
    rng = random.Random(12)

    def brute(scores, at=0):
        best = None
        for a in range(len(scores)):
            for b in range(a + 1, len(scores) + 1):
                s = sum(scores[a:b])
                if s > 1e-9 and (best is None or s > best[0] + 1e-9):
                    best = (s, a, b)
        if best is None:
            return []
        s, a, b = best
        return brute(scores[:a], at) + [(round(s, 6), at + a, at + b)] + brute(scores[b:], at + b)

    for _ in range(200):
        n = rng.randint(1, 14)
        hits = [(i, rng.choice([1.13, 2.29, 0.71, 3.37])) for i in range(n) if rng.random() < 0.4]
        scores = [-0.7] * n
        for i, w in hits:
            scores[i] = w + rng.random() * 1e-3
        hits = [(i, scores[i]) for i, _ in hits]
        assert [(round(s, 6), a, b) for s, a, b in toxicity.segments(hits, -0.7)] == brute(scores)


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    bad = ["venom", "slime", "grime", "filth"]
    rows, labels = [], []
    for i in range(1500):
        w = _words(rng, 60).split()
        if i % 6 == 0:
            for _ in range(4):
                w[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(w), "s"))
        labels.append((i, 1, int(i % 6 == 0)))
    docs = _docs(spark, rows + [(5000, None, None), (5001, "", None), (None, "venom " * 5, None)]).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [r for i, r in got.items() if i is not None and i < 1500 and r.held_out]
    assert 300 < len(held) < 700 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    right = sum(r.predicted == int(r.doc_id % 6 == 0) for r in held)
    assert right / len(held) > 0.97 and got[5000].predicted == 0 and not got[None].held_out and got[None].predicted == 1
    spans = toxicity.passages(docs, model).where("doc_id is null").collect()
    assert [(s.first_word, s.end_word) for s in spans] == [(0, 5)]
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


@pytest.fixture(scope="module")
def chain():
    return html_extract.fit()


def test_html_held_out_pages(chain):
    pages = list(html_extract.labelled_pages(120, seed=99))
    right = sum(chain.decode(b) == y for b, y in pages)
    assert right / len(pages) > 0.85


def test_html_cases(spark, chain):
    page = ("<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><header>Site<nav><ul><li><a href=/>Home</a></li></ul></nav>"
            "</header><div class=ad>Buy now.</div><article><h1>Big  title</h1><p>One &amp; two,&nbsp;three.<br>Four <b>five<p>Six &lt;b&gt;"
            " <script>x('</p>')</script>seven.<!-- c --></article><aside class=sidebar><p>Other things.</p></aside>"
            "<form><label>Mail</label><button>Go</button></form><section id=comments><p>I like it.</p></section><footer>&copy; us</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (1, "u", page), (4, "w", page[:page.index("seven")] + "<a hre"), (5, "x", "plain < text")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = [tuple(r) for r in html_extract.extract(df, chain).collect()]
    want = "Big title\nOne & two, three. Four five\nSix <b> seven."
    assert got[0] == got[3] == (1, "u", want, len(want)) and got[1] == (2, None, "", 0) and got[2] == (3, "v", "", 0)
    assert got[4][2] == want[:-len(" seven.")]
    assert html_extract.extract(df.limit(0), chain).count() == 0


def test_viterbi_is_the_best_path(chain):
    blocks = list(html_extract.labelled_pages(3, seed=5))[0][0][:8]
    f = html_extract.features(blocks)
    e = [sum(chain.weights.get(x, 0.0) for x in row) for row in f]

    def value(path):
        v = path[0] * (chain.start + e[0])
        for i in range(1, len(path)):
            v += chain.change[path[i - 1], path[i]] + path[i] * e[i]
        return v
    paths = [[(k >> i) & 1 for i in range(len(blocks))] for k in range(1 << len(blocks))]
    assert chain.decode(blocks) == max(paths, key=value)


def test_word_hashes_split_like_bytes_and_ignore_ascii_case():
    texts = [b"", b" a\tB\x0bc ", "É é x".encode(), b"word" * 400000, b"Tail"]
    got = [h[a:b] for h, at in common.word_hashes(texts) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(g) for g in got] == [len(t.split()) for t in texts]
    low = [h[a:b] for h, at in common.word_hashes([t.lower() for t in texts]) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert all((a == b).all() for a, b in zip(got, low, strict=True)) and got[2][0] != got[2][1]
