"""Packing, token alignment and Merkle manifest, against brute force on small fixtures."""

import hashlib
import random
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from indistar.llm import alignment, merkle, packing, ranks, tokens
from indistar.llm.common import materialize
from indistar.llm.queries import vocabulary

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def _text(rng, n):
    return " ".join("".join(rng.choice("abcdeéßAB,.") for _ in range(rng.randint(1, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Hot source, lone sources, null fields, equal ids, repeated rows, odd white space, special strings."""
    rng = random.Random(3)
    out = [(i, "hot" if i % 3 else f"s{i % 7}", "en", 5, _text(rng, rng.randint(1, 60))) for i in range(300)]
    out += [(1000 + i, f"lone-{i}", None, None, "Lone TEXT") for i in range(20)]
    out += [(None, None, None, None, None), (None, "hot", "en", 0, ""), (7, "hot", "de", 1, "Other Text of 7"),
            (2000, "copies", "en", 3, "ABC"), (2000, "copies", "en", 3, "ABC"), (2001, "copies", "en", 3, None),
            (2002, "ünder", "fr", 9, "a  b\n\nc\t d   e"), (2003, None, "en", 1, "</s><|endoftext|> <s> x"),
            (2004, "x", "en", 1, "a ▁ b"), (2005, "x", "en", 1, "=" * 700 + "ab" * 500), (2006, "x", "en", 1, " "),
            (2007, "x", "en", 1, "中文字 日本語のテキスト 😀 ﬁ é"), (2008, "x", "en", 1, _text(rng, 6000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [F.lit(1).alias(c) for c in ("tree", "leaf", "row", "pos", "n", "seq", "_at", "_tie", "pairs", "steps")]
    return materialize(spark.createDataFrame(rows, SCHEMA).select("*", *extra), "test-docs")


def _empty(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------ op13

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def _siblings(levels, i):
    for level in levels[:-1]:
        lo = i // 16 * 16
        yield "".join(level[lo:i]), "".join(level[i + 1:lo + 16])
        i //= 16


def _merkle(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by = defaultdict(list)
    for d, s, lang, n, t in rows:
        head = _field(d) + _field(s) + _field(lang) + _field(n)
        tampered = d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and t is not None
        by[s].append((d, _h(head, _field(t)), _h(head, _field(t.translate(lower))) if tampered else None))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([x[1] for x in sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in order}
    top = _levels([trees[s][-1][0] for s in order])
    out = []
    for rank, s in enumerate(order):
        for i, (d, leaf, tampered) in enumerate(sorted(by[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            way = [*_siblings(trees[s], i), *_siblings(top, rank)]
            h = tampered or leaf
            for left, right in way:
                h = _h(left, h, right)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], _h(*(x for w in way for x in w)), h, h == top[-1][0]))
    return Counter(out)


def test_merkle_audit_matches_brute_force(docs, rows):
    got = Counter(tuple(r) for r in merkle.audit(docs).collect())
    assert got == _merkle(rows)
    verified = sum(c for r, c in got.items() if r[-1])
    assert 0 < verified < len(rows)  # untouched rows hold, changed texts do not


@pytest.mark.parametrize("keep", [lambda r: r[1] == "hot", lambda r: r[0] == 1000, lambda r: r[1] is None,
                                  lambda r: (r[1] or "").startswith("lone")])
def test_merkle_of_few_sources(spark, rows, keep):
    some = [r for r in rows if keep(r)]
    assert Counter(tuple(r) for r in merkle.audit(spark.createDataFrame(some, SCHEMA)).collect()) == _merkle(some)


def test_merkle_of_an_empty_table(spark):
    assert merkle.audit(_empty(spark)).collect() == []


def test_positions_and_sums_of_one_hot_group(spark):
    rows = materialize(spark.range(5000).select((F.col("id") % 50 == 0).cast("string").alias("g"), F.lit(1).alias("k"),
                                                (F.col("id") % 7).alias("v")), "test-hot")
    got = ranks.positions(rows, "g", ["k"]).collect()
    for g in ("true", "false"):
        mine = [r for r in got if r["g"] == g]
        assert sorted(r["pos"] for r in mine) == list(range(len(mine))) and {r["n"] for r in mine} == {len(mine)}
    sums = sorted((r["s"], r["v"]) for r in ranks.running_sum(rows, ["k"], "v", "s").collect())
    assert sums[0][0] == 0 and all(a + v == b for (a, v), (b, _) in zip(sums, sums[1:], strict=False))


# ------------------------------------------------------------------ op11

def _word_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("length,grid", [(4096, 32), (64, 2)])
def test_packing_holds_every_id_once_without_padding(docs, rows, length, grid):
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"), 2, length, grid).collect()
    want = Counter((r[0], tuple(x)) for r, x in zip(rows, _word_ids([r[4] for r in rows]), strict=True))
    # repeated ids: their rows are told apart by the number of tokens
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    got = Counter()
    for (doc, n), ps in by_doc.items():
        ps.sort(key=lambda p: p["start"])
        copies = sum(p["length"] for p in ps) // n
        ids = {}
        for p in ps:
            for k, x in enumerate(np.frombuffer(p["ids"], "<u4").tolist(), p["start"]):
                ids.setdefault(k, []).append(x)
        assert sorted(ids) == list(range(n)) and all(len(v) == copies for v in ids.values())
        got[doc, tuple(ids[k][0] for k in range(n))] += copies
    assert got == want
    for ps in by_seq.values():
        ps.sort(key=lambda p: p["offset"])
        at = 0
        for p in ps:
            assert p["offset"] == at
            at += p["length"]
        assert at <= length and at & (at - 1) == 0  # full, or a power of two
    cut = {k for k, ps in by_doc.items() if len(ps) > 1 and k[1] <= length and k[0] not in (None, 2000)}
    assert len(cut) < (0.25 if length == 4096 else 0.6) * len(by_doc)


def test_packing_of_equal_lengths_and_of_nothing(spark):
    same = spark.range(600).select(F.col("id").alias("doc_id"), F.lit("one two three four").alias("text"))
    pieces = packing.pack(same, vocabulary("word_bpe_49k.json"), 2, 64, 2).collect()
    assert sum(p["length"] for p in pieces) == 600 * 5
    fill = Counter()
    for p in pieces:
        fill[p["sequence_id"]] += p["length"]
    assert all(n & (n - 1) == 0 for n in fill.values()) and sum(n < 64 for n in fill.values()) <= 6
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(nothing, vocabulary("word_bpe_49k.json"), 2).collect() == []


def test_cutting_stock_reaches_the_known_optimum():
    # 97 rolls of 45, 610 of 36, 395 of 31 and 211 of 14 from rolls of 100: the linear program needs 452.25
    sizes, demand = np.array([14, 31, 36, 45]), np.array([211.0, 395.0, 610.0, 97.0])
    basis, rate = packing.cutting_stock(sizes, demand, 100, 1e-9)
    assert np.allclose(basis @ rate, demand) and (sizes @ basis <= 100).all()
    assert abs(rate.sum() - 452.25) < 1e-6


# ------------------------------------------------------------------ op12

def _aligned(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    ta, tb = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    ta.encode_special_tokens = True
    ba, bb = alignment.byte_level_bytes(a_path), alignment.piece_bytes(b_path)
    out = []
    for t in texts:
        t = t or ""
        a, b = ta.encode(" " + t, add_special_tokens=False).ids, tb.encode(t)
        if not t or any(b"".join(x[i] for i in ids) != (" " + t).encode() for ids, x in ((a, ba), (b, bb))):
            out.append(([], [], [], Counter()))
            continue
        ends = [set(np.cumsum([len(x[i]) for i in ids]).tolist()) for ids, x in ((a, ba), (b, bb))]
        cuts = sorted(ends[0] & ends[1])
        groups = [([], []) for _ in cuts]
        for side, (ids, x) in enumerate(((a, ba), (b, bb))):
            at = 0
            for i in ids:
                groups[bisect_right(cuts, at)][side].append(i)
                at += len(x[i])
        out.append((a, b, groups, Counter((x, y) for p, q in groups for x in p for y in q)))
    return out


@pytest.mark.parametrize("hot", [0, 40, 200_000])
def test_alignment_matches_brute_force(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(alignment.hot_threshold, "__defaults__", (hot,))
    got = Counter(tuple(r) for r in alignment.report(docs, vocabulary("byte_bpe_50k.json"),
                                                     vocabulary("piece_bpe_32k.model")).collect())
    aligned = _aligned([r[4] for r in rows])
    docs_of = Counter(p for *_, links in aligned for p in links)
    best = defaultdict(int)
    for (a, _), c in docs_of.items():
        best[a] = max(best[a], c)
    want = Counter()
    for r, (a, b, groups, links) in zip(rows, aligned, strict=True):
        shown = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        want[(r[0], len(a), len(b), len(groups), sum(links.values()),
              sum(t for p, t in links.items() if docs_of[p] == best[p[0]]), sum(t * docs_of[p] for p, t in links.items()),
              hashlib.sha256(shown.encode()).hexdigest() if a else "")] += 1
    assert got == want
    assert sum(not a for a, *_ in aligned) == 4  # two nulls, an empty text, and the one with U+2581


def test_alignment_of_an_empty_table(spark):
    assert alignment.report(_empty(spark), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")).collect() == []


def test_links_of_large_groups_and_small_parts(monkeypatch):
    rng = np.random.default_rng(1)
    a_len, b_len = rng.integers(1, 6, 400), rng.integers(1, 6, 600)
    total = min(a_len.sum(), b_len.sum())
    a_len, b_len = (np.append(x[:k], total - x[:k].sum()) for x in (a_len, b_len)
                    for k in [int(np.searchsorted(np.cumsum(x), total))])
    a, b = rng.integers(0, 9, len(a_len)), rng.integers(0, 9, len(b_len))
    ga, gb = alignment.coalesce(a_len, b_len)
    want = Counter((int(g), int(x), int(y)) for g, x in zip(ga, a, strict=True) for h, y in zip(gb, b, strict=True) if g == h)
    for large, part in ((10**6, 10**6), (6, 10**6), (10**6, 25), (6, 25)):
        monkeypatch.setattr(alignment, "LARGE_GROUP", large)
        monkeypatch.setattr(alignment, "PART_LINKS", part)
        got = Counter()
        for g, x, y, t in alignment.linked(a, b, ga, gb, int(ga[-1]) + 1):
            for i in range(len(g)):
                got[int(g[i]), int(x[i]), int(y[i])] += 1 if t is None else int(t[i])
        assert got == want


# ------------------------------------------------------------------ token ids by words

def test_memo_gives_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 60)  # it forgets again and again
    rng = random.Random(2)
    alphabet = [" ", " ", "  ", "\n", "\t", "a", "b", "The", "é", "é", "́", "中", "　", "\x1c", "!", "...",
                "'s", "'", "<|endoftext|>", "</s>", "12", "ﬁ", "Σ", "😀", "​", "\r\n", "\x85", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    plain = [x for x in alphabet if not tokens._OTHER.search(x)] + list("\"#$&()*+-/:;<=>?@[]^`{|}~sStTdDmM'")
    texts += ["".join(rng.choice(plain) for _ in range(rng.randint(1, 30))) for _ in range(6000)]
    assert sum(tokens.units(t) != tokens.bare_words(t) for t in texts) > 4000
    import sentencepiece
    from tokenizers import Tokenizer

    byte = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    byte.encode_special_tokens = True
    word = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    one = tokens.Memo(tokens.units, tokens.WordEndEncoder(vocabulary("word_bpe_49k.json")))
    two = tokens.Memo(tokens.spaced_words, tokens.json_encoder(vocabulary("byte_bpe_50k.json"), True, " "),
                      tokens.piece_encoder(vocabulary("piece_bpe_32k.model")))
    for lo, hi in tokens.groups(texts, 4000):
        part = texts[lo:hi]
        assert all(" ".join(tokens.spaced_words(t)) == t for t in part)
        made = [*one.encode(part), *two.encode(part)]
        want = [[e.ids for e in word.encode_batch(part, add_special_tokens=False)],
                [e.ids for e in byte.encode_batch([" " + t for t in part], add_special_tokens=False)], piece.encode(part)]
        for (ids, at), w in zip(made, want, strict=True):
            assert [ids[at[i]:at[i + 1]].tolist() for i in range(len(part))] == w


def test_plain_units_need_neither_the_pattern_nor_the_whole_tokenizer():
    rng = random.Random(8)
    bits = ["word", "Más", "über", "aB", "7", ".", ",", "?", "'", "'s", "..", "-", "\n", "\t", " ", "  ", "ends.", "a,b", "x7y", "\x0b\x0c\r"]
    texts = ["".join(rng.choice(bits[:k]) for _ in range(rng.randint(0, 40))) for k in (7, 8, 10, 11, 13, len(bits)) for _ in range(300)]
    assert [tokens.units(t) for t in texts] == [tokens._UNIT.findall(t.lower()) for t in texts]
    encode = tokens.WordEndEncoder(vocabulary("word_bpe_49k.json"))
    words = ["".join(rng.choice("abcdefghiklmnorstu") for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    want = encode.whole(words)
    encode.whole = lambda rest: [None] * len(rest)  # not for words of small letters
    assert encode(words) == want
