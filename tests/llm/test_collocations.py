import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from allelespan.llm import collocations as m


def ngrams(docs, longest=5):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return n, f


def brute(docs, least, best=2000, subsumes=100):
    n, f = ngrams(docs)
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= subsumes * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def texts(size, seed):
    rng = random.Random(seed)
    pool = ["the", "The", "big", "cat", "é", "Ünï", "a-b", "\x00", " x", "don't", "日本", "z"]
    fixed = ["in the big cat house", "new york city", "a b a b a b"]
    docs = []
    for _ in range(size):
        words = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(pool) for _ in range(rng.choice((0, 1, 5, 40)))]
        docs.append((rng.choice(["en", "en", "de", None, ""]), "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", "; ", " ", " "]) for w in words)))
    return docs + [("en", None), (None, None), ("fr", "")]


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, "x") for d in docs], "lang string, text string, n long, phrase string")


def got(df):
    return sorted(map(tuple, df.collect()))


def test_equals_brute_force(spark):
    docs = texts(300, 1)
    want = brute(docs, 10)
    assert got(m.collocations(frame(spark, docs), least=10)) == want and len(want) > 30


@pytest.mark.parametrize("subsumes", [50, 90])
def test_partial_subsumption_and_few_best(spark, subsumes):
    docs = texts(200, 2)
    assert got(m.collocations(frame(spark, docs), least=8, best=7, subsumes=subsumes)) == brute(docs, 8, 7, subsumes)


def test_blocks_parts_and_full_sketches_change_nothing(spark, monkeypatch):
    """Texts cut anywhere, many partial sketches, and a sketch with so few cells that nearly all survive."""
    docs = texts(120, 3) + [("en", "in the big cat house " * 300)]
    want = brute(docs, 10)
    monkeypatch.setattr(m, "BLOCK", 30)
    monkeypatch.setattr(m, "GATHER", 500)
    monkeypatch.setattr(m, "HELD", 50)
    monkeypatch.setattr(m, "IN_BUCKET", 1000)
    df = frame(spark, docs)
    rows = df.where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").repartition(3)
    counts = m.survivors(rows, np.full((2 << 16) // 8, 255, np.uint8), 16)  # all bits set: all n-grams are counted
    n, f = ngrams(docs)
    exact = {(lang, len(p), " ".join(p)): a for lang, c in f.items() for p, a in c.items()}
    assert {(r.lang, r["size"], r.phrase): r.a for r in counts.where("size > 0").collect()} == exact
    assert {r.lang: r.a for r in counts.where("size = 0").collect()} == {k: v for k, v in n.items() if v}
    assert got(m.collocations(df.repartition(4), least=10)) == want


def test_sketch_never_undercounts_and_drops_most(spark):
    docs = texts(400, 4)
    rng = random.Random(5)
    docs += [("en", " ".join(f"w{rng.randrange(10**6)}" for _ in range(2000))) for _ in range(10)]
    rows = frame(spark, docs).where("text is not null").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    met = {(r.lang, r.phrase): r.a for r in m.survivors(rows, m.sketch(rows, 18, 30), 18).where("size > 0").collect()}
    _, f = ngrams(docs)
    exact = {(lang, " ".join(p)): a for lang, c in f.items() for p, a in c.items()}
    assert all(exact[k] == a for k, a in met.items())
    assert all(k in met for k, a in exact.items() if a >= 30)
    assert len(met) < len(exact) / 20


def test_packed_blocks_come_back():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 65536):
        offsets = np.sort(rng.choice(65536, n, replace=False)).astype(np.int64)
        counts = rng.integers(1, 2**31, n)
        a, b = m._unpacked(m._packed(offsets, counts), n)
        assert (a == offsets).all() and (b == counts).all()


def test_products_past_64_bits(spark):
    rows = [("en", 0, None, 9 * 10**15), ("en", 1, "a", 8 * 10**15), ("en", 1, "b", 7 * 10**15), ("en", 2, "a b", 6 * 10**15 + 1)]
    r = m.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, a long")).first()
    assert r.score == 1000 * (6 * 10**15 + 1) * 9 * 10**15 // (8 * 10**15 * 7 * 10**15)


def test_empty(spark):
    assert m.collocations(frame(spark, [("en", "a")]).limit(0)).count() == 0
    assert m.collocations(frame(spark, [("en", None), (None, "..."), ("en", "a b c")])).count() == 0
