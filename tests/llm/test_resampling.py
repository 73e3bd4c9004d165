import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from allelespan.llm import resampling as m

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return len(w), [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, share=5, least=20):
    """id, n_features, weight, score and rank of all rows, with strings only."""
    made = [(i, *features(t)) for i, t in docs]
    bucket = lambda g: crc32(g.encode()) % 10000
    s, t = Counter(bucket(g) for _, _, gs in made for g in gs), Counter(bucket(g) for x in target for g in features(x)[1])
    up, down = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * up / ((s[k] + 1) * down)))
    rows = []
    for i, n, gs in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(g)) for g in gs)
        rows.append([i, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(eligible[: share * len(eligible) // 100]):
        r[5] = k + 1
    return sorted(repr((r[0], *r[2:])) for r in rows)


def texts(n, seed):
    rng = random.Random(seed)
    pool = ["the", "The", "cat", "42", "é", "Ünï", "日本", "a-b", "x", "don't"]
    return [rng.choice(" .\n,").join(rng.choice(pool) for _ in range(rng.choice((0, 1, 2, 5, 19, 20, 60, 300)))) for _ in range(n)]


@pytest.fixture
def tables(spark, tmp_path):
    docs = list(enumerate(texts(300, 1))) + [(1, "a b c"), (1, "a b c"), (None, "cat " * 30), (900, None), (901, ""), (902, "...")]
    target = texts(20, 2) + [None, ""]
    spark.createDataFrame([(*r, 1, "w") for r in docs], "doc_id long, text string, score int, rank string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, t, 2) for i, t in enumerate(target)], "item_id long, text string, n long").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs, target, str(tmp_path)


def test_equals_brute_force(spark, tables, monkeypatch):
    docs, target, path = tables
    want = brute(docs, target)
    assert sorted(repr(tuple(r)) for r in m.op11_importance_resampling(spark, path).collect()) == want
    assert sum(not x.endswith("None)") for x in want) > 5


@pytest.mark.parametrize("block", [1, 7, 100])
def test_cuts_lose_and_double_nothing(monkeypatch, block):
    """Blocks of any size give the same features of each row, each distinct tuple hashed once."""
    monkeypatch.setattr(m, "BLOCK", block)
    rows = texts(60, 3) + ["word " * 500, None, ""]
    for longest in (1, 2, 3, 4):
        got: Counter = Counter()
        for b in m.blocks(iter(rows), longest):
            for hashed, numbers, at in b.grams(longest, 10000):
                assert len(hashed) == 0 or set(numbers) <= set(range(len(hashed)))
                got.update(zip(at.tolist(), hashed[numbers].tolist()))
        want: Counter = Counter()
        for i, t in enumerate(rows):
            w = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
            want.update((i, crc32(" ".join(w[j : j + k]).encode()) % 10000) for k in range(1, longest + 1) for j in range(len(w) - k + 1))
        assert got == want


def test_distinct_tuples_are_hashed_once():
    block = next(m.blocks(iter(["a b a b a b c"] * 50), 3))
    assert [len(hashed) for hashed, _, _ in block.grams(3, 10000)] == [3, 3, 3]
    assert all(len(np.unique(numbers)) == len(hashed) for hashed, numbers, _ in block.grams(3, 1 << 31))


def test_ranks_over_many_parts(spark):
    """Ties go to smaller ids, null last; ranks are gapless whatever the parts."""
    rng = random.Random(4)
    rows = [(i if i % 50 else None, rng.randrange(5) * 10, rng.random() < 0.8) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, score long, ok boolean")
    got = [(r.rank, r.doc_id, r.score, r.ok) for r in m.ranked(df, df.ok, 37, "doc_id").collect()]
    want = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0] is None, r[0]))
    want = want[: 37 * len(want) // 100]
    assert [x[1:3] for x in sorted(x for x in got if x[0])] == [(i, s) for i, s, _ in want]
    assert len(got) == 400 and sorted(x[0] for x in got if x[0]) == list(range(1, len(want) + 1))


def test_empty_tables(spark, tables, tmp_path):
    docs, target, path = tables
    a, b = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "benchmark"))
    assert m.resample(a.limit(0), b).count() == 0
    got = m.resample(a, b.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(docs, [])


def test_favours_the_target(spark):
    docs = [(i, ("alpha beta gamma " if i % 2 else "delta eps zeta ") * 10) for i in range(200)]
    df, target = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("alpha beta gamma",)], "text string")
    assert {r.doc_id % 2 for r in m.resample(df, target).where("rank is not null").collect()} == {1}
