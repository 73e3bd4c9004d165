import random
import re

import numpy as np
import pytest
import xxhash

from allelespan.llm import simhash


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, most=3):
    root = list(range(len(fps)))
    a = np.array(fps, dtype=np.uint64)
    for i, j in zip(*np.nonzero(np.bitwise_count(a[:, None] ^ a[None]) <= most)):
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        root[max(i, j)] = min(i, j)
    out = []
    for i in range(len(fps)):
        while root[i] != i:
            i = root[i]
        out.append(i)
    return out


def test_against_brute_force(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    fps = [fingerprint(t) for _, t in docs]
    want = sorted((d, f"{f:016x}", docs[r][0]) for (d, _), f, r in zip(docs, fps, roots(fps)))
    assert sorted(tuple(r) for r in simhash.op6_simhash(spark, sf_dir).collect()) == want


def test_groups_follow_the_number_of_fingerprints():
    for most in (3, 7):
        found = [simhash.groups_for(4**k, most) for k in range(1, 18)]
        assert found[0] == most + 2 and found == sorted(found) and simhash.comb(found[-1], most) <= 6 * simhash.comb(most + 2, most)


@pytest.mark.parametrize("groups", [5, 6, 7, 8])
def test_links_do_not_depend_on_groups(spark, groups):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in base for _ in range(6)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    by = {r.node % (1 << 64): r.root for r in simhash.components(simhash.links(df, groups=groups)).collect()}
    want = roots(fps)
    assert len({by.get(x, ("alone", x)) for x in fps}) == len(set(want))
    assert all((by.get(x, x) == by.get(y, y)) == (a == b) for x, a in zip(fps, want) for y, b in zip(fps[:40], want))


@pytest.mark.parametrize("block", [8, 4096])
def test_dense_cells(spark, block):
    rng = random.Random(block)
    centre = [rng.getrandbits(64) for _ in range(3)]
    fps = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for c in centre for _ in range(120)})
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    got = simhash.components(simhash.links(df, block=block))
    by = {r.node % (1 << 64): r.root for r in got.collect()}
    found, want = {}, {}
    for x, r in zip(fps, roots(fps)):
        want.setdefault(r, []).append(x)
        found.setdefault(by.get(x, ("alone", x)), []).append(x)
    assert sorted(found.values()) == sorted(want.values())


def test_edges(spark):
    long = "word%d " * 50_000 % tuple(range(50_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b"), (6, "a b"), (None, "a b"), (7, long), (8, long + "x"), (None, "zz yy")]
    df = spark.createDataFrame([(*r, 5, "c") for r in rows], "doc_id long, text string, fp int, component_id string")
    got = simhash.near_duplicates(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows) and {by[i][0].component_id for i in (1, 2, 3)} == {1} and by[1][0].fp == 0
    assert by[5][0].component_id == 4 and [r.component_id for r in by[6]] == [6, 6] and by[8][0].component_id == 7
    assert sorted(r.component_id for r in by[None] if r.component_id) == [6]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def runs_of(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def alike(a, b):
    x, y = runs_of(a), runs_of(b)
    return not x and not y or len(x & y) / len(x | y) >= 0.8


def kept(rows, most=7):
    """rows: (doc_id, text, row). Rows that stay, one by one: equal texts first, then the groups of fingerprints."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    first = {}
    for r in rows:
        first.setdefault(r[1] or "", r)
    distinct = list(first.values())
    groups = {}
    for r, root in zip(distinct, roots([fingerprint(r[1]) for r in distinct], most)):
        groups.setdefault(root, []).append(r)
    stay = []
    for own in groups.values():
        here = []
        for r in own:
            if not any(alike(r[1], x[1]) for x in here):
                here.append(r)
        stay += here
    return sorted(r[2] for r in stay)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
    return " ".join(words)


@pytest.mark.parametrize("leaders", [2, 16])
def test_kept_against_brute_force(spark, leaders, monkeypatch):
    """Texts with few and many changes, copies, other case, without words; groups of more rows than are compared at once."""
    monkeypatch.setattr(simhash, "LEADERS", leaders)
    rng = random.Random(4)
    texts = [None, "", " \t", "one", "One", "a b", "a b c d", "a b c d e"]
    for k in range(12):
        words = [f"w{k}x{rng.randrange(300)}" for _ in range(rng.randrange(30, 150))]
        texts += [" ".join(words), " ".join(words).upper(), " ".join(words)] + [edited(rng, words, rng.randrange(1, 9)) for _ in range(rng.randrange(14))]
    rows = [(rng.choice([None, *range(60)]), t, i) for i, t in enumerate(rng.sample(texts, len(texts)))]
    df = simhash.staged(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n long, fp string"), "t")
    assert sorted(r.n for r in simhash.kept(df, "n").collect()) == kept(rows)
    assert simhash.kept(df.limit(0), "n").count() == 0


def test_a_group_of_texts_that_are_not_alike(spark, monkeypatch):
    """One group by fingerprints, in which only some are similar: nothing goes without a similar row that stays."""
    monkeypatch.setattr(simhash, "LEADERS", 3)
    monkeypatch.setattr(simhash, "DEALT", 7)
    line = "the same line again and again in all of these "
    rows = [(i, line * 60 + " ".join(f"own{i // 2}n{k}" for k in range(25 + i % 2)), i) for i in range(30)]
    df = simhash.staged(spark.createDataFrame(rows, "doc_id long, text string, n long"), "t")
    got = sorted(r.n for r in simhash.kept(df, "n").collect())
    assert got == kept(rows) and 10 < len(got) < 30


def test_stage_keeps_one_of_each(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "other words here now"), (None, "a b c d"), (None, "so it is alone")]
    df = spark.createDataFrame([(*r, "s", 7) for r in rows], "doc_id long, text string, source string, _row int")
    got = simhash.stage_near_dedup(spark, df, "")
    assert got.columns == df.columns and sorted(r.text for r in got.collect()) == ["a b c d", "other words here now", "so it is alone"]
    assert got.where("text = 'a b c d'").first().doc_id == 1 and {r._row for r in got.collect()} == {7}
