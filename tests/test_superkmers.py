"""Counts by super-k-mers against those of single k-mers."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import kmer, similarity, superkmers

TURN = str.maketrans("ACGT", "TGCA")


def plain(seqs, k):
    n = Counter()
    for s in seqs:
        s = (s or "").upper()
        for i in range(len(s) - k + 1):
            x = s[i : i + k]
            if set(x) <= set("ACGT"):
                n[max(x, x[::-1].translate(TURN))] += 1
    return n


def sequences(seed, size=60):
    rng = random.Random(seed)
    out = ["".join(rng.choice("ACGTacgtACGTN" if rng.random() < 0.3 else "ACGT") for _ in range(rng.randrange(200))) for _ in range(size)]
    return out + ["A" * 700, "ACAC" * 100, "ACGNACG" * 20, "", "AC", None, "A" * 31, "Z" * 40, "é" * 40 + "ACGT" * 10]


@pytest.mark.parametrize("k", [1, 3, 11, 12, 31, 32])
def test_counts_of_all_lengths(spark, k):
    seqs = sequences(k)
    df = spark.createDataFrame([(s,) for s in seqs], "seq string").repartition(3)
    got = superkmers.counts(df, "seq", k, cap=None).collect()
    assert {r.kmer: r.cnt for r in got} == plain(seqs, k) and len(got) == len({r.kmer for r in got})


def test_counts_by_group_saturate(spark):
    rows = [(g, s) for g in ("x", "y", None) for s in sequences(hash(g) % 7 if g else 3)] + [("x", "ACGTTGCATT" * 40)] * 5
    df = spark.createDataFrame(rows, "haplo string, seq string")
    got = {(r.haplo, r.kmer): r.cnt for r in superkmers.counts(df, "seq", 7, "haplo", cap=50).collect()}
    want = {(r.haplo, r.kmer): r.cnt for r in kmer.counts(S.kmers(df, "seq", 7, "haplo"), "haplo", cap=50).collect()}
    assert got == want and max(got.values()) == 50


def test_cut_sequences_and_summed_buckets(spark, monkeypatch):
    """Sequences far longer than a chunk, and buckets that are summed many times."""
    monkeypatch.setattr(superkmers, "CHUNK", 50)
    monkeypatch.setattr(superkmers, "PENDING", 30)
    seqs = ["".join(random.Random(5).choice("ACGT") for _ in range(3000)), *sequences(6)]
    texts = list(superkmers._texts([type("S", (), {"as_py": lambda self, s=s: s})() for s in seqs if s and len(s) >= 31], 31))
    assert all(len(t) <= 50 + 2 * 81 for t in texts)
    joined = Counter()
    for t in texts:
        base = superkmers.BASES[np.frombuffer(t, np.uint8)]
        for start, size, bucket in zip(*superkmers.runs(base, 31, 11, 64)):
            joined.update(plain([t[start : start + size + 30].decode()], 31))
            assert 0 <= bucket < 64
    assert joined == plain(seqs, 31)
    df = spark.createDataFrame([(s,) for s in seqs], "seq string")
    assert {r.kmer: r.cnt for r in superkmers.counts(df, "seq", 31, cap=None).collect()} == plain(seqs, 31)


def test_both_strands_meet_in_one_bucket():
    rng = random.Random(9)
    for _ in range(200):
        s = "".join(rng.choice("ACGT") for _ in range(31))
        a, b = (superkmers.runs(superkmers.BASES[np.frombuffer(x.encode(), np.uint8)], 31, 11, 1 << 40)[2] for x in (s, s[::-1].translate(TURN)))
        assert a.tolist() == b.tolist()


def test_runs_take_a_fraction_of_strings(spark):
    """Bytes sent, over 31 characters for each k-mer."""
    rng = random.Random(10)
    seqs = ["".join(rng.choice("ACGT") for _ in range(20_000)) for _ in range(4)]
    df = spark.createDataFrame([(s,) for s in seqs], "seq string").coalesce(1)
    sent = superkmers.parts(df, "seq", 31, buckets=128).agg(F.sum(F.length("sizes") + F.length("bases") + 16)).first()[0]
    assert sent < 31 * 4 * (20_000 - 30) / 12


@pytest.mark.parametrize("k", [3, 31, 32])
def test_listed_hits_are_those_of_single_kmers(spark, k):
    df = spark.createDataFrame([(i, f"s{i % 3}", s) for i, s in enumerate(sequences(k))], "id int, src string, seq string").repartition(3)
    every = S.kmers(df, "seq", k, "id", "src")
    listed = every.select("kmer").distinct().where("hash(kmer) % 3 = 0")
    want = every.join(listed, "kmer", "left_semi").select("id", "src", "pos", "kmer")
    got = kmer.listed_hits(df, listed, k, "id", "src")
    assert got.dtypes == want.dtypes and sorted(got.collect()) == sorted(want.collect()) and got.count() > 0
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert kmer.listed_hits(df, listed.limit(0), k, "id").count() == 0


def test_slices_have_every_kmer_once(monkeypatch):
    monkeypatch.setattr(superkmers, "CHUNK", 50)
    seqs, k, found = [s or "" for s in sequences(7)], 7, []
    for (row, at), offsets, text in superkmers._slices(pa.array(seqs), k):
        assert len(text) == offsets[-1] and len(text) < 200
        for r, (a, b) in enumerate(zip(offsets, offsets[1:])):
            found += [(row + r, i - a + (at if r == 0 else 0), text[i : i + k].decode()) for i in range(a, b - k + 1)]
    plain_ = [s.encode("ascii", "replace").decode() for s in seqs]
    assert sorted(found) == sorted((r, i, s[i : i + k]) for r, s in enumerate(plain_) for i in range(len(s) - k + 1))


def test_judged_kmers_are_those_of_joins(spark):
    rows = [(i, [None, "a", "b"][i % 3], "x" if i % 2 else "y", i % 4 == 1, s) for i, s in enumerate(sequences(5) * 2)]
    df = spark.createDataFrame(rows, "id int, haplo string, lang string, toxic boolean, seq string").repartition(3)
    k = 5
    at = S.kmers(df, "seq", k, "haplo", "lang", "toxic")
    got = superkmers.judged(df, "seq", k, "haplo", superkmers.of_one_group, "kmer string, key string, n long")
    want = kmer.group_exclusive(at, "haplo")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    got = superkmers.judged(df, "seq", k, "toxic", superkmers.of_sets, "kmer string, excluded boolean")
    want = kmer.set_filter(at.where("NOT toxic"), at.where("toxic"))
    assert sorted(got.collect()) == sorted(want.collect()) and got.where("excluded").count() > 0
    gene = df.where("lang = 'x'")
    one = lambda d: kmer.counts(S.kmers(d.where("haplo IS NOT NULL"), "seq", k, "haplo"), "haplo", cap=255)
    chosen = kmer.exclusive(one(gene), one(df))
    got = kmer.selected(gene, df, k, superkmers.combined, "kmer string, n_haplo long")
    assert sorted(got.collect()) == sorted(kmer.pan_combine(chosen).collect())
    got = kmer.selected(gene, df, k, superkmers.selected_sums, "haplo string, n_included long, n_excluded long, sum_diff long").groupBy("haplo").agg(F.sum("n_included"), F.sum("n_excluded"), F.sum("sum_diff"))
    want = chosen.groupBy("haplo").agg(F.count_if("included"), F.count_if(~F.col("included")), F.sum(F.coalesce("diff", F.lit(0))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 2


def test_patterns_stand_for_the_kmers_of_equal_owners(spark):
    """Copies, near copies, k-mers of one owner, an owner of two rows and rows without an owner: the sums over pairs are those of single k-mers."""
    rng = np.random.default_rng(5)
    new = lambda n: "".join(rng.choice(list("ACGT"), n))
    one, two = new(400), new(300)
    rows = [(1, one), (2, one), (3, one[:200] + two), (4, two + two), (4, one[100:180]), (5, new(90)), (None, one[:60]), (None, new(50)), (6, "ACG"), (7, two[:80] + "N" + two[80:]), (8, None)]
    df = spark.createDataFrame(rows, "d long, seq string")
    got = superkmers.patterns(df, "seq", 9, "d").cache()
    single = S.kmers(df, "seq", 9, "d").groupBy("d", "kmer").agg(F.count("*").alias("cnt")).cache()
    same = lambda a, b: sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))
    assert same(similarity.shared_l1(got, "d"), similarity.shared_l1(single, "d"))
    assert same(similarity.gram(got, "d"), similarity.gram(single, "d"))
    assert same(similarity.shared_above(got, "d", 60), similarity.shared_above(single, "d", 60))
    assert got.count() * 10 < single.count()
    sizes = lambda x, w: x.groupBy("d").agg(F.sum(w))
    assert same(sizes(got, F.col("cnt") * F.col("weight")), sizes(single, F.col("cnt")))
    own = lambda x: {r["i"]: pytest.approx(r["own"]) for r in similarity.self_weights(x, "d").collect()}
    assert own(got) == {r["i"]: r["own"] for r in similarity.self_weights(single, "d").collect()}


def test_near_pairs_are_those_of_all_pairs(spark):
    """Copies with changes, references, others and rows that are neither, with k-mers that all have."""
    rng = np.random.default_rng(9)
    common, rows = "".join(rng.choice(list("ACGT"), 40)), []
    for d in range(40):
        seq = np.array(list("".join(np.random.default_rng(d // 4).choice(list("ACGT"), 300)) + common))
        seq[rng.integers(0, 340, d % 4 * 2)] = "A"
        rows.append((d, "".join(seq), [True, False, False, None][d % 4] if d < 36 else d % 2 == 0))
    df = spark.createDataFrame(rows, "d long, seq string, is_ref boolean")
    counts = superkmers.patterns(df, "seq", 15, "d").cache()
    refs = df.where("is_ref IS NOT NULL").select(F.col("d").alias("name"), "is_ref")
    got = sorted(map(tuple, similarity.near(counts, "d", refs, 0.3).collect()))
    is_ref = {d: x for d, _, x in rows}
    every = similarity.distances(counts, "d").select("i", "j", "m", F.round("dist", 6)).collect()
    want = [(i, j, m, x) if is_ref[i] else (j, i, m, x) for i, j, m, x in every if x <= 0.3 and {is_ref[i], is_ref[j]} == {True, False}]
    assert got == sorted(want) and len(want) > 5


def test_matrix_of_groups_is_that_of_all_pairs(spark, sf_dir):
    from allelespan.plans import pair_queries as P

    got = P._matrix(spark, sf_dir).cache()
    group = {r["i"]: r["group_id"] for r in got.where("i = j").collect()}
    found = {(r["i"], r["j"]): r["m"] for r in got.where("i <> j").collect()}
    whole = similarity.gram(P._counts(spark, sf_dir), "doc_id").collect()
    assert found == {(r["i"], r["j"]): r["m"] for r in whole if group[r["i"]] == group[r["j"]]} and found


def test_arrays_are_cut_into_parts_without_a_seam(monkeypatch):
    """Small parts give the runs, k-mers and letters that whole arrays give; packed rows begin with a byte of their own."""
    rng = np.random.default_rng(4)
    base = rng.choice(5, 3000, p=[0.248] * 4 + [0.008]).astype(np.uint8)
    for k, m in ((31, 11), (32, 11), (5, 5), (1, 1)):
        whole = superkmers.runs(base, k, m, 64), superkmers._canonical(base & 3, k)
        with monkeypatch.context() as patch:
            patch.setattr(superkmers, "NEAR", 64)
            parts = superkmers.runs(base, k, m, 64), superkmers._canonical(base & 3, k)
            starts, size, bucket = parts[0]
            order = np.argsort(bucket, kind="stable")
            starts, size, bucket = starts[order], size[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = list(zip(superkmers._cut(size.astype(np.int32), cuts).to_pylist(), superkmers._packed(base, starts, size + k - 1, cuts).to_pylist()))
            got = superkmers._kmers(rows, k)
        assert all((a == b).all() for a, b in zip(whole[0], parts[0])) and (whole[1] == parts[1]).all()
        assert (got == whole[1][np.concatenate([np.arange(a, a + n) for a, n in zip(starts, size)])]).all()
        word = superkmers._letters(whole[1][:50], k).to_pylist()
        assert word == ["".join("ACGT"[int(x) >> 2 * i & 3] for i in range(k - 1, -1, -1)) for x in whole[1][:50]]
