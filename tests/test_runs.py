"""Walks over columns against those base by base."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from allelespan.functions import cigar, runs


def test_gapped_rows_against_walks(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("ACGTacgt--") for _ in range(n)), "".join(rng.choice("ACGTacgt--") for _ in range(n))) for n in (0, 1, 2, 3, *[rng.randrange(4, 90) for _ in range(60)])]
    df = spark.createDataFrame(pairs, "q string, r string")
    got = df.select("q", "r", runs.from_gapped(F.col("q"), F.col("r")).alias("c"), runs.gapped_places(F.col("q")).alias("g"), runs.ungapped_places(F.col("q")).alias("u")).collect()
    for x in got:
        assert x.c == cigar.from_gapped(x.q, x.r)
        assert x.g == cigar.gapped_places(x.q) and x.u == cigar.ungapped_places(x.q)


def test_long_gapped_rows_take_no_row_of_spark_for_each_base(spark):
    """Letters of several bytes, or of two in upper case, rows without bases, nulls and a long row; no array in the plan."""
    rng = random.Random(5)
    pairs = [("", ""), ("--", "--"), ("-é", "É-"), ("ßa-é", "ßA\u0131E"), ("".join(rng.choice("ACGTa-") for _ in range(300_000)), "".join(rng.choice("ACGTa-") for _ in range(300_000))), (None, "A")]
    df = spark.createDataFrame(pairs, "q string, r string")
    made = df.select("q", "r", runs.from_gapped(F.col("q"), F.col("r")).alias("c"), runs.places_text(F.col("q"), True).alias("g"), runs.places_text(F.col("q"), False).alias("u"))
    assert "arrays_zip" not in made._jdf.queryExecution().toString()
    for x in made.collect():
        if x.q is None:
            assert (x.c, x.g, x.u) == (None, None, None)
        else:
            assert x.c == cigar.from_gapped(x.q, x.r)
            assert x.g == ",".join(map(str, cigar.gapped_places(x.q))) and x.u == ",".join(map(str, cigar.ungapped_places(x.q)))


def test_extended_against_walks(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(60):
        ops = [(rng.randrange(1, 12), rng.choice("MMM=XIDHS")) for _ in range(rng.randrange(0, 12))]
        r, q = (sum(n for n, op in ops if op in x) for x in ("M=XI", "M=XD"))
        rows.append(("".join(f"{n}{op}" for n, op in ops), "".join(rng.choice("ACGTac") for _ in range(r)), "".join(rng.choice("ACGTac") for _ in range(q))))
    df = spark.createDataFrame(rows, "c string, r string, q string")
    for x in df.withColumn("e", runs.extended(F.col("c"), F.col("r"), F.col("q"))).collect():
        assert x.e == cigar.extended(x.c, x.r, x.q)


def best_score(q, r):
    """Of all alignments, by a table over three states."""
    low = -(10**9)
    best = [[[low] * 3 for _ in range(len(r) + 1)] for _ in range(len(q) + 1)]
    best[0][0][0] = 0
    for i in range(len(q) + 1):
        for j in range(len(r) + 1):
            if i and j:
                best[i][j][0] = max(best[i - 1][j - 1]) + (5 if q[i - 1] == r[j - 1] else -4)
            if i:
                best[i][j][1] = max(best[i - 1][j][s] - (4 if s == 1 else 16) for s in range(3))
            if j:
                best[i][j][2] = max(best[i][j - 1][s] - (4 if s == 2 else 16) for s in range(3))
    return max(best[-1][-1])


def score(a, b):
    total, state = 0, 0
    for x, y in zip(a, b):
        now = 1 if y == "-" else 2 if x == "-" else 0
        total += (5 if x == y else -4) if now == 0 else -4 if now == state else -16
        state = now
    return total


@pytest.mark.parametrize("table", [1, 12, 40, 1 << 22])
def test_alignment_is_the_best_by_a_full_table(monkeypatch, table):
    """Whatever is cut: gaps over cuts, at both ends, and empty sequences."""
    monkeypatch.setattr(cigar, "TABLE", table)
    rng = random.Random(3)
    for _ in range(150):
        q = "".join(rng.choice("ACG") for _ in range(rng.randrange(0, 16)))
        r = "".join(rng.choice("ACG") for _ in range(rng.randrange(0, 16))) if rng.random() < 0.5 else q[: rng.randrange(len(q) + 1)] + q[rng.randrange(len(q) + 1) :]
        a, b = cigar.align(q, r)
        assert a.replace("-", "") == q and b.replace("-", "") == r and len(a) == len(b)
        assert score(a, b) == best_score(q, r), (q, r)


def test_long_alignments_take_little_memory():
    """Ten thousand bases: a whole table would take 100 MB."""
    rng = random.Random(4)
    q = "".join(rng.choice("ACGT") for _ in range(10_000))
    r = q[:3000] + q[3400:7000] + "".join(rng.choice("ACGT") for _ in range(250)) + q[7000:]
    tracemalloc.start()
    a, b = cigar.align(q, r)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 25e6 and a.replace("-", "") == q and b.replace("-", "") == r
    assert score(a, b) >= 5 * 9600 - 16 - 4 * 399 - 16 - 4 * 249
