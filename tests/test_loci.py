"""Allele loci against a sweep over events, one contig after another."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from allelespan.operators import interval, kmer, scan
from allelespan.plans import pipelines

KIND = "contig string, start long, end long, strand string, gene string, is_exon boolean"


def swept(aligned, anchor, apart, same_gene, margin, least, keep_cores=False):
    """contig, start, end, strand and genes of the loci: a sweep that keeps the active exons and the open genes."""
    contigs = defaultdict(list)
    for r in aligned:
        contigs[r[0]].append(r)
    loci = []
    for contig, rows in contigs.items():
        rows.sort(key=lambda r: (r[1], r[2]))
        groups, reach = [], None
        for r in rows:
            if reach is None or r[1] - reach > 2 * anchor:
                groups.append([])
            groups[-1].append(r)
            reach = max(reach or 0, r[2])
        for group in groups:
            exons = [r for r in group if r[5]]
            last, active, ended, middles = {}, 0, None, []
            for r in exons:
                g = r[4].split("_")[-1]
                last[g] = max(last.get(g, 0), r[2])
            paused = {}
            for at, is_end, g in sorted((x, e, r[4].split("_")[-1]) for r in exons for e, x in enumerate(r[1:3])):
                if not is_end:
                    if active == 0 and ended is not None and at - ended > apart and all(at - x > same_gene for x in paused.values()):
                        middles.append((at + ended) // 2)
                    active += 1
                else:
                    active -= 1
                    ended = at
                    paused[g] = at
                    if at >= last[g]:
                        del paused[g]
            part = lambda x: sum(m < x for m in middles)
            for k in range(len(middles) + 1):
                own = [r for r in group if k in (part(r[1]), part(r[2]))]
                if not own:
                    continue
                low, high = middles[k - 1] if k else 0, middles[k] if k < len(middles) else float("inf")
                start, end = max(low, min(r[1] for r in own)), min(high, max(r[2] for r in own))
                inner = [x for r in own if r[5] for x in r[1:3]]
                if inner:
                    start = max(0, min(inner) - margin // 2) if min(inner) < start + margin // 2 else start
                    end = max(inner) + margin // 2 if max(inner) > end - margin // 2 else end
                elif end - start <= least:
                    continue
                size = {s: sum(r[2] - r[1] for r in own if r[3] == s) for s in "+-"}
                loci.append([contig, start, end, "-" if size["-"] > size["+"] else "+", sorted({r[4] for r in own if not r[5]}) or ["ENSE"]])
    loci.sort()
    cores = [(x[1], x[2]) for x in loci]
    for x in loci:
        more = max(0, 5 * anchor - (x[2] - x[1]))
        x[1], x[2] = max(0, x[1] - more // 2), x[2] + more // 2
    grown = [(x[1], x[2]) for x in loci]
    for i in range(1, len(loci)):
        a, b = loci[i - 1], loci[i]
        if a[0] == b[0] and grown[i][0] < grown[i - 1][1]:
            inner = cores if keep_cores else grown
            a[2] = b[1] = min(max((grown[i][0] + grown[i - 1][1]) // 2, inner[i - 1][1]), inner[i][0])
    return sorted((c, s, max(s, e), st, g) for c, s, e, st, g in loci)


def alignments(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        start = rng.randrange(60_000)
        exon = rng.random() < 0.25
        rows.append((rng.choice("AAAB"), start, start + rng.choice((3, 20, 90, 700)), rng.choice("+-"), f"ENSE{rng.randrange(9)}_G{rng.randrange(4)}" if exon else f"G{rng.randrange(4)}", exon))
    return rows + rows[:5]


@pytest.mark.parametrize("keep_cores", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_loci_against_a_sweep(spark, seed, keep_cores):
    rows = alignments(seed)
    contigs = spark.createDataFrame([("A", "ACGTN" * 13_000), ("B", "TTGCA" * 13_000)], "contig string, seq string")
    got = pipelines.allele_loci(spark.createDataFrame(rows, KIND), contigs, 75, 500, 900, 100, 30, keep_cores).collect()
    want = swept(rows, 75, 500, 900, 100, 30, keep_cores)
    assert sorted((r.contig, r.start, r.end, r.strand, r.genes) for r in got) == want and len(want) > 40
    assert all(len(r.seq) == r.end - r.start for r in got if r.end <= 65_000) and len({r.name for r in got}) == len(got)


def test_borders_open_genes_and_places(spark):
    """A gene that pauses forbids borders while it may go on; a border belongs to what stands before it."""
    rows = [("l", 0, 100, "A"), ("l", 30_000, 30_100, "B"), ("l", 41_000, 41_100, "B"), ("l", 60_200, 60_300, "C"), ("l", 75_000, 75_100, "C")]
    df = spark.createDataFrame([("c", 0, a, b, g, True) for _, a, b, g in rows], "contig string, locus long, start long, end long, gene string, is_exon boolean")
    assert sorted(r["at"] for r in interval.exon_borders(df).collect()) == [15_050, 50_650]
    df = df.union(spark.createDataFrame([("c", 0, 15_050, 50_700, "x", False), ("d", 7, 1, 2, "x", False)], df.schema))
    parts = {(r.start, r.low, r.high) for r in interval.split_overmerged(df).collect()}
    assert parts == {(0, None, 15_050), (15_050, None, 15_050), (15_050, 50_650, None), (30_000, 15_050, 50_650), (41_000, 15_050, 50_650), (60_200, 50_650, None), (75_000, 50_650, None), (1, None, None)}


def test_running_max_over_parts(spark):
    """One group holds nearly all rows; parts are many, and equal rows stand in several."""
    rng = random.Random(5)
    rows = [("hot" if i % 10 else rng.choice("abc"), rng.randrange(60), rng.choice((None, rng.randrange(1000)))) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, x int, v int")
    parts = scan.dealt(df, ["g"], ["x"])
    assert parts.select("_part").distinct().count() > 4
    got = scan.running_max(parts, ["g"], ["x"], {"m": F.col("v"), "k": -F.col("v")}).orderBy("_part", "g", "x", "_row").collect()
    assert len(got) == 2000
    held = {}
    for r in got:
        a, b = held.get(r.g, (None, None))
        assert (r.m, r.k) == (a, b)
        if r.v is not None:
            held[r.g] = (r.v if a is None else max(a, r.v), -r.v if b is None else max(b, -r.v))


def test_hotspots_of_one_hot_contig(spark):
    """Numbers over parts, and runs in which the hit c before is near, against a list of hits; nearly all stand on one contig."""
    rng = random.Random(6)
    hits = [(rng.choice("tu") if i % 20 == 0 else "t", "hot" if i % 20 else rng.choice("ab"), rng.randrange(20_000)) for i in range(3000)]
    df = spark.createDataFrame(hits, "target string, contig string, pos long")
    parts = scan.dealt(df, ["target", "contig"], ["pos"])
    numbers = sorted((r.target, r.contig, r.n) for r in scan.numbered(parts, ["target", "contig"], ["pos"], "n").collect())
    want, runs = defaultdict(list), []
    for t, c, p in hits:
        want[t, c].append(p)
    assert numbers == sorted((*k, i + 1) for k, v in want.items() for i in range(len(v)))
    for k, v in want.items():
        v.sort()
        last = None
        for a, b in zip(v, v[5:]):
            if b - a < 40:
                if last is not None and a - last[3] < 40:
                    last[2], last[3] = min(last[2], a), b
                else:
                    last = [*k, a, b]
                    runs.append(last)
    got = kmer.hotspots(df, 5, 40).select("target", "contig", "start", "end").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, runs)) and len(runs) > 20


def test_empty_loci(spark):
    none = spark.createDataFrame([], KIND)
    assert pipelines.allele_loci(none, spark.createDataFrame([], "contig string, seq string")).count() == 0
