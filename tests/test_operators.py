import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import annotate, blocks, cluster, graph, interval, kmer, similarity

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_saturating_counts(spark):
    df = spark.createDataFrame([("A",)] * 300 + [("C",)], "kmer string")
    assert rows(kmer.counts(df)) == [("A", 255), ("C", 1)]
    assert rows(kmer.ref_band(spark.createDataFrame([("a", 0), ("b", 1), ("c", 254), ("d", 255)], "kmer string, cnt int"))) == [("b", 1), ("c", 254)]


def test_exclusive_and_combined(spark):
    gene = spark.createDataFrame([("h", "A", 2), ("h", "B", 1), ("x", "A", 1)], "haplo string, kmer string, cnt int")
    whole = spark.createDataFrame([("h", "A", 2), ("h", "B", 3), ("h", "C", 1)], "haplo string, kmer string, cnt int")
    got = kmer.exclusive(gene, whole)
    assert rows(got.select("kmer", "included", "diff")) == [("A", True, None), ("B", False, 2), ("C", False, 1)]
    assert rows(kmer.pan_combine(got).select("kmer")) == [("A",)]


def test_set_filter_and_dual(spark):
    a, b = (spark.createDataFrame([(x,) for x in s], "kmer string") for s in ("AABC", "BD"))
    assert rows(kmer.set_filter(a, b)) == [("A", False), ("B", True), ("C", False)]
    c = spark.createDataFrame([("A", 300), ("B", 2)], "kmer string, cnt long")
    assert rows(kmer.dual_counts(c, spark.createDataFrame([("B", 70000)], "kmer string, cnt long"))) == [("B", 2, 65535)]


def test_probes_come_before_counts(spark):
    """Of the corpus only target k-mers are shuffled."""
    corpus = spark.createDataFrame([("h", x) for x in "AAABBCDDDD"], "haplo string, kmer string")
    found = spark.createDataFrame([("t", "A"), ("u", "A"), ("t", "Z")], "target string, kmer string")
    got = kmer.target_counts(corpus, found, "target", "haplo", small=True)
    assert rows(got) == rows(kmer.target_counts(corpus, found, "target", "haplo")) == [("h", "t", "A", 3), ("h", "u", "A", 3)]
    counted = spark.createDataFrame([("A", 2), ("B", 300), ("Z", 1)], "kmer string, cnt long")
    dual = kmer.dual_counts_of(counted, corpus.select("kmer"))
    assert rows(dual) == rows(kmer.dual_counts(counted, kmer.counts(corpus, cap=None))) == [("A", 2, 3), ("Z", 1, 0)]
    for df in (got, dual):  # the probe stands below the aggregate, so below its exchange
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("LeftSemi") > plan.index("Aggregate")


def test_exclusive_in_one_row(spark):
    counted = spark.createDataFrame([("h", "A", 2, 2), ("h", "B", 1, 3), ("h", "C", 0, 1), ("h", "D", 300, 300), ("x", "A", 0, 4)], "haplo string, kmer string, g long, w long")
    gene, whole = (counted.where(f"{c} > 0").select("haplo", "kmer", F.least(F.col(c), F.lit(255)).alias("cnt")) for c in "gw")
    assert rows(kmer.exclusive_within(counted)) == rows(kmer.exclusive(gene, whole))


def test_hotspots(spark):
    hits = spark.createDataFrame([("t", "c", p) for p in (100, 200, 300, 400, 2000)], "target string, contig string, pos int")
    assert rows(kmer.hotspots(hits, 3)) == [("t", "c", 100, 400)]


@SLOW
@given(st.lists(st.integers(0, 6000), min_size=1, max_size=60, unique=True), st.integers(1, 5))
def test_hotspots_against_ring_buffer(spark, places, c):
    ring, found = [], []
    for p in sorted(places):
        if len(ring) >= c and p - ring[-c] < 1000:
            if found and ring[-c] - found[-1][1] < 1000:
                found[-1][1] = p
            else:
                found.append([ring[-c], p])
        ring.append(p)
    hits = spark.createDataFrame([("t", "c", p) for p in places], "target string, contig string, pos int")
    assert [list(r[2:]) for r in rows(kmer.hotspots(hits, c))] == found


def test_end_trim(spark):
    hits = spark.createDataFrame([("s", i, h) for i, h in enumerate([False, False, True, True, True])], "name string, pos int, is_hit boolean")
    assert rows(kmer.end_trim(hits, 2)) == [("s", 1, 4)]
    assert rows(kmer.end_trim(hits, 9)) == [("s", None, None)]


@SLOW
@given(st.lists(st.booleans(), min_size=1, max_size=40), st.integers(1, 4))
def test_end_trim_against_walk(spark, marks, cutoff):
    def walk(order):
        score, start = 0, order[0]
        for i in order:
            score += 9 if marks[i] else -1
            if score < 0:
                score, start = 0, i
            if score >= 9 * cutoff:
                return start
        return None

    hits = spark.createDataFrame([("s", i, h) for i, h in enumerate(marks)], "name string, pos int, is_hit boolean")
    n = list(range(len(marks)))
    assert rows(kmer.end_trim(hits, cutoff)) == [("s", walk(n), walk(n[::-1]))]


def test_end_trim_of_sequences(spark):
    """The same ends from sequences as from a row for each k-mer, with other letters in between."""
    rng = random.Random(6)
    made = []
    for i in range(60):
        s = "".join(rng.choice(["ACGGT", "TTTGA", "CCATG", "acggt", "N", "AAAAA"]) for _ in range(rng.randrange(25)))
        made.append((f"s{i}", s))
    seqs = spark.createDataFrame(made, "name string, seq string")
    listed = spark.createDataFrame([(x,) for x in ("ACCGT", "TCAAA", "CCATG", "TTTTT")], "kmer string")
    marks = S.kmers(seqs, "seq", 5, "name").join(listed.withColumn("h", F.lit(True)), "kmer", "left").select("name", "pos", F.col("h").isNotNull().alias("is_hit"))
    for cutoff in (1, 2, 3):
        want = rows(kmer.end_trim(marks, cutoff))
        assert rows(kmer.end_trim_of(seqs, listed, cutoff, 5)) == want and any(r[1] is not None for r in want) and any(r[1] is None for r in want)


def test_mask(spark):
    seqs = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "AcGT")], "name string, seq string")
    hits = spark.createDataFrame([("a", 1), ("a", 3)], "name string, pos int")
    assert rows(kmer.unmask(seqs, kmer.masked_runs(hits, 3))) == [("a", "acgTAcgtac"), ("b", "acgt")]


def test_merge_and_gaps(spark):
    df = spark.createDataFrame([("c", 100, 200), ("c", 20200, 20300), ("c", 40301, 40400)], "chrom string, start long, end long")
    assert rows(interval.merge(df, ["chrom"])) == [("c", 0, 30300, 2), ("c", 30301, 50400, 1)]
    sizes = spark.createDataFrame([("c", 41000)], "chrom string, size long")
    assert rows(interval.gaps(df, ["chrom"], 30, sizes)) == [("c", 0, 100), ("c", 200, 20200), ("c", 20300, 40301), ("c", 40400, 41000)]


@SLOW
@given(st.lists(st.tuples(st.integers(0, 90), st.integers(0, 30)), min_size=1, max_size=25), st.lists(st.tuples(st.integers(0, 90), st.integers(0, 30)), min_size=1, max_size=25), st.booleans())
def test_overlap_join_against_all_pairs(spark, a, b, strict):
    x = spark.createDataFrame([("c", i, s, s + n) for i, (s, n) in enumerate(a)], "chrom string, id int, start int, end int")
    y = spark.createDataFrame([("c", i, s, s + n) for i, (s, n) in enumerate(b)], "chrom string, id2 int, start2 int, end2 int")
    want = sorted((i, j) for i, (s, n) in enumerate(a) for j, (t, m) in enumerate(b) if (s < t + m and t < s + n if strict else s <= t + m and t <= s + n))
    assert rows(interval.overlap_join(x, y, "chrom", 7, strict).select("id", "id2")) == want


def test_error_regions_and_lift(spark):
    loci = spark.createDataFrame([(1, "c", 10, 20)], "id int, chrom string, start int, end int")
    for start, left in ((20, 0), (21, 1)):
        err = spark.createDataFrame([("c", start, start + 9)], "chrom string, start2 int, end2 int")
        assert interval.without_errors(loci, err).count() == left
    found = spark.createDataFrame([("c", 20, 30, "a"), ("c", 15, 30, "z"), ("c", 5, 30, "m")], "chrom string, start2 int, end2 int, ref string")
    assert interval.first_overlap(loci, found, "ref").first().ref == "m"


def test_edges(spark):
    loci = spark.createDataFrame([("r", "chr1", 50, 60, True), ("a", "x", 24, 80, False), ("b", "x", 25, 75, False), ("d", "u", 30, 40, False)], "name string, contig string, start long, end long, ref boolean")
    sizes = spark.createDataFrame([("chr1", 110), ("x", 100)], "contig string, size long")
    assert rows(interval.edge_filter(loci, sizes, F.col("ref")).select("name")) == [("b",), ("d",), ("r",)]


@SLOW
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 40), st.integers(0, 5)), min_size=1, max_size=12))
def test_envelope_against_places(spark, spans):
    df = spark.createDataFrame([("c", i, s, s + n, k) for i, (s, n, k) in enumerate(spans)], "chrom string, id int, start int, end int, score int")
    best = [min(((-k, i) for i, (s, n, k) in enumerate(spans) if s <= p < s + n), default=(0, None))[1] for p in range(101)]
    want, start = [], 0
    for p in range(1, 102):
        if p == 101 or best[p] != best[start]:
            if best[start] is not None:
                want.append((best[start], start, p))
            start = p
    assert rows(interval.envelope(df, "chrom", 16, 0).select("id", "start", "end")) == sorted(want)


def test_small_interval_rules(spark):
    df = spark.createDataFrame([("g", "c", 1, 5, "+", "x"), ("g", "c", 3, 9, "+", "x"), ("g", "d", 1, 2, "-", "x")], "name string, chrom string, start int, end int, strand string, gene string")
    assert rows(interval.collapse(df).select("name", "start", "end")) == [("g", 1, 9), ("g002", 1, 2)]
    vote = spark.createDataFrame([(0, 50, "+"), (10, 60, "-")], "start int, end int, strand string")
    assert vote.agg(interval.strand_vote()).first()[0] == "+"
    start, end = interval.extend_to(15_000)
    assert rows(spark.createDataFrame([(10, 1010)], "start int, end int").select(start, end)) == [(0, 8010)]
    breaks = spark.createDataFrame([("s", p) for p in (10, 10, 20, 69, 119, 300)], "seg string, pos int")
    assert rows(interval.break_clusters(breaks, "seg")) == [("s", 10, 4), ("s", 119, 1), ("s", 300, 1)]
    walk = spark.createDataFrame([("c", 1, 0, 100), ("c", 2, 80, 200), ("c", 3, 190, 300)], "contig string, id int, start int, end int")
    assert rows(interval.resolve_overlaps(walk).select("id", "start", "end")) == [(1, 0, 80), (2, 80, 190), (3, 190, 300)]
    far = spark.createDataFrame([("c", 1, 0, 15_000), ("c", 2, 10_000, 25_000), ("d", 3, 5, 9)], "contig string, id int, start long, end long")
    assert rows(interval.resolve_overlaps(far).select("id", "start", "end")) == [(1, 0, 10_000), (2, 10_000, 25_000), (3, 5, 9)]
    grown = spark.createDataFrame([("c", 1, 2750, 17_750, 10_000, 10_500), ("c", 2, 9750, 24_750, 17_000, 17_500), ("c", 3, 18_000, 19_000, 18_000, 19_000)], "contig string, id int, start long, end long, a long, b long")
    assert rows(interval.resolve_overlaps(grown, core=("a", "b"), order=("a", "b")).select("id", "start", "end")) == [(1, 2750, 13_750), (2, 13_750, 18_000), (3, 18_000, 19_000)]


def test_pairs(spark):
    counts = spark.createDataFrame([(1, "A", 2), (2, "A", 3), (2, "B", 1), (3, "C", 4)], "s long, kmer string, cnt long")
    assert rows(similarity.shared_l1(counts, "s")) == [(1, 2, 2)]
    assert rows(similarity.gram(counts, "s")) == [(1, 2, 6)]
    assert rows(similarity.self_weights(counts, "s")) == [(1, 4.0), (2, 9.05), (3, 0.8)]


@pytest.mark.parametrize("common", [0, 3, 12, 40])
def test_pairs_above_a_threshold(spark, common):
    """The pairs of shared_l1 above it, ties and hot k-mers included; pairs that share only frequent k-mers are not met."""
    rng = random.Random(6)
    counts = [(i, f"hot{x}", rng.randrange(1, 4)) for i in range(60) for x in range(rng.randrange(6))]
    counts += [(i, f"g{i // 5}x{x}", rng.randrange(1, 4)) for i in range(60) for x in range(12) if rng.random() < 0.8]
    counts += [(i, f"own{i}", 50) for i in range(60)] + [(i, f"g0x{x}", 2) for i in (70, 71) for x in range(30)]
    df = spark.createDataFrame(sorted(set((a, b) for a, b, _ in counts)), "s long, kmer string").join(spark.createDataFrame(counts, "s long, kmer string, cnt long").groupBy("s", "kmer").agg(F.sum("cnt").alias("cnt")), ["s", "kmer"])
    whole = similarity.shared_l1(df, "s")
    want = rows(whole.where(F.col("shared") > common))
    assert rows(similarity.shared_above(df, "s", common)) == want and want
    met = similarity.candidates(df, "s", common).count()
    assert len(want) <= met <= whole.count()
    if common >= 12:
        assert met < whole.count() / 4


def test_links_give_the_groups_of_all_pairs(spark):
    """Sparse groups, in which the smallest name reaches few others at once, and a group of near copies, which takes no more than two rows for each of them."""
    rng = random.Random(3)
    ids = rng.sample(range(1000), 180)
    found = {(ids[i], f"g{i // 15}x{x}"): rng.randrange(1, 4) for i in range(120) for x in range(40) if rng.random() < (0.25 if i % 3 else 0.6)}
    found |= {(i, f"near{x}"): 1 for i in ids[120:] for x in range(60) if rng.random() < 0.95}
    found |= {(ids[i], f"both{i % 7}x{x}"): 2 for i in range(0, 180, 9) for x in range(6)}
    counts = spark.createDataFrame([(a, b, n, 1 + len(b) % 2) for (a, b), n in found.items()], "s long, kmer string, cnt long, weight long")
    names = spark.createDataFrame([(x,) for x in range(1000)], "name long")
    whole = similarity.shared_l1(counts, "s").cache()
    common = 22
    pairs = whole.where(F.col("shared") > common)
    links = similarity.linked(counts, "s", common)
    want = rows(cluster.groups(names, pairs, common))
    assert rows(cluster.groups(names, links, common)) == want
    assert links.count() <= 3 * len(ids) < pairs.count() / 3
    first = similarity.first_links(counts, "s", common)
    single = rows(cluster.single_pass(names, pairs, common))
    assert rows(cluster.single_pass(names, first, common)) == single != want
    assert set(rows(first)) <= set(rows(pairs)) and first.count() < pairs.count() / 3
    steps = [(0, common), (3, 30)]
    assert rows(cluster.regrouped_counts(names, counts, "s", steps)) == rows(cluster.regrouped(names, whole, steps)) != want


def test_hot_kmers_are_paired_in_blocks(spark):
    counts = spark.createDataFrame([(i, "HOT", i % 3 + 1) for i in range(40)] + [(1, "B", 2), (30, "B", 5)], "s long, kmer string, cnt long")
    want = {(i, j): min(i % 3, j % 3) + 1 + 2 * ((i, j) == (1, 30)) for i in range(40) for j in range(i + 1, 40)}
    got = similarity._pairs(counts, "s", 7).groupBy("i", "j").agg(F.sum(F.least("ci", "cj")).alias("n"), F.count("*").alias("c")).collect()
    assert {(r.i, r.j): r.n for r in got} == want and sum(r.c for r in got) == len(want) + 1


def test_partition(spark):
    names = spark.createDataFrame([(x,) for x in (2, 3, 4, 7, 9)], "name long")
    shared = spark.createDataFrame([(2, 7, 501), (3, 4, 600), (4, 7, 501), (7, 9, 500)], "i long, j long, shared long")
    assert rows(cluster.groups(names, shared)) == [(2, 2), (3, 2), (4, 2), (7, 2), (9, 9)]
    again = cluster.regrouped(names, shared.withColumn("shared", F.col("shared") * 2), [(0, 900), (3, 1100)])
    assert rows(again) == [(2, 2), (3, 3), (4, 3), (7, 7), (9, 9)]


@SLOW
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=14))
def test_components_against_union_find(spark, edges):
    root = list(range(13))
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(tuple(r) for r in cluster.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root[x] for e in edges if e[0] != e[1] for x in e}


def test_single_pass_against_the_matrix(spark):
    """All cells of the upper triangle in order; components that one pass leaves in pieces are among them."""
    rng = random.Random(8)
    size, common = 60, 5
    m = {(i, j): rng.randrange(4, 9) for i in range(size) for j in range(i + 1, size) if rng.random() < 0.04}
    label = list(range(size))
    for i in range(size):
        for j in range(i + 1, size):
            if m.get((i, j), 0) > common:
                label[i] = label[j] = min(label[i], label[j])
    want = []
    for x in range(size):
        while label[x] != label[label[x]]:
            label[x] = label[label[x]]
        want.append((x, label[x]))
    shared = spark.createDataFrame([(j, i, n) if (i + j) % 2 else (i, j, n) for (i, j), n in m.items()], "i long, j long, shared long")
    names = spark.range(size).withColumnRenamed("id", "name")
    assert rows(cluster.single_pass(names, shared, common)) == want
    whole = rows(cluster.groups(names, shared, common))
    assert len({g for _, g in want}) > len({g for _, g in whole}) and all(a >= b for (_, a), (_, b) in zip(want, whole))


def naive_tree(names, dist):
    """The rule step by step over a growing matrix, as nested tuples (left, right)."""
    d = {(i, j): float(dist[i][j]) for i in range(len(names)) for j in range(len(names)) if i != j}
    live, made = list(range(len(names))), dict(enumerate(names))
    lengths = []
    while len(live) > 1:
        pairs = [(i, j) for i in live for j in live if i != j]
        i, j = next((p for p in pairs if d[p] == 0), None) or min(pairs, key=lambda p: d[p])
        new = max(made) + 1
        made[new] = (made[j], made[i])
        lengths.append(d[i, j] / 2)
        live = [x for x in live if x not in (i, j)]
        for x in live:
            d[x, new] = d[new, x] = (d[x, i] + d[x, j]) / 2
        live.append(new)
    return made[live[0]], lengths


def nested(node):
    return node.name if node.left is None else (nested(node.left), nested(node.right))


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 9), st.integers(1, 12), st.randoms(use_true_random=False))
def test_tree_against_naive_loop(n, top, rng):
    d = np.zeros((n, n))
    for i in range(n):
        for j in range(i):
            d[i, j] = d[j, i] = rng.randint(0, top)
    names = [f"s{i}" for i in range(n)]
    want, heights = naive_tree(names, d)
    got = cluster.tree(names, d)
    assert nested(got) == want and got.height == heights[-1]


def test_tree_and_newick():
    d = np.array([[0, 2, 6], [2, 0, 4], [6, 4, 0]], float)
    t = cluster.tree(["a", "b", "c"], d)
    assert t.newick() == "((b:1.0000000,a:1.0000000):1.500000,c:2.5000000):0.000000"
    assert [x.name for x in cluster.parse_newick(t.newick() + ";").leaves()] == ["b", "a", "c"]
    big = cluster.tree([str(i) for i in range(1500)], np.abs(np.subtract.outer(*[2.0 ** np.minimum(np.arange(1500), 900)] * 2)))
    assert len(cluster.parse_newick(big.newick()).leaves()) == 1500
    many = cluster.parse_newick("(a:1,b:2,(c,d,e)x:3,f);")
    assert [x.name for x in many.leaves()] == list("abcdef") and many.leaves()[1].length == 2
    # UPGMA weighs sides by their leaves
    e = np.array([[0, 1, 4, 9], [1, 0, 4, 9], [4, 4, 0, 3], [9, 9, 3, 0]], float)
    assert cluster.tree(list("abcd"), e, False).height == cluster.tree(list("abcd"), e).height == 3.25
    f = np.array([[0, 1, 2, 9], [1, 0, 2, 9], [2, 2, 0, 3], [9, 9, 3, 0]], float)
    assert cluster.tree(list("abcd"), f, False).height == 3.5 and cluster.tree(list("abcd"), f).height == 3.0
    labels = [("a", 1), ("b", 1), ("c", 2), ("d", 1), ("e", 3)]
    assert list(cluster.renumbered(labels, True).values()) == [1, 1, 2, 2, 3]
    assert list(cluster.renumbered(labels).values()) == [1, 1, 2, 1, 3]


def naive_order(paths):
    """The rule over the paths themselves: lists of successors, a start mark and an end mark."""
    after, seen = {"<": []}, ["<"]
    for path in paths:
        last = "<"
        for x in path:
            after.setdefault(last, []).append(x)
            if x not in seen:
                seen.append(x)
            last = x
    order = []
    for x in sorted(seen, key=lambda x: -len(after.get(x, []))):
        options = after.get(x, []) + [">"]
        y = max(options, key=options.count)
        if x in order and y in order:
            continue
        if x in order:
            order.insert(order.index(x) + 1, y)
        elif y in order:
            order.insert(order.index(y), x)
        else:
            order += [x, y]
    return [x for x in order if x not in "<>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.permutations(list("abcdefg")).flatmap(lambda p: st.integers(1, 7).map(lambda n: list(p[:n]))), min_size=1, max_size=8))
def test_linear_order_against_naive_loop(paths):
    count, first = {}, {}
    for q, path in enumerate(paths):
        for at, pair in enumerate(zip([None, *path], path)):
            count[pair] = count.get(pair, 0) + 1
            first.setdefault(pair, (q, at))
    edges = [(*pair, n, first[pair]) for pair, n in count.items()]
    assert graph.linear_order(edges) == graph.linear_order(edges[::-1]) == naive_order(paths)


def test_successors_and_linear_orders(spark):
    paths = ["abc", "axc", "xab", "d"]
    rows_ = [(q, at, x, "g") for q, p in enumerate(paths) for at, x in enumerate(p)]
    visits = spark.createDataFrame(rows_, "q int, at int, chunk string, g string")
    edges = graph.successors(visits, "q", "chunk", "at")
    got = graph.linear_orders(edges.withColumn("g", F.lit("g")), "g").orderBy("place").collect()
    assert [r.chunk for r in got] == naive_order(paths)


def test_types(spark):
    m = [("g", i, j, 5000.0 if i == j else 4990.0 if (i < 3) == (j < 3) else 100.0) for i in range(6) for j in range(i, 6)]
    got = cluster.types(spark.createDataFrame(m, "g string, i long, j long, m double"), "g")
    by = {r.name: r.type for r in got.collect()}
    assert len({by[x] for x in "012"}) == 1 and len({by[x] for x in "345"}) == 1 and by["0"] != by["3"]


def test_matches(spark):
    alleles = spark.createDataFrame([("a", "h", False), ("b", "h", False), ("c", "h", False), ("r", "ref", True)], "name string, haplo string, is_ref boolean")
    pairs = spark.createDataFrame([("a", "r", 0.1), ("b", "r", 0.05), ("c", "r", 0.3)], "name string, ref string, dist double")
    assert rows(cluster.match_references(pairs, alleles).select("name", "tag")) == [("a", "Dup"), ("b", "Pri"), ("c", "Novel"), ("r", "Ref")]


def test_uncertain_against_the_file_order(spark):
    """Line by line: neighbours in the file whatever their haplotype, shared pairs and first differences of assembled haplotypes only."""
    rng = random.Random(2)
    lines = [(rng.choice("abcdefgh") + str(i // 2 if rng.random() < 0.5 else i), rng.choice(["s_h1", "s_h2", "NC_060925", "chr1"]), rng.choice("rstuvwxyz") + str(rng.randrange(40)), rng.random() * 0.2) for i in range(300)]
    want, pairs, last = set(), {}, ""
    for name, haplo, ref, diff in lines:
        if name == last:
            want.add(name)
        last = name
        if "_h" in haplo or "NC_0609" in haplo:
            if (haplo, ref) in pairs:
                want |= {name, *pairs[haplo, ref]}
            elif diff > 0.1:
                want.add(name)
            pairs.setdefault((haplo, ref), []).append(name)
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(lines)], "allele string, haplo string, ref string, diff double, n long").repartition(7)
    assert {r.allele for r in annotate.uncertain(df).collect()} == want and 50 < len(want) < 300
    apart = spark.createDataFrame([("a", "h1", "r", 0.0, 1), ("b", "h2", "s", 0.0, 2), ("a", "h1", "t", 0.0, 3)], df.schema)
    assert not annotate.uncertain(apart).collect()


def test_annotation(spark):
    df = spark.createDataFrame([(1, "x", 0), (1, "y", 1), (1, "y", 0), (2, "z", 0), (2, "z", 0), (2, "Ref", 0), (3, "b", 0), (3, "a", 0)], "t int, tag string, exon int")
    assert rows(annotate.majority(df, "t", "tag", "exon")) == [(1, "y", 1, 3), (2, "Ref", 0, 3), (3, "a", 0, 2)]
    loci = spark.createDataFrame([("l", "c", -2, 3, "-")], "name string, contig string, start long, end long, strand string")
    assert annotate.fetch(loci, spark.createDataFrame([("c", "AACGT")], "contig string, seq string")).first().seq == "GTT"
    seqs = spark.createDataFrame([("q", "aaCGt"), ("r", "TTtt")], "name string, seq string")
    v = spark.createDataFrame([("q", "r", "I", 1, 4), ("q", "r", "D", 0, 3)], "allele string, ref string, kind string, start long, end long")
    assert sorted(r.unique for r in annotate.variant_bases(v, seqs, seqs).collect()) == [2, 2]


def test_graph(spark):
    al = spark.createDataFrame([("a", 1, "s", "+", 0, 100, 0, "100=", 5), ("a", 2, "t", "-", 60, 200, 10, "140=", 9)], "allele string, id int, segment string, strand string, start long, end long, rstart long, cigar string, score int")
    got = graph.paths(al).first()
    assert got.path == ">s<t" and got.steps[0].cigar == "60=" and (got.steps[1].rstart, got.steps[1].rend) == (10, 150)
    text = spark.createDataFrame([("a", ">s<t", "0_60;10_150")], "allele string, path string, ranges string")
    assert rows(graph.exploded(text)) == [("a", 0, "s", ">", 0, 60), ("a", 1, "t", "<", 10, 150)]


@pytest.mark.parametrize("weighted", [True, False])
def test_sparse_tree_is_that_of_the_whole_matrix(weighted):
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 40, 90):
        d = np.ones((n, n))
        pairs = []
        for i in range(n):
            for j in range(i + 1, n):
                if rng.random() < 2 / n:
                    d[i, j] = d[j, i] = rng.choice([0.0, 0.25, 0.5, 0.5, rng.random()])
                    pairs.append((i, j, float(d[i, j])))
        np.fill_diagonal(d, 0)
        names = [f"n{i}" for i in range(n)]
        assert cluster.sparse_tree(names, pairs, weighted).newick() == cluster.tree(names, d, weighted).newick()
    assert len(cluster.sparse_tree([str(i) for i in range(50_000)], [(3, 40_000, 0.1)], weighted).leaves()) == 50_000


def test_set_overlaps_follow_the_number_of_rows(spark, monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(similarity, "DEALT", 20)
    a, b = ([(i, [rng.randrange(40) for _ in range(6)]) for i in range(50)] for _ in range(2))
    got = similarity.set_overlaps(spark.createDataFrame(a, "id long, items array<int>"), spark.createDataFrame(b, "id2 long, items2 array<int>"))
    assert rows(got) == sorted((i, j, len(set(x) & set(y))) for i, x in a for j, y in b if set(x) & set(y))
    assert "partial_count" not in got._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]


@pytest.mark.parametrize("product", [False, True])
def test_pairs_of_blocks_are_those_of_a_join(spark, monkeypatch, product):
    """Many blocks and pieces, an even and an odd number of blocks, a sequence of no pair, one without a name; no row for each k-mer of a pair is sent."""
    rng = random.Random(12)
    counts = [(i, x, rng.randrange(1, 5), 1 + x % 3) for i in range(90) for x in rng.sample(range(60), 6)] + [(200, 900, 3, 4), (None, 1, 1, 2)]
    df = spark.createDataFrame(counts, "s long, kmer long, cnt long, weight long").cache()
    value = F.col("ci") * F.col("cj") if product else F.least("ci", "cj")
    want = rows(similarity._pairs(df, "s").groupBy("i", "j").agg(F.sum(value * F.col("weight")).alias("m")))
    assert want
    for n in (1, 4, 7):
        monkeypatch.setattr(blocks, "TINY", 10 if n > 1 else 10_000)
        monkeypatch.setattr(blocks, "BLOCKS", n)
        monkeypatch.setattr(blocks, "PIECE", 9)
        got = blocks.paired(df, "s", product)
        assert rows(got) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
        # with sides, every pair of a true and a false one, the true one first
        sided = df.withColumn("is_ref", F.when(F.col("s") % 4 < 2, F.col("s") % 4 == 0))
        kind = lambda x: {0: True, 1: False}.get(x % 4)
        both = [(i, j, m) if kind(i) else (j, i, m) for i, j, m in want if {kind(i), kind(j)} == {True, False}]
        assert rows(blocks.paired(sided, "s", product, "is_ref")) == sorted(both)


def test_sums_of_a_pair_are_added_up_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    name, kmer = (x.ravel() for x in np.meshgrid(np.arange(20) * 7 + 3, np.arange(30)))
    cnt = rng.integers(1, 5, len(name))
    a, b = (blocks.Rows(name, kmer, n, np.full(len(name), w)) for n, w in ((cnt, 2), (cnt[::-1], 2)))
    flat = lambda: sorted(x for i, j, m in blocks.sums(a, b, True) for x in zip(i.tolist(), j.tolist(), m.tolist()))
    want = flat()
    m = cnt.reshape(30, 20)
    assert [x[2] for x in want] == (2 * m.T @ cnt[::-1].reshape(30, 20)).ravel().tolist()
    for most in (1, 50, 333, 5000):
        monkeypatch.setattr(blocks, "MOST", most)
        assert flat() == want
    huge = blocks.Rows(np.array([1, 1]), np.array([5, 6]), np.array([2**30, 1]), np.array([1, 1]))
    assert [m.tolist() for _, _, m in blocks.sums(huge, huge, True)] == [[2**60 + 1]]


def test_trees_of_many_groups_are_made_in_batches(spark):
    """Groups of one, a group without a name and one that batches cut; Python is not called anew for each group."""
    rng = random.Random(8)
    large = [(-5, i, j, float(rng.randrange(1, 90)) if i < j else 100.0) for i in range(200) for j in range(i, 200)]
    none = [(None, 7000, 7000, 5.0), (None, 7001, 7001, 5.0), (None, 7000, 7001, 4.0)]
    df = spark.createDataFrame([*large, *none, *((g, 9000 + g, 9000 + g, 3.0) for g in range(500))], "g long, i long, j long, m double")
    d = np.zeros((200, 200))
    for _, i, j, m in large:
        d[i, j] = d[j, i] = m
    names = sorted(range(200))
    root = cluster.tree([str(x) for x in names], cluster._distances(d))
    found = cluster.trees(df, "g")
    got = {r.g: (r.newick, r.leaves) for r in found.collect()}
    assert got[-5] == (root.newick() + ";", [x.name for x in root.leaves()])
    assert sorted(got[None][1]) == ["7000", "7001"] and got[3] == ("9003:0.0000000;", ["9003"]) and len(got) == 502
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
    typed = cluster.types(df, "g")
    assert typed.count() == 702 and rows(typed.where("g >= 0").select("type").distinct()) == [(1,)]
    want = cluster.typed(root, cluster.clades(root, {str(x): x for x in names}, d))
    assert {r.name: r.type for r in typed.where("g = -5").collect()} == want


def test_pairs_are_not_sent_again_for_their_sequences(spark):
    """Distances and containment: what each sequence has goes to the pairs, which stay where they are made."""
    counts = spark.createDataFrame([(i, x, 1 + i % 3, 1) for i in range(12) for x in range(i % 4, 9)], "s long, kmer long, cnt long, weight long")
    shared = similarity.shared_l1(counts, "s")
    sizes = counts.groupBy(F.col("s").alias("name")).agg(F.sum("cnt").alias("size"))
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for got in (similarity.distances(counts, "s"), similarity.containment(shared, sizes)):
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and got.count() == 66
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
