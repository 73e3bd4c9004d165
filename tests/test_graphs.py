"""Growth of graphs, repeats in them and the whole chain, against plain loops."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from allelespan.operators import growth, repeats
from allelespan.plans import pipelines
from tests.test_operators import naive_tree

TURN = str.maketrans("ACGTacgt", "TGCAtgca")


def bases(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def turned(s):
    return s[::-1].translate(TURN)


def plain_graph(alleles, k=31):
    """Segments by sets of strings: every stretch of over 30 bases that no k-mer of the graph covers, 60 more on both sides, 300 at least."""
    made = []
    for name, seq in alleles:
        if not made:
            made.append((f"{name}_0_{len(seq)}", seq))
            continue
        have = {x for _, s in made for i in range(len(s) - k + 1) for x in (s[i : i + k].upper(), turned(s[i : i + k].upper()))}
        covered = [False] * len(seq)
        for i in range(len(seq) - k + 1):
            if seq[i : i + k].upper() in have:
                covered[i : i + k] = [True] * k
        fresh, at, gaps = [], 0, []
        for i in range(len(seq)):
            if covered[i]:
                gaps.append((at, i))
                at = i + 1
        gaps.append((at, len(seq) - 1))
        for a, b in gaps:
            if b - a > 30:
                start, end = max(0, a - 60), min(len(seq), b + 60)
                if end - start < 300:
                    if start == 0:
                        end += 300 - (end - start)
                    else:
                        start -= min(start, 300 - (end - start))
                fresh.append((f"{name}_{start}_{end}", seq[start:end]))
        made += fresh
    return made


@pytest.mark.parametrize("size", [20, 31, 62, 200, 299, 400])
def test_insertions_of_all_sizes(size):
    """An insertion of over 30 bases makes a segment of at least 300, wherever it stands; a smaller one makes none."""
    rng = random.Random(size)
    base = bases(rng, 1500)
    for at in (0, 40, 700, 1490, 1500):
        more = base[:at] + bases(rng, size) + base[at:]
        g = growth.Graph(growth.KmerIndex())
        made = g.add("a", base) + g.add("b", more)
        assert made == plain_graph([("a", base), ("b", more)])
        assert len(made) == 1 + (size > 31) or at in (0, 1500, 1490) or size == 31
        assert all(len(s) >= min(300, len(more)) or n.startswith("b_0_") for n, s in made)


def test_growth_against_sets(spark):
    """Many graphs, both strands, masked bases, N, short and empty alleles; alleles enter by weight."""
    rng = random.Random(7)
    rows = []
    for g in range(4):
        base = bases(rng, 900)
        for i in range(9):
            a, b = sorted(rng.sample(range(900), 2))
            s = base[:a] + bases(rng, rng.choice((0, 25, 31, 40, 200))) + (turned(base[a:b]) if i % 3 == 0 else base[a:b].lower()) + base[b:]
            rows.append((g, rng.choice(["x", "NC_0", "y_chr1", "y_chr1v2", "zv"]) + str(i), s if i != 4 else s.replace("A", "N", 3)))
        rows += [(g, "short", "ACGT"), (g, "none", ""), (g, "null", None)]
    got = growth.graphs(spark.createDataFrame(rows, "g long, name string, seq string").repartition(5), "g").collect()
    weight = lambda n, s: ((2 if "NC_" in n else 3 if "_chr" in n and "v" not in n else 1 if "v" in n else 0), len(s))
    for g in range(4):
        own = [(n, s or "") for x, n, s in rows if x == g]
        own.sort(key=lambda x: x[0])
        own.sort(key=lambda x: weight(*x), reverse=True)
        assert [(r.segment, r.seq) for r in sorted((r for r in got if r.g == g), key=lambda r: r.place)] == plain_graph(own)


def test_index_keeps_first_places():
    rng = random.Random(8)
    index, first = growth.KmerIndex(11), {}
    for n in range(40):
        s = bases(rng, rng.randrange(5, 120))
        for i in range(len(s) - 10):
            x = s[i : i + 11]
            first.setdefault(max(x, turned(x)), n << 32 | i)
        index.add(s)
        assert len(index.runs) < 8
        t = bases(rng, 30) + s[3:40]
        assert index.places(t).tolist() == [first.get(max(t[i : i + 11], turned(t[i : i + 11])), -1) for i in range(len(t) - 10)]


def test_set_grows_the_graph_of_the_index_in_less_memory():
    rng = random.Random(9)
    base = bases(rng, 3000)
    alleles = [(f"a{i}", base[: rng.randrange(3000)] + bases(rng, rng.choice((10, 31, 80, 400))) + turned(base[rng.randrange(3000) :])) for i in range(60)]
    by_set, by_index = growth.Graph(growth.KmerSet()), growth.Graph(growth.KmerIndex())
    assert [by_set.add(*a) for a in alleles] == [by_index.add(*a) for a in alleles]
    kept = sum(x.nbytes for x in by_set.finder.runs)
    assert 2 * kept <= sum(x.nbytes for run in by_index.finder.runs for x in run) and kept == 8 * len(set().union(*(x.tolist() for x in by_set.finder.runs)))


def plain_left(hits, size):
    """start, end of what is left of one segment, step by step."""
    used = sorted((a, b) for a, b, place, rplace, x, y in hits if rplace <= place and a > x and a > y)
    merged = []
    for a, b in used:
        if merged and a - merged[-1][1] <= 30:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, at = set(), 0
    for a, b in [*merged, [size, size]]:
        start, end = max(0, at - 30), min(size, a + 30)
        if end - start < 151:
            if start == 0:
                end += 151 - (end - start)
            else:
                start -= min(start, 151 - (end - start))
        out.add((start, end))
        at = b
    return out


def test_what_is_left_against_a_loop(spark):
    rng = random.Random(9)
    hits, sizes, want = [], [], set()
    for s in range(60):
        size = rng.choice((80, 151, 400, 3000))
        own = []
        for _ in range(rng.randrange(8)):
            a = rng.randrange(size)
            b, x = min(size, a + rng.randrange(1, 300)), rng.randrange(size)
            own.append((a, b, s, rng.choice((s, s - 1, s + 1)), x, rng.choice((x + 50, max(0, x - 50)))))
        hits += [(str(s), p, a, b, r, x, y) for a, b, p, r, x, y in own]
        sizes.append((str(s), size))
        want |= {(str(s), *x) for x in plain_left(own, size)}
    got = repeats.without_repeats(spark.createDataFrame(hits, "segment string, place int, start long, end long, rplace int, rstart long, rend long"), spark.createDataFrame(sizes, "segment string, size long"))
    assert {tuple(r) for r in got.collect()} == want


def test_tandem_copies_and_later_matches_stay(spark):
    """A hit that overlaps what it matches, or lies before it, is no repeat; short remains are widened, not dropped."""
    hits = [("s", 1, 100, 300, 1, 50, 250), ("s", 1, 400, 600, 1, 700, 900), ("s", 1, 800, 990, 0, 10, 200)]
    got = repeats.without_repeats(spark.createDataFrame(hits, "segment string, place int, start long, end long, rplace int, rstart long, rend long"), spark.createDataFrame([("s", 1000)], "segment string, size long"))
    assert {tuple(r) for r in got.collect()} == {("s", 0, 830), ("s", 849, 1000)}


@pytest.mark.parametrize("together", [1, 256])
def test_self_hits_find_planted_repeats(spark, monkeypatch, together):
    """Copies on both strands, with changes and an insertion; every hit is a true match, unrelated sequence has none."""
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = random.Random(10)
    unit = bases(rng, 600)
    changed = "".join(rng.choice("ACGT") if rng.random() < 0.02 else c for c in unit)
    grown = unit[:300] + bases(rng, 5) + unit[300:]
    parts = {"a": bases(rng, 500) + unit + bases(rng, 500), "b": bases(rng, 2000) + changed + bases(rng, 300), "c": bases(rng, 1500) + turned(unit) + bases(rng, 200), "d": bases(rng, 1300) + grown + bases(rng, 100), "e": bases(rng, 3000)}
    parts["f"] = bases(rng, 100) + unit + bases(rng, 700) + unit
    rows = [(g, n, s, i) for g in ("x", "y") for i, (n, s) in enumerate(parts.items())] + [("x", "g", None, 9), ("x", "h", "ACG", 10)]
    got = repeats.self_hits(spark.createDataFrame(rows, "g string, segment string, seq string, place int").repartition(3), "g").collect()
    names = list(parts)
    covered = defaultdict(set)
    for r in got:
        a, b = parts[r.segment][r.start : r.end], parts[names[r.rplace]][r.rstart : r.rend]
        same = sum(x == y for x, y in zip(a, b if r.forward else turned(b)))
        assert len(a) == len(b) and same >= 0.85 * len(a) and r.rplace <= r.place
        covered[r.g, r.segment].update(range(r.start, r.end))
    for g in ("x", "y"):
        for n, start, size in (("b", 2000, 600), ("c", 1500, 600), ("d", 1300, 605), ("f", 1400, 600)):
            assert len(covered[g, n] & set(range(start, start + size))) > 0.85 * size, n
        assert not covered[g, "e"] and not covered[g, "a"]


def test_exact_hits_are_all_maximal_matches(spark):
    rng = random.Random(11)
    segment = bases(rng, 400)
    allele = segment[50:200] + "A" + turned(segment[210:300]) + bases(rng, 60) + segment[100:160]
    k = 21
    want = set()
    for strand, t in (("+", segment), ("-", turned(segment))):
        for i in range(len(allele)):
            for j in range(len(t)):
                if allele[i] == t[j] and (i == 0 or j == 0 or allele[i - 1] != t[j - 1]):
                    n = 0
                    while i + n < len(allele) and j + n < len(t) and allele[i + n] == t[j + n]:
                        n += 1
                    if n >= k:
                        want.add((strand, i, i + n, j if strand == "+" else len(t) - j - n, f"{n}="))
    a = spark.createDataFrame([("g", "q", allele), ("h", "q", segment)], "g string, name string, seq string")
    s = spark.createDataFrame([("g", "s", segment)], "g string, segment string, seq string")
    got = repeats.exact_hits(a, s, "g", k).collect()
    assert {(r.strand, r.start, r.end, r.rstart, r.cigar) for r in got} == want and len(want) >= 3
    assert all(r.g == "g" and r.rend - r.rstart == r.end - r.start for r in got)


def test_hits_do_not_depend_on_blocks(spark, monkeypatch):
    """Pairs are found in tasks that hold two blocks; few or many blocks give the same hits. Of exact hits those that none holds stay."""
    rng = random.Random(14)
    units = [bases(rng, 400) for _ in range(3)]
    seqs = [bases(rng, 150) + (units[i % 3] if i % 2 else turned(units[i % 3])) + bases(rng, 90) + units[i % 2][:200] for i in range(12)]
    rows = spark.createDataFrame([("g", f"s{i}", s, i) for i, s in enumerate(seqs)], "g string, segment string, seq string, place int").cache()
    alleles = rows.select("g", F.col("segment").alias("name"), "seq")
    found = []
    for block, together in ((1 << 22, 1 << 19), (1500, 40)):
        monkeypatch.setattr(repeats, "BLOCK", block)
        monkeypatch.setattr(repeats, "TOGETHER", together)
        found.append(({tuple(r) for r in repeats.self_hits(rows, "g").collect()}, {tuple(r) for r in repeats.exact_hits(alleles, rows, "g", 31).collect()}))
    assert found[0] == found[1] and len(found[0][0]) > 20
    monkeypatch.undo()
    whole = repeats.exact_hits(alleles, rows, "g", 31).collect()
    best = {(r.allele, r.id) for r in repeats.exact_hits(alleles, rows, "g", 31, best=True).collect()}
    holds = lambda a, b: a.allele == b.allele and a.start <= b.start and b.end <= a.end and (a.score > b.score or a.id < b.id)
    assert best == {(b.allele, b.id) for b in whole if not any(holds(a, b) for a in whole)} and len(best) < len(whole)


def test_chain_by_group_is_that_of_each_group_alone(spark):
    """Two graphs with the same names give what each gives alone: groups do not mix."""
    rng = random.Random(12)
    rows = []
    for g in ("u", "v"):
        base = bases(rng, 1200)
        rows += [(g, "a_chr", base), (g, "b", base[:500] + bases(rng, 350) + base[500:]), (g, "c", base[:800] + bases(rng, 90) + base[800:]), (g, "d", base[200:])]
    df = spark.createDataFrame(rows, "fam string, name string, seq string")
    both = pipelines.graph_pipeline(df, "fam")
    for name, columns in (("segments", ["segment", "seq"]), ("kept", ["segment", "seq"]), ("paths", ["allele", "path"]), ("visits", ["allele", "visit", "place", "strand"]), ("order", ["chunk", "place"])):
        alone = [(g, *r) for g in ("u", "v") for r in pipelines.graph_pipeline(df.where(F.col("fam") == g), "fam")[name].select(*columns).collect()]
        got = [tuple(r) for r in both[name].select("fam", *columns).collect()]
        assert sorted(got) == sorted(alone) and got, name
    paths = {(r.fam, r.allele): r.path for r in both["paths"].collect()}
    assert all(paths[g, "a_chr"].startswith(">a_chr_0_1200") for g in "uv") and all(paths[g, "b"].count(">") >= 3 for g in "uv")


def test_masked_order_against_loops(spark):
    """Unmasked bases, distances and trees of each group, k-mer by k-mer and merge by merge."""
    rng = random.Random(13)
    k, rows = 9, []
    for g in ("u", "v"):
        base = bases(rng, 300)
        for i in range(9):
            s = list(base)
            for _ in range(rng.randrange(3, 40)):
                s[rng.randrange(300)] = rng.choice("ACGT")
            rows.append((g, f"{g}{i}", "".join(s)))
        rows += [(g, f"{g}x", bases(rng, 200)), (g, f"{g}y", "ACG")]
    canonical = lambda x: max(x, turned(x))
    listed = sorted({canonical(s[i : i + k]) for _, _, s in rows for i in range(0, len(s) - k + 1, 2)})
    masked, trees = pipelines.masked_trees(spark.createDataFrame(rows, "fam string, name string, seq string"), spark.createDataFrame([(x,) for x in listed], "kmer string"), "fam", k)
    seqs = {r.name: r.seq for r in masked.collect()}
    ranks = {(r.fam, r.name): r.leaf for r in pipelines.leaf_ranks(trees, "fam").collect()}
    known = set(listed)
    for g in ("u", "v"):
        own = sorted((n, s) for f, n, s in rows if f == g)
        counts = []
        for n, s in own:
            c, upper, last = Counter(), set(), None  # from one hit's last base up to that of the next, if they are at most k apart
            for i in range(len(s) - k + 1):
                x = canonical(s[i : i + k])
                if x in known:
                    c[x] += 1
                    upper.update(range(last + k - 1, i + k - 1) if last is not None and i - last <= k else ())
                    last = i
            counts.append(c)
            assert seqs[n] == "".join(b if i in upper else b.lower() for i, b in enumerate(s))
        lone = Counter(x for c in counts for x in c)
        weight = [sum(v * v / (20 if lone[x] == 1 else 1) for x, v in c.items()) for c in counts]
        dist = [[1 - sum(v * b[x] for x, v in a.items()) / (max(1, wa) * max(1, wb)) ** 0.5 for b, wb in zip(counts, weight)] for a, wa in zip(counts, weight)]
        leaves, todo = [], [naive_tree([n for n, _ in own], dist)[0]]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += [x[1], x[0]]
            else:
                leaves.append(x)
        assert [n for n, _ in sorted(((n, r) for (f, n), r in ranks.items() if f == g), key=lambda x: x[1])] == leaves
