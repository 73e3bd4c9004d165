"""Near duplicates by SimHash fingerprints, linked through popcounts of segments.

Fingerprints: words of the A-Z-lowered text, all runs of three words with repeats, XXH64 (seed 42) of each; a bit is 1 if
over half of the hashes have it. It runs on the JVM: two 32-bit lanes in each of 32 sums, so map-side sums shrink a text
to one row before anything is shuffled.

Linking: distinct fingerprints only. A fingerprint is cut into 32 segments of two bits; the vector of the segments' bit
counts is its embedding. The Manhattan distance of two embeddings is at most the Hamming distance of the fingerprints.
The segments form GROUPS groups; two embeddings within `most` differ in at most `most` groups and agree in the others, so
the grid join looks up each choice of GROUPS - most groups by equal cells. In a cell, fingerprints within Manhattan
distance `most` are verified exactly. A cell's pairs are never emitted: each task returns a spanning forest of the links
it found. A cell of more than BLOCK fingerprints is dealt out as pairs of blocks of that size. GROUPS follows
the number of fingerprints, so that cells stay small; what is found does not depend on it.

`kept` also asks how alike texts are, for removing copies: fingerprints within RADIUS bits make groups of candidates, and in a group a
row goes only if its text equals that of an earlier row that stays, or shares 0.8 of their five-word shingles with it (Jaccard).
Equal texts are one from the start, by a sum on the map side. Groups are settled in rounds: the first rows of each (LEADERS, in
each later round twice as many, up to MOST_LEADERS) are compared with all others of the group, as arrays of shingle hashes side
by side.

Edge cases: null and empty texts and those of white space have fingerprint zero, which links like any other. One or two
words count as one shingle. Repeated rows share a fingerprint and so a component. A null doc_id is passed over when the
smallest is sought; a component of nulls only has a null id. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import ascii_lower, numbered, shuffle_partitions, staged, table
from allelespan.operators.components import components
from allelespan.sources.staging import scratch

BLOCK = 4096
MOST = 3
#: Bits, shingle length, similarity and compared rows of a group of kept(), and how many rows of a group are dealt out together.
RADIUS, SHINGLE, ALIKE, LEADERS, MOST_LEADERS, DEALT = 7, 5, 0.8, 16, 128, 512


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, fp (long, the 64 bits) for each row; key must be unique."""
    words = df.select(key, words_of(F.col(text)).alias("w"))
    triples = F.arrays_zip(F.col("w"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))), F.slice("w", 3, F.greatest(F.size("w"), F.lit(1)))).alias("t")
    rows = words.select(key, F.size("w").alias("n"), F.explode_outer(triples).alias("t"))
    a, b, c = (rows["t"][str(f)] for f in ("w", "1", "2"))
    rows = rows.select(key, "n", a.alias("a"), b.alias("b"), c.alias("c"))
    whole = (F.col("n") >= 3) & F.col("c").isNotNull()
    two, one = (F.col("n") == 2) & F.col("b").isNotNull(), F.col("n") == 1
    h = F.when(whole, F.xxhash64(F.concat_ws(" ", "a", "b", "c"))).when(two, F.xxhash64(F.concat_ws(" ", "a", "b"))).when(one, F.xxhash64("a"))
    lanes = F.lit(0x0000000100000001)
    rows = rows.select(key, h.alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", i).bitwiseAND(lanes)).alias(f"s{i}") for i in range(32)]
    got = rows.groupBy(key).agg(F.count("h").alias("n"), *sums)
    fp = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{i}", 32)
        fp = fp.bitwiseOR(F.when(low * 2 > F.col("n"), F.lit(1 << i)).otherwise(F.lit(0).cast("long")))
        fp = fp.bitwiseOR(F.when(high * 2 > F.col("n"), F.lit((1 << (i + 32)) - (1 << 64 if i == 31 else 0))).otherwise(F.lit(0).cast("long")))
    return got.select(key, fp.alias("fp"))


def _embedded(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments; 0, 1 and 2 are written 00, 01 and 11, so the Manhattan distance is the number of bits that differ."""
    five, one = np.uint64(0x5555555555555555), np.uint64(1)
    low, high = fp & five, (fp >> one) & five
    return (low | high) | ((low & high) << one)


def _manhattan(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y)


def _masks(groups: int) -> list[int]:
    """Bits of each group: whole segments, as even as may be."""
    edge = [round(32 * i / groups) for i in range(groups + 1)]
    return [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edge, edge[1:])]


def _forest(a: np.ndarray, b: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (positions a, b in fp), as positions and their roots."""
    root = np.arange(len(fp))
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(fp)))
    return child, root[child]


def _close(fp: np.ndarray, other: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs within `most` bits: the lower bound first, then exactly."""
    found = []
    eo, ef = _embedded(other), _embedded(fp)
    for at in range(0, len(fp), 256):
        i, j = np.nonzero(_manhattan(ef[at : at + 256, None], eo[None, :]) <= most)
        ok = np.bitwise_count(fp[at + i] ^ other[j]) <= most
        found.append((at + i[ok], j[ok]))
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _links(keys: np.ndarray, fp: np.ndarray, block: np.ndarray, first: np.ndarray, second: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (child fingerprint, root fingerprint) of the cells in `keys` (sorted, whole cells)."""
    start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(start, len(keys)))
    a, b = [], []
    small = np.repeat(size <= 64, size)
    d = 1
    while True:  # pairs at distance d in order, for all small cells at once
        i = np.flatnonzero(small[:-d] & (keys[d:] == keys[:-d])) if d < len(keys) else np.zeros(0, int)
        if not len(i):
            break
        i = i[_manhattan(_embedded(fp[i]), _embedded(fp[i + d])) <= most]
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= most]
        a.append(i)
        b.append(i + d)
        d += 1
    for s, n in zip(start[size > 64], size[size > 64]):
        at = np.arange(s, s + n)
        left, right = at[block[at] == first[at]], at[block[at] == second[at]]
        x, y = _close(fp[left], fp[right], most)
        a.append(left[x])
        b.append(right[y])
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    child, root = _forest(np.concatenate(a), np.concatenate(b), fp)
    return fp[child], fp[root]


def groups_for(n: int, most: int) -> int:
    """Fewest groups of segments, `most` + 2 at least, that give n fingerprints cells of some hundreds (a two-bit segment's count
    has about 1.5 bits), where comparing costs no more than moving them. Each choice of groups is a copy of all fingerprints: there
    are no more than six times the fewest."""
    groups = most + 2
    while 48 * (groups - most) / groups < log2(max(2, n)) - 8 and comb(groups + 1, most) <= 6 * comb(most + 2, most):
        groups += 1
    return groups


def links(fps: DataFrame, most: int = MOST, groups: int | None = None, block: int = BLOCK) -> DataFrame:
    """fps: distinct longs `fp`, staged. Edges (a, b) whose components are those of all pairs within `most` bits."""
    groups = groups or groups_for(fps.count(), most)
    five = F.lit(0x5555555555555555)
    low, high = F.col("fp").bitwiseAND(five), F.shiftrightunsigned("fp", 1).bitwiseAND(five)
    e = low.bitwiseOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))  # as in _embedded()
    masks = _masks(groups)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chosen = [(n, sum(masks[i] for i in c)) for n, c in enumerate(combinations(range(groups), groups - most))]
    cells = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(n).alias("c"), e.bitwiseAND(F.lit(signed(m))).alias("e")) for n, m in chosen])).alias("x"))
    cells = cells.select("fp", F.col("x.c").alias("c"), F.col("x.e").alias("e"))
    counts = staged(cells.groupBy("c", "e").agg(F.count("*").alias("n")).where("n > 1"), "simhash-cells")
    cells = cells.join(counts, ["c", "e"])  # a fingerprint alone in its cell has no partner there
    blocks = F.ceil(F.col("n") / block)
    cells = cells.withColumn("m", F.when(F.col("n") > block, blocks).otherwise(F.lit(1)).cast("int"))
    cells = cells.withColumn("k", F.pmod(F.xxhash64("fp"), F.col("m")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda j: F.struct(F.least(j, F.col("k")).alias("i"), F.greatest(j, F.col("k")).alias("j")))
    cells = cells.select("c", "e", "fp", "k", F.explode(pairs).alias("p")).select("c", "e", "fp", "k", F.col("p.i").alias("i"), F.col("p.j").alias("j"))
    dealt = cells.withColumn("cell", F.xxhash64("c", "e", "i", "j")).repartition(shuffle_partitions(fps.sparkSession), "cell").sortWithinPartitions("cell", "c", "e", "i", "j", "fp")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for pdf in batches:
            kept = pdf if kept is None else pd.concat([kept, pdf], ignore_index=True)
            last = kept["cell"].to_numpy()
            cut = int(np.searchsorted(last, last[-1]))
            if cut:
                yield from out(kept.iloc[:cut])
                kept = kept.iloc[cut:]
        if kept is not None and len(kept):
            yield from out(kept)

    def out(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        # cells whose 64-bit hashes collide are told apart here
        same = (pdf[["cell", "c", "e", "i", "j"]].to_numpy()[1:] == pdf[["cell", "c", "e", "i", "j"]].to_numpy()[:-1]).all(axis=1)
        keys = np.concatenate(([0], np.cumsum(~same)))
        fp = pdf["fp"].to_numpy().astype(np.int64).view(np.uint64)
        a, b = _links(keys, fp, pdf["k"].to_numpy(), pdf["i"].to_numpy(), pdf["j"].to_numpy(), most)
        if len(a):
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.mapInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select(F.struct(F.monotonically_increasing_id().alias("r"), F.col("doc_id")).alias("k"), "text")
    prints = staged(fingerprints(rows, "k", "text").select("k.doc_id", "fp"), "simhash-fp")
    first = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    found = components(links(first.select("fp"), most))
    moved = first.join(found, first.fp == found.node).groupBy("root").agg(F.min("first").alias("least"))
    labels = first.join(found, first.fp == found.node, "left").join(moved, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def shingles(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of the distinct runs of n words; of fewer words, that of all of them; none for none."""
    words = words_of(text)
    runs = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(n))))
    # the words stand in a one-element array, so that they are cut once
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) >= n, F.array_distinct(runs(w))).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<long>")))
    return made[0]


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct values; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def kept(rows: DataFrame, row: str, doc_id: str = "doc_id", text: str = "text", most: int = RADIUS, alike: float = ALIKE) -> DataFrame:
    """row: numbers of the rows that stay (see above); of equal or similar ones that with the smallest id, nulls last, then the
    smallest number. rows: staged, with a unique number `row`."""
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(row).alias("row"))
    marked = rows.select(F.struct(key.alias("key"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("same")).alias("k"), F.col(text).alias("text"))
    prints = fingerprints(marked, "k", "text").select("k.key", "k.same", "fp")
    first = staged(prints.groupBy("same").agg(F.min("key").alias("key"), F.min("fp").alias("fp")).select("key", "fp"), "dedup-distinct")
    found = components(links(staged(first.select("fp").distinct(), "dedup-fp"), most))
    first = first.join(found.withColumnsRenamed({"node": "fp"}), "fp", "left").select("key", F.coalesce("root", "fp").alias("group"))
    first = staged(first, "dedup-groups")
    several = first.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group", F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
    members = first.join(several, "group").select("group", "key", "parts", F.col("key.row").alias("row"))
    texts = rows.select(F.col(row).alias("row"), F.col(text).alias("text")).join(members, "row")
    # a large group is dealt out in parts, each of which meets all of its leaders
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    rest = staged(texts.select("group", "key", "parts", part.alias("part"), shingles(F.col("text")).alias("s")), "dedup-members")
    late: list[str] = []
    leaders = LEADERS
    while True:
        place = F.row_number().over(Window.partitionBy("group").orderBy("key"))
        lead = rest.select("group", "key", place.alias("place")).where(F.col("place") <= leaders)
        if lead.where("place > 1").isEmpty():
            break
        lead = staged(lead.join(rest.drop("group"), "key"), "dedup-leaders")
        other = lead.select("group", F.col("key").alias("before"), F.col("place").alias("a"), F.col("s").alias("s0"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        near = rest.join(lead.select("key", F.col("place").alias("b")), "key", "left").join(other, ["group", "part"]).where(F.col("key") > F.col("before"))
        near = staged(near.where(jaccard(F.col("s"), F.col("s0")) >= alike).select("group", "key", "a", "b"), "dedup-near")
        gone = near.where("b IS NOT NULL").groupBy("group").applyInPandas(_later, "group long, a int")
        late.append(scratch(rows.sparkSession, "dedup-late"))
        near.join(gone, ["group", "a"], "left_anti").select("key").distinct().write.parquet(late[-1])
        now = rows.sparkSession.read.schema(first.select("key").schema).parquet(late[-1])
        # groups of one that are left have nobody to be compared with
        rest = rest.join(lead.select("key"), "key", "left_anti").join(now, "key", "left_anti")
        rest = staged(rest, "dedup-members")
        leaders = min(2 * leaders, MOST_LEADERS)
    stay = first.select("key")
    if late:  # the rounds' tables as one scan
        stay = stay.join(rows.sparkSession.read.schema(stay.schema).parquet(*late), "key", "left_anti")
    return stay.select(F.col("key.row").alias(row))


def _later(pdf: pd.DataFrame) -> pd.DataFrame:
    """pdf: group, a, b: places of leaders of one group that are alike, a before b. Those that go: alike to an earlier one that stays."""
    late: set[int] = set()
    for b, own in sorted(pdf.groupby("b")["a"]):
        if set(own) - late:
            late.add(int(b))
    return pd.DataFrame({"group": pdf["group"].iloc[0], "a": sorted(late)})


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar documents the one with the smallest id stays, of equal ids the first row."""
    rows, row = numbered(docs, "dedup-rows")
    return rows.join(kept(rows, row), row, "left_semi").select(docs.columns)
