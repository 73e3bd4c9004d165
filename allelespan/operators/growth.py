"""Growth of pan-gene graphs over an index of k-mers that grows with the graph.

Alleles enter one after the other, as each depends on the graph so far; graphs grow side by side. A graph's alleles come sorted
to the task that grows it, as a stream, so that what is held is the graph and its index, not all alleles.

The index has the canonical k-mers of all segments, two bits a base (KmerIndex: each with the place where it was seen first). Sorted runs
double in size, so that a segment is merged into larger ones a logarithmic number of times and a look-up is a few binary searches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two bits a base in either case; 4 for what is none.
BASES = np.full(256, 4, np.uint8)
for _i, _c in enumerate("ACGT"):
    BASES[ord(_c)] = BASES[ord(_c.lower())] = _i


def insertion_weight(name: Column, size: Column) -> Column:
    """Whole chromosomes that are no alternative versions first, then reference contigs, then names with `v`, then the rest; each by size."""
    rank = F.when(name.contains("NC_"), F.lit(2)).when(name.contains("_chr") & ~name.contains("v"), F.lit(3)).when(name.contains("v"), F.lit(1)).otherwise(F.lit(0))
    return rank * F.lit(10**15).cast("long") + size.cast("long")


def strands(base: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place the k-mers of both strands, two bits a base; base: 0 to 3 as uint64. Words of 1, 2, 4 ... bases are joined."""
    n = len(base) - k + 1
    own, turned, size = base, np.uint64(3) - base, 1
    out, back, done = None, None, 0
    while True:
        if k & size:
            part, other = own[done : done + n], turned[done : done + n]
            out = part if out is None else out << np.uint64(2 * size) | part
            back = other if back is None else back | other << np.uint64(2 * done)
            done += size
        if done == k:
            return out, back
        own, turned = own[:-size] << np.uint64(2 * size) | own[size:], turned[:-size] | turned[size:] << np.uint64(2 * size)
        size *= 2


def canonical_codes(seq: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place the k-mer as a number, the larger of both strands; whether it is the sequence's own strand; whether it has bases only."""
    base = BASES[np.frombuffer(seq.encode("ascii", "replace"), np.uint8)]
    n = len(base) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
    wide = (base & 3).astype(np.uint64)
    own, turned = strands(wide, k)
    bad = np.concatenate(([0], np.cumsum(base > 3)))
    return np.maximum(own, turned), own >= turned, bad[k:] == bad[:-k]


class Finder(Protocol):
    def add(self, seq: str) -> None: ...

    def spans(self, seq: str) -> list[tuple[int, int]]: ...


class KmerIndex:
    """Finder by shared k-mers; stands in where no local aligner is at hand."""

    def __init__(self, k: int = 31):
        self.k, self.n = k, 0
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []  # codes in order, segment << 32 | place

    def add(self, seq: str) -> None:
        codes, _, good = canonical_codes(seq, self.k)
        at = np.flatnonzero(good)
        codes, first = np.unique(codes[at], return_index=True)
        self.runs.append((codes, np.int64(self.n) << np.int64(32) | at[first]))
        self.n += 1
        while len(self.runs) > 1 and len(self.runs[-2][0]) <= 2 * len(self.runs[-1][0]):
            (a, x), (b, y) = self.runs[-2:]
            codes, first = np.unique(np.concatenate((a, b)), return_index=True)  # of equals the one seen first
            self.runs[-2:] = [(codes, np.concatenate((x, y))[first])]

    def places(self, seq: str) -> np.ndarray:
        """Of each place of seq, where its k-mer was seen first (segment << 32 | place), -1 where it was not."""
        codes, _, good = canonical_codes(seq, self.k)
        found = np.full(len(codes), -1, np.int64)
        for have, at in reversed(self.runs):  # the oldest run has the last word
            if len(have):
                i = np.minimum(np.searchsorted(have, codes), len(have) - 1)
                hit = (have[i] == codes) & good
                found[hit] = at[i[hit]]
        return found

    def known(self, seq: str) -> np.ndarray:
        return self.places(seq) >= 0

    def spans(self, seq: str) -> list[tuple[int, int]]:
        at = np.flatnonzero(self.known(seq))
        if not len(at):
            return []
        cut = np.flatnonzero(np.diff(at) > self.k)
        starts, ends = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))] + self.k
        return list(zip(starts.tolist(), ends.tolist()))


class KmerSet(KmerIndex):
    """As KmerIndex, without places, which spans do not need: eight bytes a k-mer. Runs are merged in one array, and what is there already is not kept twice."""

    def add(self, seq: str) -> None:
        codes, _, good = canonical_codes(seq, self.k)
        self.runs.append(np.unique(codes[good & ~self.known(seq)]))
        self.n += 1
        while len(self.runs) > 1 and len(self.runs[-2]) <= 2 * len(self.runs[-1]):
            merged = np.concatenate(self.runs[-2:])
            self.runs[-2:] = [merged]  # the runs go before they are sorted
            merged.sort()

    def known(self, seq: str) -> np.ndarray:
        codes, _, good = canonical_codes(seq, self.k)
        found = np.zeros(len(codes), bool)
        for have in self.runs:
            if len(have):
                found |= have[np.minimum(np.searchsorted(have, codes), len(have) - 1)] == codes
        return found & good


class Pairwise:
    """Finder by a function that aligns a sequence to one segment."""

    def __init__(self, aligner: Callable[[str, str], list[tuple[int, int]]]):
        self.aligner, self.segments = aligner, []

    def add(self, seq: str) -> None:
        self.segments.append(seq)

    def spans(self, seq: str) -> list[tuple[int, int]]:
        return [x for s in self.segments for x in self.aligner(seq, s)]


def unaligned(size: int, found: list[tuple[int, int]], gap: int = 30) -> list[tuple[int, int]]:
    """Stretches of more than gap that nothing covers; the last base bounds the last one."""
    out, at = [], 0
    for a, b in sorted([*found, (size - 1, size - 1)]):
        if a - at > gap:
            out.append((at, a))
        at = max(at, b)
    return out


class Graph:
    """Segments so far: the first allele, then of each next one every stretch of more than `gap` bases that the graph does not have, with
    `pad` at both sides, and widened to `least` (forwards from 0, else backwards). A segment's name holds its start and end, which
    may pass the allele's end where it was widened."""

    def __init__(self, finder: Finder, gap: int = 30, pad: int = 60, least: int = 300):
        self.finder, self.gap, self.pad, self.least, self.empty = finder, gap, pad, least, True

    def add(self, name: str, seq: str) -> list[tuple[str, str]]:
        made = [(f"{name}_0_{len(seq)}", seq)] if self.empty else []
        for a, b in [] if self.empty else unaligned(len(seq), self.finder.spans(seq), self.gap):
            start, end = max(0, a - self.pad), min(len(seq), b + self.pad)
            more = max(0, self.least - (end - start))
            start, end = (0, end + more) if start == 0 else (start - min(start, more), end)
            made.append((f"{name}_{start}_{end}", seq[start:end]))
        for _, s in made:  # an allele is not held against its own stretches
            self.finder.add(s)
        self.empty = False
        return made


def graphs(alleles: DataFrame, group: str, finder: Callable[[], Finder] = KmerSet, gap: int = 30, pad: int = 60, least: int = 300) -> DataFrame:
    """alleles: group, name, seq. group, segment, seq and place (order of entry) of each group's graph. Null sequences are empty."""
    kind = alleles.schema[group].dataType.simpleString()
    seq = F.coalesce("seq", F.lit(""))
    ordered = alleles.select(F.col(group), F.col("name").cast("string").alias("name"), seq.alias("seq"), insertion_weight(F.col("name").cast("string"), F.length(seq)).alias("_w"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grown, at, place = None, None, 0
        for batch in batches:
            rows = []
            for key, name, seq in zip(batch[group].tolist(), batch["name"], batch["seq"]):
                if grown is None or key != at:
                    grown, at, place = Graph(finder(), gap, pad, least), key, 0
                for segment, bases in grown.add(name, seq):
                    rows.append((key, segment, bases, place))
                    place += 1
            yield pd.DataFrame(rows, columns=[group, "segment", "seq", "place"])

    parts = ordered.repartition(group).sortWithinPartitions(group, F.desc("_w"), "name").drop("_w")
    return parts.mapInPandas(run, f"`{group}` {kind}, segment string, seq string, place int")
