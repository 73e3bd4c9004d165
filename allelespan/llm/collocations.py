"""Phrase collocations by a merged count-min sketch and an exact second pass.

First pass: every task hashes its n-grams of 1 to LONGEST words (64 bits, seeded by language) into two rows of cells and
writes counts of the cells it met, in blocks of 65,536 cells, sorted and packed. Blocks are dealt out, sorted, and their
counts added as they stream by; what is left of a block is one bit a cell: at least `least` or not. As a cell counts all
n-grams that fall into it, both bits of a frequent n-gram are set. The number of cells follows the size of the texts, so that a
cell holds at most about half of `least` on average.

Second pass: n-grams whose bits are set, and whose shorter parts have theirs set, are the survivors. They are counted exactly: in a
block of texts by numbers (number of the n-gram before the last word, number of the word), then by phrase in a task and over all tasks.
What the sketch let through by clashes goes when the exact counts are compared with `least`; nothing frequent is lost.

Scores: counts of both sides of each cut are joined by phrase, products are decimals of 38 digits. A candidate goes if a candidate
longer by one word holds it and is as frequent; a longer one than that has such a candidate between them, as counts
never rise with length. The best of each language come from row numbers that every task limits before the exchange.

The bits are the only thing sent to all tasks: 2 ** MOST_BITS bits for each row (64 MB) at most. Beyond that the cells fill and more
n-grams survive to be counted and dropped, with equal results.

Edge cases: null text is empty, null language is `und`. Words are what stands between spaces and tabs, pieces between
`.,;:!?` and line ends; other characters, zero bytes among them, are parts of words. Repeated rows each count. Texts without candidates
and empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import cut_words, shuffle_partitions, staged, table

LONGEST = 5
LEAST = 100
#: A longer candidate drops its parts if it has this share (of a hundred) of their occurrences.
SUBSUMES = 100
BEST = 2000
#: Bytes of text in a block, and cells that are gathered before they are summed and written.
BLOCK, GATHER = 2_000_000, 6_000_000
#: Phrases whose counts a task holds before it writes them, and set cells for each bucket of phrases.
HELD, IN_BUCKET = 400_000, 2048
LEAST_BITS, MOST_BITS = 16, 29
CELLS = 1 << 16

#: A-Z to a-z, what ends a piece to a full stop, tabs to spaces.
PIECES = bytes(c + 32 if 65 <= c <= 90 else ord(".") if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
#: Odd constants of the hashes.
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * C2
    return x ^ (x >> np.uint64(29))


class Words:
    """Words of parts of texts as numbers, 0 between pieces and texts, with the number of the language."""

    def __init__(self, langs: list[str], words: list[bytes], parts: list[tuple[int, int, int]]):
        """parts: language, words, carried words among them."""
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        ids[b"."]  # the number 0
        self.langs, self.word = langs, np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        self.words = list(ids)
        lang, size, carried = (np.array(x, np.int64) for x in zip(*parts))
        place = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
        self.fresh, self.lang, self.place = place >= np.repeat(carried, size), np.repeat(lang, size), place

    def hashes(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length: hash of the n-gram that ends at each place, and whether one does."""
        own = np.array([xxhash.xxh64_intdigest(w) for w in self.words], np.uint64)[self.word]
        seed = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), 1) for x in self.langs], np.uint64)[self.lang]
        h, there = _mix(own ^ seed), self.word > 0
        yield h, there
        for n in range(2, longest + 1):
            before, ended = h, there
            h, there = np.zeros_like(h), np.zeros_like(there)
            h[1:] = _mix(before[:-1] * C1 + own[1:])
            there[1:] = ended[:-1] & (self.word[1:] > 0) & (self.place[1:] >= n - 1)
            yield h, there


def blocks(batch: pa.RecordBatch, longest: int) -> Iterator[Words]:
    """Blocks of a batch of (lang, text)."""
    langs: dict[str, int] = {}
    words: list[bytes] = []
    parts: list[tuple[int, int, int]] = []
    held = 0
    for lang, text in zip(batch.column(0), batch.column(1)):
        number = langs.setdefault(lang.as_py(), len(langs))
        raw = text.as_py().encode("utf-8", "surrogatepass").translate(PIECES).replace(b".", b" . ")
        for carried, own, size in cut_words(raw, BLOCK, longest - 1):
            words += carried
            words += own
            parts.append((number, len(carried) + len(own), len(carried)))
            held += size
            if held >= BLOCK:
                yield Words(list(langs), words, parts)
                words, parts, held = [], [], 0
    if parts:
        yield Words(list(langs), words, parts)


def _cells(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the two rows: the upper and the lower bits of the hash."""
    return (h >> np.uint64(64 - bits)).astype(np.uint32), (h & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _packed(offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted offsets as gaps and counts, each number's bytes in planes, compressed."""
    gaps = np.diff(offsets, prepend=0).astype("<u2")
    planes = [gaps.view(np.uint8).reshape(-1, 2).T, counts.astype("<u4").view(np.uint8).reshape(-1, 4).T]
    return pa.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in planes), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, 6 * n, codec="zstd", asbytes=True), np.uint8)
    gaps = np.ascontiguousarray(raw[: 2 * n].reshape(2, n).T).view("<u2").ravel()
    counts = np.ascontiguousarray(raw[2 * n :].reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(gaps.astype(np.int64)), counts


def sketch(rows: DataFrame, bits: int, least: int = LEAST, longest: int = LONGEST) -> np.ndarray:
    """rows: lang, text. Bits of the two rows of 2 ** bits cells: whether a cell has at least `least`."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def summed() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            block = cells >> np.uint32(16)
            starts = np.flatnonzero(np.diff(block, prepend=block[:1] + np.uint32(1)))
            stops = np.append(starts[1:], len(cells))
            counts = np.minimum(counts, least)  # enough to tell, whatever the others have
            packed = [_packed((cells[a:b] & np.uint32(CELLS - 1)).astype(np.int64), counts[a:b]) for a, b in zip(starts, stops)]
            return pa.RecordBatch.from_arrays([pa.array(block[starts].astype(np.int32)), pa.array((stops - starts).astype(np.int32)), pa.array(packed, pa.binary())], names=["block", "n", "cells"])

        for batch in batches:
            for part in blocks(batch, longest):
                for h, there in part.hashes(longest):
                    upper, lower = _cells(h[there & part.fresh], bits)
                    held += [upper, lower + np.uint32(1 << bits)]
                    if sum(map(len, held)) >= GATHER:
                        yield summed()
        if sum(map(len, held)):
            yield summed()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(CELLS, np.int64)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for b, n, cells in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if b != block:
                    if block is not None:
                        yield done()
                    block = b
                    total[:] = 0
                offsets, counts = _unpacked(cells, n)
                total[offsets] += counts
        if block is not None:
            yield done()

    parts = rows.mapInArrow(partial, "block int, n int, cells binary").repartition(shuffle_partitions(rows.sparkSession), "block").sortWithinPartitions("block")
    out = np.zeros((2 << bits) // 8, np.uint8)
    for r in staged(parts.mapInArrow(merge, "block int, bits binary"), "sketch").toLocalIterator():
        at = r.block * CELLS // 8
        out[at : at + CELLS // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def survivors(rows: DataFrame, sketched: np.ndarray, bits: int, longest: int = LONGEST, least: int = 1) -> DataFrame:
    """lang, size (words), phrase, a: exact counts of the n-grams whose bits, and whose parts' bits, are set, from `least` on; size 0 has the
    words of a language, with an empty phrase. A task adds up the counts of its blocks and writes them in lists by bucket of the phrase's
    hash; the lists of a bucket are added as they stream by. Buckets follow the number of cells that are set, so one is small."""
    sent = rows.sparkSession.sparkContext.broadcast(sketched)
    lower_row = np.int64(1 << bits)
    buckets = 1 + int(np.bitwise_count(sketched[: len(sketched) // 2]).sum()) // IN_BUCKET

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketched = sent.value
        held: defaultdict[tuple[str, int], dict[bytes, int]] = defaultdict(dict)

        def set_(cell: np.ndarray) -> np.ndarray:
            return sketched[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8) & 1 > 0

        def frequent(h: np.ndarray) -> np.ndarray:
            upper, lower = (x.astype(np.int64) for x in _cells(h, bits))
            return set_(upper) & set_(lower + lower_row)

        def hold(langs: list[str], owner: np.ndarray, size: int, phrases: list[bytes], n: np.ndarray) -> None:
            for lang in np.unique(owner):
                own = held[langs[lang], size]
                some = np.flatnonzero((owner == lang) & (n > 0))
                for i, x in zip(some.tolist(), n[some].tolist()):
                    own[phrases[i]] = own.get(phrases[i], 0) + x

        def written() -> pa.RecordBatch:
            flat = [(xxhash.xxh64_intdigest(p) % buckets, lang, size, p, a) for (lang, size), own in held.items() for p, a in own.items()]
            held.clear()
            flat.sort(key=lambda x: x[0])
            bucket = np.array([x[0] for x in flat], np.int32)
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            offsets = pa.array(np.append(starts, len(flat)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array([x[k] for x in flat], kind)) for k, kind in ((1, pa.string()), (2, pa.int32()), (3, pa.binary()), (4, pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int32()), *lists], names=["bucket", "lang", "size", "phrase", "a"])

        for batch in batches:
            for part in blocks(batch, longest):
                v, words, langs = len(part.words), part.words, part.langs
                alive, number, raw = np.zeros(0, bool), part.lang, []  # number: of what stands before the last word
                owner = np.arange(len(langs))  # language of each number
                for size, (h, there) in enumerate(part.hashes(longest), 1):
                    if size == 1:
                        hold(langs, owner, 0, [b""] * len(langs), np.bincount(part.lang[there & part.fresh], minlength=len(langs)))
                        ends = np.flatnonzero(there)
                        key = number[ends] * v + part.word[ends]
                    else:
                        both = alive.copy()
                        both[1:] &= alive[:-1]
                        ends = np.flatnonzero(both & there)
                        key = number[ends - 1] * v + part.word[ends]
                    hit = frequent(h[ends])
                    ends, key = ends[hit], key[hit]
                    codes, distinct = pd.factorize(key)
                    first, last = np.divmod(distinct, v)
                    owner = owner[first]
                    raw = [words[b] for b in last.tolist()] if size == 1 else [raw[a] + b" " + words[b] for a, b in zip(first.tolist(), last.tolist())]
                    hold(langs, owner, size, raw, np.bincount(codes[part.fresh[ends]], minlength=len(distinct)))
                    alive, number = np.zeros(len(part.word), bool), np.zeros(len(part.word), np.int64)
                    alive[ends] = True
                    number[ends] = codes
                if sum(map(len, held.values())) >= HELD:
                    yield written()
        if held:
            yield written()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, defaultdict(int)

        def done() -> pa.RecordBatch:
            kept = [(*k, a) for k, a in total.items() if a >= least or k[1] == 0]
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[k].decode("utf-8", "surrogatepass") if k == 2 else x[k] for x in kept], kind) for k, kind in enumerate(kinds)], names=["lang", "size", "phrase", "a"])

        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != at:
                    if total:
                        yield done()
                    at, total = bucket, defaultdict(int)
                for lang, size, phrase, a in zip(*(batch.column(k)[i].as_py() for k in range(1, 5))):
                    total[lang, size, phrase] += a
        if total:
            yield done()

    lists = rows.mapInArrow(run, "bucket int, lang array<string>, size array<int>, phrase array<binary>, a array<long>")
    dealt = lists.repartition(shuffle_partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(added, "lang string, size int, phrase string, a long")


def cells_for(rows: DataFrame, least: int, longest: int) -> int:
    """Bits of a row of the sketch: about half of `least` n-grams a cell, at some 6 bytes a word."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, int(size * longest // 6 * 2 // least).bit_length()))


def scored(counts: DataFrame, subsumes: int = SUBSUMES) -> DataFrame:
    """counts: lang, size, phrase, a of all frequent n-grams, and the words of each language at size 0. lang, phrase, a, l, r, n and score of the
    candidates that no longer one drops."""
    frequent, words = counts.where("size > 0"), counts.where("size = 0").select("lang", F.col("a").alias("n"))
    candidates = frequent.where("size > 1")
    cut = candidates.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    left = frequent.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    both = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(words, "lang")
    wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    parts = F.expr("array(substring_index(phrase, ' ', size - 1), substring(phrase, instr(phrase, ' ') + 1))")
    longer = candidates.where("size > 2").select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < subsumes * F.col("a"), F.lit(True)))
    return kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, subsumes: int = SUBSUMES, best: int = BEST, bits: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases of 2 to `longest` words."""
    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    bits = bits or cells_for(rows, least, longest)
    counts = survivors(rows, sketch(rows, bits, least, longest), bits, longest, least)
    kept = scored(staged(counts, "phrase-counts"), subsumes)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    return kept.withColumn("rank", rank.cast("long")).where(F.col("rank") <= best).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, k, g, count(*) AS a
  FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) s(k) WHERE len(w) >= k))
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, g, a, k, c, array_to_string(string_split(g, ' ')[1:c], ' ') AS first, array_to_string(string_split(g, ' ')[c + 1:], ' ') AS rest
  FROM (SELECT lang, g, a, k, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scores AS (
  SELECT cuts.lang, cuts.g, cuts.a, cuts.c, x.a AS l, y.a AS r, n.n, 1000::HUGEINT * cuts.a * n.n // (x.a::HUGEINT * y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = first JOIN f y ON y.lang = cuts.lang AND y.g = rest JOIN n ON n.lang = cuts.lang),
low AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
held AS (
  SELECT DISTINCT s.lang, s.g FROM (
    SELECT lang, array_to_string(string_split(g, ' ')[i:i + m - 1], ' ') AS g, a
    FROM (SELECT lang, g, a, k, m, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 5) q(m) WHERE m < k)) s
  JOIN f ON f.lang = s.lang AND f.g = s.g AND 100 * s.a >= 100 * f.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score::BIGINT AS score
FROM low ANTI JOIN held USING (lang, g)
QUALIFY rank <= 2000
"""
