"""Importance resampling towards a target, with hashed n-gram features and an integer word dictionary.

Texts are read in blocks of up to BLOCK bytes, and a longer text is cut between words. In a block a dictionary numbers the
distinct words; an n-gram is a tuple of numbers, packed as (number of its prefix tuple, last word), so that tuples are told
apart exactly. The bytes of each distinct tuple are put together and hashed once, and the tuple's count, or its gain, is
joined back to the n-grams by its number. An n-gram belongs to the block in which its last word stands; the words before it
are carried over a cut.

First pass: counts of each bucket, summed in a task and then over tasks (`buckets` rows from each task). The gains of the
buckets, a fixed number, go to all tasks. Second pass: sum of gains, number of features and of words of each text. Texts are
never shuffled, and no dictionary outlives its block, so memory is bounded at every size.

Draw: the scores (five numbers a row) are dealt by range of (eligible, score, id), counted by part, and numbered from the sums
of the parts before; ranks need no task that has all rows. Rows equal in score and id are in the order of a stored row number.

Edge cases: null and empty texts have no features, and weight 0. A null id is hashed as empty text. Texts of under `least`
words get a score but are not drawn. Repeated rows each take part. An empty table gives no rows, an empty target counts
nothing. Extra columns are dropped; `keep` names those to carry, and those of the names that are added are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from allelespan.llm._common import cut_words, shuffle_partitions, staged, table

LONGEST = 3
BUCKETS = 10_000
LEAST = 20
SHARE = 5  # of a hundred
SEED = 42
BLOCK = 2_000_000

#: A-Z to a-z, and all of ASCII but letters and digits to a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class Block:
    """Words of texts or parts of texts, in order, each with its row; of the parts, the carried words are not new."""

    def __init__(self):
        self.words: list[bytes] = []
        self.parts: list[tuple[int, int, int]] = []  # row, words, carried words
        self.bytes = 0

    def add(self, row: int, carried: list[bytes], words: list[bytes], size: int) -> None:
        self.words += carried
        self.words += words
        self.parts.append((row, len(carried) + len(words), len(carried)))
        self.bytes += size

    def grams(self, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each length: buckets of the distinct tuples; of each n-gram the number of its tuple, and its row."""
        row, size, carried = (np.array(x, np.int64) for x in zip(*self.parts))
        part = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size)
        fresh, rows = place >= np.repeat(carried, size), np.repeat(row, size)
        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        word = np.fromiter(map(ids.__getitem__, self.words), np.int64, len(self.words))
        words = list(ids)
        tuples, raw = word, words
        for n in range(1, longest + 1):
            if n > 1:
                ends = np.flatnonzero(place >= n - 1)
                numbers, distinct = pd.factorize(tuples[ends - 1] * len(words) + word[ends])
                first, last = (x.tolist() for x in np.divmod(distinct, max(1, len(words))))
                made = (a + b" " + words[b] for a, b in zip(map(raw.__getitem__, first), last))
                raw = list(made) if n < longest else made
                tuples = np.zeros(len(word), np.int64)
                tuples[ends] = numbers
            else:
                ends = np.arange(len(word))
            hashed = np.fromiter(map(crc32, raw), np.int64) % buckets
            ends = ends[fresh[ends]]
            yield hashed, tuples[ends], rows[ends]


def blocks(texts: Iterator[str | None], longest: int) -> Iterator[Block]:
    """The texts in blocks; rows are numbered from 0."""
    block = Block()
    for row, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass").translate(WORDS)
        for carried, words, size in cut_words(raw, BLOCK, longest - 1):
            block.add(row, carried, words, size)
            if block.bytes >= BLOCK:
                yield block
                block = Block()
    if block.parts:
        yield block


def bucket_counts(df: DataFrame, text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: how often features fall into it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in blocks((t.as_py() for t in batch.column(0)), longest):
                for hashed, numbers, _ in block.grams(longest, buckets):
                    # counts of tuples; their sums by bucket are exact in doubles
                    n += np.bincount(hashed, np.bincount(numbers, minlength=len(hashed)), buckets).astype(np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], names=["bucket", "n"])

    return df.select(F.col(f"`{text}`")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in target and source, each count one more. Both: bucket, n."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, df in ((s, source), (t, target)):
        for r in df.collect():  # a row for each bucket at most
            counts[r.bucket] = r.n
    up, down = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((a + 1) * up / ((b + 1) * down))) for a, b in zip(t.tolist(), s.tolist())], np.int64)


def weighted(df: DataFrame, text: str, lot: Column, gain: np.ndarray, keep: list[str], longest: int = LONGEST) -> DataFrame:
    """keep, then n_words, n_features, weight and score (weight and a Gumbel number from the hash of lot) of each row."""
    added = ["n_words", "n_features", "weight", "score"]
    keep = [c for c in keep if c.lower() not in added]
    schema = T.StructType([*(df.schema[c] for c in keep), *(T.StructField(c, T.LongType()) for c in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            sums, counts = np.zeros(size), np.zeros((longest, size), np.int64)
            for block in blocks((t.as_py() for t in batch.column(0)), longest):
                low = block.parts[0][0]  # rows of a block lie side by side
                for k, (hashed, numbers, rows) in enumerate(block.grams(longest, len(gain))):
                    if len(rows):
                        own = np.bincount(rows - low)
                        counts[k, low : low + len(own)] += own
                        sums[low : low + len(own)] += np.bincount(rows - low, gain[hashed][numbers])
            weight = sums.astype(np.int64)
            h = [int(hashlib.sha256(x.as_py().encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) for x in batch.column(1)]
            score = weight + np.array([math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))) for x in h], np.int64)
            cols = [pa.array(x, pa.int64()) for x in (counts[0], counts.sum(axis=0), weight, score)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *cols], names=[*keep, *added])

    return df.select(F.col(f"`{text}`").alias("_text"), lot.alias("_lot"), *(F.col(f"`{c}`") for c in keep)).mapInArrow(run, schema)


def ranked(rows: DataFrame, eligible: Column, share: int, id_: str) -> DataFrame:
    """rows with rank: 1, 2, 3 ... by score descending and id ascending for the first share (of a hundred) of the eligible, else null."""
    spark = rows.sparkSession
    rows = staged(rows.withColumns({"_in": eligible, "_row": F.monotonically_increasing_id()}), "scores")
    n_eligible = rows.where("_in").count()
    order = [F.col("_in").desc(), F.col("score").desc(), F.col(f"`{id_}`").asc_nulls_last(), F.col("_row").asc()]
    parts = staged(rows.repartitionByRange(shuffle_partitions(spark), *order).withColumn("_part", F.spark_partition_id()), "score-parts")
    # a row for each part; the sum of those before it is its first place
    sizes = parts.groupBy("_part").count().orderBy("_part").collect()
    firsts = np.cumsum([0] + [r["count"] for r in sizes]).tolist()
    first = spark.createDataFrame([(r["_part"], x) for r, x in zip(sizes, firsts)], "_part int, _first long")
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_first")
    placed = parts.join(F.broadcast(first), "_part").withColumn("_at", at)
    drawn = F.col("_in") & (F.col("_at") <= share * n_eligible // 100)
    return placed.withColumn("rank", F.when(drawn, F.col("_at"))).drop("_in", "_row", "_part", "_first", "_at")


def resample(docs: DataFrame, target: DataFrame, id_: str = "doc_id", text: str = "text", target_text: str = "text", share: int = SHARE, least: int = LEAST, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """id, n_words, n_features, weight, score and rank (null where not drawn) of every row."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    lot = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_}`").cast("string"), F.lit("")))
    return ranked(weighted(docs, text, lot, gain, [id_], longest), F.col("n_words") >= least, share, id_)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = """
WITH RECURSIVE one AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)),
d AS (
  SELECT r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
b AS (
  SELECT list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
gd AS (SELECT r, array_to_string(w[i:i + k], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 1)) AS i FROM d, range(3) s(k) WHERE len(w) > k)),
gb AS (SELECT array_to_string(w[i:i + k], ' ') AS g FROM (SELECT w, k, unnest(range(1, len(w) - k + 1)) AS i FROM b, range(3) s(k) WHERE len(w) > k)),
crc AS (
  SELECT g, xor(4294967295, list_reduce(list_transform(range(strlen(g)), lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i + 1, 2) AS BIGINT)), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT))) % 10000 AS k
  FROM (SELECT DISTINCT g FROM (SELECT g FROM gd UNION ALL SELECT g FROM gb)), one),
s AS (SELECT k, count(*) AS n FROM gd JOIN crc USING (g) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM gb JOIN crc USING (g) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS v
  FROM s LEFT JOIN t USING (k)),
sums AS (SELECT r, sum(v) AS weight, count(*) AS n FROM gd JOIN crc USING (g) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5)::DOUBLE / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN sums USING (r)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, r) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN CAST(place AS BIGINT) END AS rank
FROM placed
"""
