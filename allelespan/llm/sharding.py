"""Sharding by histogram sort (Kale and Krishnan 1993): shards of near equal bytes, in the order of a key.

The key of a row is three numbers: hash of its text, hash of its id, and a row number that is stored with the rows. Equal
texts stand together, so at most one group of copies is cut at each border.

Rounds: the key space is cut by probes into bins and the exact bytes and rows of each bin are counted (one pass, summed
on the map side; the driver sees bins, not rows). A bin is cut again, by probes between the smallest and largest key found
in it, if a target border lies in it and it holds more than `tolerance` of a shard, or if it holds more than its share of
rows. When all splitters are within tolerance each bin gets its shard and first slot, and the rows are exchanged once, by
bin. A hot group of copies is cut on the second number, so no task gets a whole one.

Law: `bytes`. Edge cases: a null text has no bytes (size is 16) and the checksum of the empty text; null ids hash as one.
Repeated rows differ in the third number. Fewer rows than shards leave shards empty; an empty table gives no rows. Extra
columns are carried; columns of the names that are added are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import shuffle_partitions, staged, table

SHARDS = 40
#: Of a shard's bytes.
TOLERANCE = 0.001
FIRST, LATER = 4096, 64
#: A bin of more than this share of all rows is cut again, so that the exchange is even.
SHARE = 1 / 1024
OVERHEAD = 16


def histogram_sort(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, tolerance: float = TOLERANCE, share: float = SHARE) -> DataFrame:
    """The rows with size, shard and slot (from 0 in each shard, in the order of the key)."""
    spark = df.sparkSession
    df = df.drop("size", "shard", "slot")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    keyed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), size.alias("size"), F.xxhash64(text).alias("_k0"), F.xxhash64(doc_id).alias("_k1"), F.monotonically_increasing_id().alias("_k2"))
    got = _sorted(staged(keyed, "shard-rows"), shards, tolerance, share, spark)
    return got.select("row.*", "size", "shard", "slot")


def _sorted(rows: DataFrame, shards: int, tolerance: float, share: float, spark: SparkSession) -> DataFrame:
    kept = [c for c in rows.columns if not c.startswith("_k")]
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("b"), F.min("_k0").alias("lo"), F.max("_k0").alias("hi")).first()
    if not total.n:
        return rows.select(*kept, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    targets = [total.b * j / shards for j in range(1, shards)]
    most_bytes, most_rows = max(1.0, tolerance * total.b / shards), max(1.0, share * total.n)
    # bins, in order: [path, rows, bytes, part of the key to cut by, its smallest and largest value in the bin]
    bins = [[(), total.n, total.b, 0, total.lo, total.hi]]
    binned, depth = rows, 0
    while True:
        open_, below = [], 0
        for b in bins:
            wanted = any(below < t < below + b[2] for t in targets) and b[2] > most_bytes
            if b[1] > 1 and (wanted or b[1] > most_rows) and b[3] < 3 and len(b[0]) == depth:
                open_.append(b)
            below += b[2]
        if not open_:
            break
        n = LATER if depth else FIRST
        probes = [(*b[0], b[3], b[4], float(b[5] - b[4] + 1)) for b in open_]
        on = [f"_b{i}" for i in range(depth)]
        if depth:
            cuts = spark.createDataFrame(probes, ", ".join([*(f"{c} int" for c in on), "_part int", "_lo long", "_w double"]))
            joined = binned.join(F.broadcast(cuts), on, "left")
        else:
            joined = binned.withColumns({c: F.lit(x) for c, x in zip(("_part", "_lo", "_w"), probes[0])})
        key = F.when(F.col("_part") == 0, F.col("_k0")).when(F.col("_part") == 1, F.col("_k1")).otherwise(F.col("_k2"))
        above = F.when(F.col("_w") < 2.0**62, (key - F.col("_lo")).cast("double")).otherwise(key.cast("double") - F.col("_lo").cast("double"))
        place = F.least(F.lit(n - 1), F.floor(above / F.col("_w") * n).cast("int"))
        binned = joined.withColumn(f"_b{depth}", F.when(F.col("_part").isNull(), F.lit(-1)).otherwise(F.greatest(F.lit(0), place))).withColumn(f"_open{depth}", F.col("_part").isNotNull()).drop("_part", "_lo", "_w")
        ends = [f(f"_k{i}").alias(f"{name}{i}") for i in range(3) for name, f in (("lo", F.min), ("hi", F.max))]
        path = [*on, f"_b{depth}"]
        counts = binned.where(f"_open{depth}").groupBy(*path).agg(F.count("*").alias("n"), F.sum("size").alias("b"), *ends).collect()
        made: dict[tuple, list] = {}
        for r in sorted(counts, key=lambda r: tuple(r[c] for c in path)):
            part = next((i for i in range(3) if r[f"lo{i}"] < r[f"hi{i}"]), 3)
            made.setdefault(tuple(r[c] for c in path[:-1]), []).append([tuple(r[c] for c in path), r.n, r.b, part, r[f"lo{min(part, 2)}"], r[f"hi{min(part, 2)}"]])
        cut = {b[0] for b in open_}
        bins = [x for b in bins for x in (made[b[0]] if b[0] in cut and len(b[0]) == depth else [b])]
        bins = [[(*b[0], -1), *b[1:]] if len(b[0]) == depth else b for b in bins]
        # a bin that was left alone ends its path with -1 and is never cut again
        bins = [b if b[0][-1] >= 0 else [b[0], b[1], b[2], 3, 0, 0] for b in bins]
        depth += 1
    # a border goes to the nearer side of the bin that a target falls into
    table_, below, first = [], 0, [0] * shards
    for i, b in enumerate(bins):
        shard = min(shards - 1, sum(t <= below + b[2] / 2 for t in targets))
        table_.append((*b[0], i, shard, first[shard]))
        first[shard] += b[1]
        below += b[2]
    path = [f"_b{i}" for i in range(depth)]
    if depth:
        dealt = binned.join(F.broadcast(spark.createDataFrame(table_, ", ".join([*(f"{c} int" for c in path), "_bin int", "shard int", "_first long"]))), path)
    else:
        dealt = binned.withColumns({"_bin": F.lit(0), "shard": F.lit(table_[0][1]), "_first": F.lit(0).cast("long")})
    order = Window.partitionBy("_bin").orderBy("_k0", "_k1", "_k2")
    dealt = dealt.select(*kept, "_k0", "_k1", "_k2", "_bin", "shard", "_first").repartition(shuffle_partitions(spark), "_bin")
    return dealt.withColumn("slot", F.col("_first") + F.row_number().over(order) - 1).select(*kept, "shard", "slot")


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long")
    compact = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), F.xxhash64("text").alias("_k0"), F.xxhash64("doc_id").alias("_k1"), F.monotonically_increasing_id().alias("_k2"))
    got = _sorted(staged(compact, "shard-rows"), SHARDS, TOLERANCE, SHARE, spark)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
