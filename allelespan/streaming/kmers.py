"""K-mer counts over a stream of sequences. The blueprint has nothing that streams; these are the batch operators on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from allelespan.functions import seq as S


def target_counts(stream: DataFrame, targets: DataFrame, k: int = 31, cap: int = 255) -> DataFrame:
    """stream: name, seq; targets: target, kmer (a static table). Running count of each target k-mer, for a sink in complete or
    update mode. State is one row a target k-mer."""
    at = S.kmers(stream, "seq", k, "name")
    return at.join(targets, "kmer").groupBy("target", "kmer").agg(F.least(F.count("*"), F.lit(cap)).alias("cnt"))


def to_memory(df: DataFrame, name: str) -> StreamingQuery:
    return df.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
