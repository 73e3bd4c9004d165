"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.sources.staging import shared_dir, staged

__all__ = ["UPPER", "LOWER", "table", "ascii_lower", "shuffle_partitions", "free_name", "numbered", "cut_words", "shared_dir", "staged"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only, so that every engine agrees."""
    return F.translate(text, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with marks behind it where df has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, stored with a row number, so that rows with equal or null ids are told apart, and the number's column."""
    row = free_name(docs, "_row")
    return staged(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def cut_words(raw: bytes, size: int, carry: int) -> Iterator[tuple[list[bytes], list[bytes], int]]:
    """Words between spaces, in parts of about `size` bytes: the last `carry` words before the part, its own, its bytes. What is one
    word is never cut."""
    at, before = 0, []
    while at < len(raw):
        stop = len(raw) if len(raw) - at <= size else raw.find(b" ", at + size)
        stop = len(raw) if stop < 0 else stop
        words = raw[at:stop].split()
        if words:
            yield before, words, stop - at
            before = (before + words[-carry:])[-carry:] if carry else []
        at = stop
