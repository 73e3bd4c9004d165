"""Base-level walks as arithmetic over runs, in columns of Spark's own functions, or of arrays for rows of an alignment.

An alignment is written out as one letter for each of its columns; runs of a letter come from one pattern match, and what is
added up is a row for each run, never one for each base in Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from allelespan.functions import cigar as C


def run_lengths(letters: Column, query: Column, takes: str, shown: str) -> Column:
    """letters: an operation for each column. CIGAR of its runs; operations in `takes` move along the query, and the query's bases stand
    behind those in `shown`."""
    runs = F.regexp_extract_all(letters, F.lit(r"((.)\2*)"), F.lit(1))
    zero = F.struct(F.lit(0).alias("q"), F.lit("").alias("out"))

    def add(at: Column, run: Column) -> Column:
        n, op = F.length(run), F.left(run, F.lit(1))
        bases = F.when(op.isin(*shown), F.substring(query, at["q"] + 1, n)).otherwise("")
        return F.struct((at["q"] + F.when(op.isin(*takes), n).otherwise(0)).alias("q"), F.concat(at["out"], n.cast("string"), op, bases).alias("out"))

    return F.aggregate(runs, zero, add)["out"]


def compared(a: Column, b: Column) -> Column:
    """= or X for each base of two texts of one length, whatever their case."""
    return F.array_join(F.zip_with(F.split(F.upper(a), ""), F.split(F.upper(b), ""), lambda x, y: F.when(x == y, "=").otherwise("X")), "")


def _gapped_cigar(query: str, ref: str) -> str:
    wide = not (query.isascii() and ref.isascii())
    code, kind = ("utf-32-le", np.uint32) if wide else ("ascii", np.uint8)
    (a, b), (x, y) = ([np.frombuffer(s.encode(code), kind) for s in pair] for pair in ((query, ref), (query.upper(), ref.upper())))
    n = min(len(a), len(b))
    if len(x) != len(a) or len(y) != len(b):  # a letter of several in upper case
        x, y = (np.array([c.upper() for c in s], object) for s in (query, ref))
    a, b, same = a[:n], b[:n], x[:n] == y[:n]
    gap, other = a == ord("-"), b == ord("-")
    op = np.where(gap, np.where(other, 0, ord("D")), np.where(other, ord("I"), np.where(same, ord("="), ord("X"))))
    op = op[op > 0].astype(np.uint8)
    if not len(op):
        return ""
    at = np.flatnonzero(np.diff(op, prepend=0))
    moved = np.concatenate(([0], np.cumsum(op != ord("D"))))  # query bases before each column
    size = np.diff(np.append(at, len(op)))
    bases = query.replace("-", "")
    return "".join([f"{n}{o}{bases[s:e]}" if o in "XI" else f"{n}{o}" for n, o, s, e in zip(size.tolist(), op[at].tobytes().decode(), moved[at].tolist(), moved[at + size].tolist())])


def from_gapped(query: Column, ref: Column) -> Column:
    """CIGAR of two rows of an alignment, query bases after X and I; I is what the query has more. Columns of two gaps go."""

    def made(query: pd.Series, ref: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else _gapped_cigar(a, b) for a, b in zip(query, ref)], dtype=object)

    return F.pandas_udf(made, "string")(query, ref)


def extended(cigar: Column, ref: Column, query: Column) -> Column:
    """M, = and X as runs of = and X, with the query's bases after X and D. cigar: lengths and operations only."""
    zero = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), F.lit("").alias("out"))

    def add(at: Column, t: Column) -> Column:
        n, op = t["len"], t["op"]
        same = op.isin("M", "=", "X")
        letters = F.when(same, compared(F.substring(ref, at["r"] + 1, n), F.substring(query, at["q"] + 1, n))).otherwise(F.repeat(op, n))
        return F.struct((at["q"] + F.when(same | (op == "D"), n).otherwise(0)).alias("q"), (at["r"] + F.when(same | (op == "I"), n).otherwise(0)).alias("r"), F.concat(at["out"], letters).alias("out"))

    return run_lengths(F.aggregate(C.tokens(cigar), zero, add)["out"], query, "=XD", "XD")


def gapped_places(row: Column) -> Column:
    """Place in the gapped row of each base, and of the end."""
    return F.array_append(F.array_compact(F.transform(F.split(row, ""), lambda c, i: F.when((c != "-") & (c != ""), i))), F.length(row))


def ungapped_places(row: Column) -> Column:
    """Number of bases before each place of the gapped row, and before the end."""
    runs = F.regexp_extract_all(row, F.lit("(-+|[^-]+)"), F.lit(1))
    zero = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def add(at: Column, run: Column) -> Column:
        n, gap = F.length(run), F.startswith(run, F.lit("-"))
        more = F.when(gap, F.array_repeat(at["n"], n)).otherwise(F.sequence(at["n"], at["n"] + n - 1))
        return F.struct((at["n"] + F.when(gap, 0).otherwise(n)).alias("n"), F.concat(at["out"], more).alias("out"))

    end = F.aggregate(runs, zero, add)
    return F.array_append(end["out"], end["n"])


def _bases(row: str) -> np.ndarray:
    code, kind = ("ascii", np.uint8) if row.isascii() else ("utf-32-le", np.uint32)
    return np.frombuffer(row.encode(code), kind) != ord("-")


def places_text(row: Column, gapped: bool) -> Column:
    """gapped_places(), else ungapped_places(), joined by commas, without an array of the places in Spark."""

    def made(row: pd.Series) -> pd.Series:
        places = lambda base: np.append(np.flatnonzero(base), len(base)) if gapped else np.concatenate(([0], np.cumsum(base)))
        return pd.Series([None if x is None else ",".join(map(str, places(_bases(x)).tolist())) for x in row], dtype=object)

    return F.pandas_udf(made, "string")(row)
