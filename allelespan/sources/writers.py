"""Writers of the interchange formats (K1-K11). Text is made of columns and written by Spark; `partitionBy` takes the place of
one file for each sample or target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(df: DataFrame, value: Column, path: str, by: list[str] | None = None) -> None:
    out = df.select(*(by or []), value.alias("value")).write.mode("overwrite")
    (out.partitionBy(*by) if by else out).text(path)


def _tabbed(*cols: str) -> Column:
    return F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols))


def kmer_counts(df: DataFrame, path: str, size: int | None = None) -> None:
    """kmer, cnt above 0, after a line with the number of all occurrences: size, else the sum of n (counts that are not capped), else that
    of cnt."""
    size = size if size is not None else (df.agg(F.sum("n" if "n" in df.columns else "cnt")).first()[0] or 0)
    head = df.sparkSession.createDataFrame([(f"@targetsize\t{size}", 0)], "value string, o int")
    rows = df.where("cnt > 0").select(_tabbed("kmer", "cnt").alias("value"), F.lit(1).alias("o"))
    head.coalesce(1).union(rows).select("value").write.mode("overwrite").text(path)


def hotspots(df: DataFrame, path: str) -> None:
    _text(df, _tabbed("contig", "start", "end"), path, ["target", "sample"])


def kmer_sets(df: DataFrame, path: str) -> None:
    """kmer, excluded: two folders of `>` records."""
    for name, rows in (("include", df.where("NOT excluded")), ("exclude", df.where("excluded"))):
        _text(rows, F.concat(F.lit(">\n"), F.col("kmer")), f"{path}/{name}")


def dual_counts(df: DataFrame, path: str) -> None:
    _text(df.where("c1 NOT IN (0, 255)"), _tabbed("kmer", "c1", "c2"), path)


def fasta(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """name, contig, start, end, strand, genes, seq."""
    locus = F.concat(F.col("contig"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"), F.col("strand"))
    _text(df, F.concat(F.lit(">"), F.concat_ws("\t", "name", locus, F.array_join("genes", ",")), F.lit("\n"), F.col("seq")), path, by)


def fasta_by_sample(df: DataFrame, path: str) -> None:
    fasta(df, path, ["haplo"])


def fasta_by_group(df: DataFrame, kmers: DataFrame, path: str) -> None:
    """Sequences and exclusive k-mers of each group."""
    fasta(df, f"{path}/sequences", ["group_id"])
    _text(kmers, F.concat(F.lit(">\n"), F.col("kmer")), f"{path}/kmers", ["group_id"])


def trees(df: DataFrame, path: str, group: str) -> None:
    _text(df, F.col("newick"), path, [group])


def matrix(df: DataFrame, path: str) -> None:
    """Reordered matrix in long form: row, col, m."""
    df.sort("row", "col").write.mode("overwrite").csv(path, sep="\t")


def paf(df: DataFrame, path: str) -> None:
    _text(df, _tabbed("qname", "qlen", "qstart", "qend", "strand", "rname", "rlen", "rstart", "rend", "match", "alnlen", "mapq", "identity", "cigar"), path)


def linear_graph(chunks: DataFrame, alleles: DataFrame, path: str) -> None:
    """S lines: id, seq, place; L lines: name, path, cigar."""
    s = chunks.select(F.concat_ws("\t", F.lit("S"), "id", "seq", F.concat(F.lit("SN:i:"), F.col("place").cast("string")), F.concat(F.lit("LN:i:"), F.length("seq").cast("string"))).alias("value"))
    rows = alleles.select(F.concat_ws("\t", F.lit("L"), "name", F.lit("+"), "path", "cigar").alias("value"))
    s.union(rows).write.mode("overwrite").text(path)


def gathered(parts: list[DataFrame]) -> DataFrame:
    """Tables of samples as one."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
