"""Annotation joins and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import scan


def majority(df: DataFrame, by: str, tag: str, exon: str, reference: str = "Ref") -> DataFrame:
    """by, tag (`reference` if any member has it, else the most frequent, the smallest of equals), exon (1 if any is)."""
    n = df.groupBy(by, tag).agg(F.count("*").alias("n"), F.max(exon).alias("exon"))
    best = F.max_by(tag, F.struct("n", F.expr(f"transform(split(`{tag}`, ''), c -> -ascii(c))").alias("o")))
    return n.groupBy(by).agg(F.when(F.bool_or(F.col(tag) == reference), reference).otherwise(best).alias(tag), F.max("exon").alias("exon"), F.sum("n").alias("n"))


def locus_genes(df: DataFrame, by: str, gene: str) -> DataFrame:
    """Distinct gene names, exon ids left out."""
    return df.groupBy(by).agg(F.sort_array(F.collect_set(F.when(~F.col(gene).startswith("ENSE"), F.col(gene)))).alias("genes"))


def gene_sizes(seqs: DataFrame, name: str = "name", seq: str = "seq") -> DataFrame:
    return seqs.groupBy(F.split(F.col(name), "_")[0].alias("gene")).agg(F.sum(F.length(seq)).alias("size"))


def uncertain(df: DataFrame, most: float = 0.1) -> DataFrame:
    """df: allele, haplo, ref, diff, n (row order in the file). Alleles whose name stands in two rows one after the other and, of assembled
    haplotypes (`_h`, `NC_0609`), those that share a (haplotype, reference), or differ by more than `most` where their pair is seen
    first. The row before is carried over sorted parts, so the file is never in one task."""
    parts = scan.dealt(df.select("allele", "haplo", "ref", "diff", "n").withColumn("_all", F.lit(0)), ["_all"], ["n", "allele"])
    rows = scan.running_max(parts, ["_all"], ["n", "allele"], {"before": F.struct("n", "allele")})
    pair = Window.partitionBy("haplo", "ref")
    same, seen = F.count("*").over(pair) > 1, F.row_number().over(pair.orderBy("n", "allele")) == 1
    assembled = rows.where(F.col("haplo").contains("_h") | F.col("haplo").contains("NC_0609"))
    shared = assembled.withColumns({"same": same, "seen": seen}).where(F.col("same") | (F.col("seen") & (F.col("diff") > most)))
    return rows.where(F.col("before.allele") == F.col("allele")).select("allele").union(shared.select("allele")).distinct()


def reference_loci(df: DataFrame, lifted: DataFrame | None = None) -> DataFrame:
    """df: name, ref, locus. Adds ref_locus: the locus of the matched reference, or the lifted one (name, lift) where there is one."""
    out = df.join(df.select(F.col("name").alias("ref"), F.col("locus").alias("ref_locus")), "ref", "left")
    if lifted is not None:
        out = out.join(lifted, "name", "left").withColumn("ref_locus", F.coalesce("lift", "ref_locus")).drop("lift")
    return out


def unmapped(alleles: DataFrame, mapped: DataFrame, key: str = "name") -> DataFrame:
    return alleles.join(mapped.select(key).distinct(), key, "left_anti")


def fetch(loci: DataFrame, contigs: DataFrame, flip: bool = True) -> DataFrame:
    """loci: name, contig, start, end, strand; contigs: contig, seq. Half-open, from 0; the minus strand is turned round."""
    start, end = F.greatest(F.lit(0), F.col("start")), F.col("end")
    part = F.substring(F.col("seq"), (start + 1).cast("int"), (end - start).cast("int"))
    turned = F.when(F.col("strand") == "-", S.reverse_complement(part)).otherwise(part) if flip else part
    return loci.join(contigs, "contig").withColumn("seq", turned)


def variant_bases(rows: DataFrame, queries: DataFrame, refs: DataFrame) -> DataFrame:
    """rows: allele, ref, kind (I from the query, D from the reference), start, end. unique: unmasked bases of the variant."""
    out = rows.join(queries.select(F.col("name").alias("allele"), F.col("seq").alias("q")), "allele", "left").join(refs.select(F.col("name").alias("ref"), F.col("seq").alias("r")), "ref", "left")
    part = F.substring(F.when(F.col("kind") == "D", F.col("r")).otherwise(F.col("q")), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return out.withColumn("unique", S.unique_bases(part)).drop("q", "r")


def zipped(a: DataFrame, b: DataFrame, place: str = "n") -> DataFrame:
    """Row i with row i, by a numbered column that both have."""
    return a.join(b, place, "full")


def summary(alleles: DataFrame, parts: list[DataFrame], key: str = "allele") -> DataFrame:
    """One row an allele, with the columns of each part (one row an allele each); all joins share the key's partitioning."""
    for p in parts:
        alleles = alleles.join(p, key, "left")
    return alleles


def not_named(name: Column, excluded: list[str]) -> Column:
    """No excluded text stands in the name."""
    out = F.lit(True)
    for x in excluded:
        out = out & ~name.contains(x)
    return out


def without_contigs(members: DataFrame, contigs: DataFrame) -> DataFrame:
    """members: contig, ...; type members on excluded contigs go."""
    return members.join(contigs.select("contig").distinct(), "contig", "left_anti")


def novel(df: DataFrame, tag: str = "tag") -> DataFrame:
    return df.where(F.col(tag).rlike(r"\bNovel\b"))


def large_enough(least: int = 500) -> Column:
    return F.col("end") - F.col("start") > least
