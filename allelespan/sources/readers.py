"""Readers of the interchange formats (S1-S18). Compression is Spark's own; paths may be lists, folders or globs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions import seq as S

Paths = str | list[str]

BED6 = "chrom string, start long, end long, strand string, name string, gene string"
PAF14 = "qname string, qlen long, qstart long, qend long, strand string, rname string, rlen long, rstart long, rend long, match int, alnlen int, mapq int, identity double, cigar string"
GRAPH5 = "query string, path string, cigar string, ranges string, qranges string"
ANNOTATION7 = "name string, ref string, locus string, reflocus string, exon int, distance double, tag string"


def path_list(spark: SparkSession, paths: Paths = (), lists: Paths = ()) -> list[str]:
    """The files that paths name (of a folder its own files, not those of folders in it), then those that the lines of the list
    files name. Paths are few and are listed on the driver."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs.Path, []
    for name in [paths] if isinstance(paths, str) else paths:
        system = hadoop(name).getFileSystem(spark._jsc.hadoopConfiguration())
        if system.getFileStatus(hadoop(name)).isDirectory():
            out += sorted(x.getPath().toString() for x in system.listStatus(hadoop(name)) if x.isFile())
        else:
            out.append(name)
    for name in [lists] if isinstance(lists, str) else lists:
        out += [r.line for r in sorted(numbered_lines(spark, name).collect(), key=lambda r: (r.file, r.n)) if r.line]
    return out


def tsv(spark: SparkSession, paths: Paths, schema: str, comment: str | None = None) -> DataFrame:
    """Tab-separated without a header; columns by place, more than the schema has are left out."""
    reader = spark.read.schema(schema).options(sep="\t", quote="", mode="PERMISSIVE")
    return (reader.option("comment", comment) if comment else reader).csv(paths)


def fasta(spark: SparkSession, paths: Paths) -> DataFrame:
    """header, seq of each record; sequence lines are joined. A record must fit in memory, a file need not."""
    rows = spark.read.option("lineSep", "\n>").text(paths).where("value <> ''")
    record = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(record, r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace(record, r"^[^\n]*", ""), r"\s", "")
    return rows.select(head.alias("header"), seq.alias("seq")).where("header <> '' OR seq <> ''")


def alleles(spark: SparkSession, paths: Paths) -> DataFrame:
    """FASTA with `name<TAB>contig:start-end±<TAB>genes` headers."""
    parts = F.split("header", "\t")
    rows = fasta(spark, paths).select(parts[0].alias("name"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("locus"), F.split(F.coalesce(F.get(parts, F.lit(2)), F.lit("")), "[,;]").alias("genes"), "seq")
    locus = S.locus_part(F.col("locus"))
    return rows.select("name", *(c.alias(n) for n, c in locus.items()), F.filter("genes", lambda g: g != "").alias("genes"), "seq")


def fastq(spark: SparkSession, paths: Paths) -> DataFrame:
    """header, seq, quality. A record is split off at a line that starts with @ and has a + line two below; files with one record
    a line pair are split by Spark at record borders."""
    rows = spark.read.option("lineSep", "\n@").text(paths).where("value <> ''")
    # a quality line may start with @: such a piece has no + line of its own and belongs to no record here
    m = r"(?s)^@?([^\n]*)\n([^\n]*)\n\+[^\n]*(?:\n([^\n]*))?\s*$"
    found = rows.select(F.regexp_extract("value", m, 1).alias("header"), F.regexp_extract("value", m, 2).alias("seq"), F.regexp_extract("value", m, 3).alias("quality"))
    return found.where("seq <> ''").withColumn("seq", F.rtrim("seq"))


def sequences(spark: SparkSession, path: str) -> DataFrame:
    """FASTQ or FASTA by the file's name."""
    return fastq(spark, path).select("header", "seq") if any(x in path for x in (".fastq", ".fq")) else fasta(spark, path)


def gff3(spark: SparkSession, paths: Paths) -> DataFrame:
    rows = tsv(spark, paths, "chrom string, source string, type string, start long, end long, score string, strand string, phase string, attributes string", "#")
    names = {n: S.gff_attribute(F.col("attributes"), n) for n in ("gene_name", "gene_id", "exon_id")}
    return rows.withColumns(names).withColumn("start", F.col("start") - 1)  # half-open, from 0


def bed6(spark: SparkSession, paths: Paths) -> DataFrame:
    return tsv(spark, paths, BED6)


def paf(spark: SparkSession, paths: Paths) -> DataFrame:
    return tsv(spark, paths, PAF14)


def sam_like(spark: SparkSession, paths: Paths) -> DataFrame:
    """Rows of `-outfmt 17`: rname, flag, qname, pos, mapq, cigar, seq, score (AS:i:) and identity (PI:f:)."""
    rows = spark.read.text(paths).where("value <> '' AND NOT startswith(value, '@')")
    f = F.split("value", "\t")
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:([^\t]*)", 1)
    return rows.select(f[0].alias("rname"), f[1].cast("int").alias("flag"), f[2].alias("qname"), f[3].cast("long").alias("pos"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), F.get(f, F.lit(9)).alias("seq"), tag("AS:i").try_cast("int").alias("score"), tag("PI:f").try_cast("double").alias("identity"))


def kmer_list(spark: SparkSession, paths: Paths) -> DataFrame:
    """kmer and cnt (null in lists); lines that start with @ or > are left out."""
    f = F.split("value", r"\s+")
    return spark.read.text(paths).where("value <> '' AND NOT value RLIKE '^[@>]'").select(f[0].alias("kmer"), F.get(f, F.lit(1)).try_cast("long").alias("cnt"))


def fai(spark: SparkSession, paths: Paths) -> DataFrame:
    return tsv(spark, paths, "contig string, size long")


def error_bed(spark: SparkSession, paths: Paths) -> DataFrame:
    f = F.split("value", "\t")
    rows = spark.read.text(paths).where(r"value <> '' AND NOT value RLIKE '^[@#=\t ]'")
    return rows.select(f[0].alias("contig"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"))


def numbered_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """file, n (line number from 0), line. Files are read in blocks side by side: a block's lines have consecutive ids, and the
    driver adds up the blocks' numbers of lines (one row a block)."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    before: dict[str, int] = {}
    blocks = []
    for r in sorted(rows.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n")).collect(), key=lambda r: (r.file, r.block)):
        blocks.append((r.file, r.block, before.get(r.file, 0) - r.first))
        before[r.file] = before.get(r.file, 0) + r.n
    shift = F.broadcast(spark.createDataFrame(blocks, "file string, block long, shift long"))
    return rows.join(shift, ["file", "block"]).select("file", (F.col("id") + F.col("shift")).alias("n"), "line")


def norm_matrix(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Long form i, j, m (from 0) of a square text matrix in one file, upper triangle; rows are numbered by their place in it."""
    rows = numbered_lines(spark, path).where("line <> ''").select(F.col("n").cast("int").alias("i"), F.posexplode(F.split("line", delimiter)).alias("j", "m"))
    return rows.where("i <= j").select("i", "j", F.col("m").cast("double").alias("m"))


def newick(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.text(paths, wholetext=True).select(F.trim("value").alias("newick"))


def stretcher(spark: SparkSession, paths: Paths) -> DataFrame:
    """file, name, row: gapped rows of a pairwise alignment text, blocks joined in order."""
    lines = numbered_lines(spark, paths)
    m = r"^(\S+)\s+(?:\d+\s+)?([A-Za-z-]+)(?:\s+\d+)?\s*$"
    rows = lines.where(~F.col("line").startswith("#")).select("file", "n", F.regexp_extract("line", m, 1).alias("name"), F.regexp_extract("line", m, 2).alias("part")).where("part <> ''")
    got = rows.groupBy("file", "name").agg(F.sort_array(F.collect_list(F.struct("n", "part"))).alias("x"), F.min("n").alias("first"))
    return got.select("file", "name", "first", F.array_join(F.col("x.part"), "").alias("row"))


def manifest(spark: SparkSession, paths: Paths) -> DataFrame:
    return tsv(spark, paths, "sample string, path string")


def params(spark: SparkSession, path: str) -> dict:
    """A JSON object of parameters."""
    row = spark.read.option("multiLine", True).json(path).first()
    return row.asDict(recursive=True) if row else {}


def gene_list(spark: SparkSession, path: str) -> DataFrame:
    """Names separated by commas or lines."""
    return spark.read.text(path).select(F.explode(F.split("value", r"[,\s]+")).alias("gene")).where("gene <> ''").distinct()


def manifested(spark: SparkSession, found: DataFrame, read) -> DataFrame:
    """All files of a manifest in one table, with their sample; the paths are few and are listed on the driver."""
    rows = found.collect()
    by = F.create_map(*(F.lit(x) for r in rows for x in (r.path.rsplit("/", 1)[-1], r.sample)))
    return read(spark, [r.path for r in rows]).withColumn("sample", by[F.element_at(F.split(F.input_file_name(), "/"), -1)])


def graph_alignments(spark: SparkSession, paths: Paths) -> DataFrame:
    """Rows of a graph's paths; operators.graph.exploded turns them into steps."""
    return tsv(spark, paths, GRAPH5).withColumnRenamed("query", "allele")

