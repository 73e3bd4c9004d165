"""Queries that write an interchange format and read it back; their SQL says what must come back, from the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import cluster
from allelespan.plans import function_queries as N
from allelespan.plans import kmer_queries as Q
from allelespan.sources import readers, writers
from allelespan.sources.staging import scratch


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written(df: DataFrame, line: Column, name: str, head: str = "", one: bool = False, **options: str) -> str:
    """Text files with a line for each row, after one with `head`; a single file only where the format is one, or a file is what is listed."""
    path = scratch(df.sparkSession, name)
    rows = df.select(line.alias("value"))
    if head:
        rows = df.sparkSession.createDataFrame([(head,)], "value string").unionByName(rows)
    (rows.coalesce(1) if one else rows).write.options(**options).text(path)
    return path


_T = N._text


def _alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("item_id")
    return _read(spark, sf_dir, "benchmark").select(_T("a", n).alias("name"), _T("c:", n % 5).alias("contig"), (n * 3 - 7).alias("start"), (n * 3 + 50).alias("end"), N._strand(n).alias("strand"), F.array(_T("G", n % 4), _T("H", n % 3)).alias("genes"), S.bridge("text").alias("seq"), _T("h", n % 6).alias("haplo"), (n % 3).alias("group_id"))


def fasta_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "fasta")
    writers.fasta(_alleles(spark, sf_dir), path)
    return readers.alleles(spark, path).withColumn("genes", F.array_join("genes", ","))


def fasta_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences over several lines, found again by their headers."""
    rows = _read(spark, sf_dir, "benchmark").select("item_id", S.bridge("text").alias("seq"))
    path = _written(rows, _T(">c", F.col("item_id"), " x\n", F.regexp_replace("seq", "(.{60})", "$1\n")), "contigs")
    return readers.fasta(spark, path)


def fasta_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "samples")
    writers.fasta_by_sample(_alleles(spark, sf_dir), path)
    heads = spark.read.text(path).where("startswith(value, '>')")
    return heads.select("haplo", F.split(F.expr("substring(value, 2)"), "\t")[0].alias("name"))


def fasta_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = scratch(spark, "groups"), _alleles(spark, sf_dir)
    kmers = S.kmers(rows, "seq", Q.LEN, "group_id").select("group_id", "kmer").distinct()
    writers.fasta_by_group(rows, kmers, path)
    lines = lambda part: spark.read.text(f"{path}/{part}").where("value <> '>'")
    names = lines("sequences").where("startswith(value, '>')").groupBy("group_id").agg(F.count("*").alias("n_sequences"))
    return names.join(lines("kmers").groupBy("group_id").agg(F.count("*").alias("n_kmers")), "group_id").select(F.col("group_id").cast("long").alias("group_id"), "n_sequences", "n_kmers")


def fastq_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "benchmark").select("item_id", S.bridge("text").alias("seq"))
    path = _written(rows, _T("@r", F.col("item_id"), "\n", F.col("seq"), "\n+\n", F.translate("seq", "ACGT", "@I+#")), "reads.fastq", compression="gzip")
    return readers.sequences(spark, path)


def kmer_count_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "counts")
    counted = Q.K.counts(Q.item_kmers(spark, sf_dir), cap=None).select("kmer", F.least("cnt", F.lit(255)).alias("cnt"), F.col("cnt").alias("n"))
    writers.kmer_counts(counted, path)
    return readers.kmer_list(spark, path)


def hotspot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    path = scratch(spark, "hotspots")
    writers.hotspots(_read(spark, sf_dir, "events").select(_T("t", n % 3).alias("target"), _T("s", n % 4).alias("sample"), _T("c", F.col("user_id")).alias("contig"), n.alias("start"), (n * 2).alias("end")), path)
    return readers.tsv(spark, path, "contig string, start long, end long")


def kmer_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sets")
    rows = Q.item_kmers(spark, sf_dir)
    writers.kmer_sets(Q.K.set_filter(rows.where("target % 2 = 0"), rows.where("target % 2 = 1")), path)
    part = lambda name: readers.kmer_list(spark, f"{path}/{name}").select("kmer", F.lit(name).alias("part"))
    return part("include").unionByName(part("exclude"))


def dual_count_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "dual")
    rows = _read(spark, sf_dir, "part").select(_T("K", F.col("p_partkey")).alias("kmer"), (F.col("p_partkey") % 256).alias("c1"), (F.col("p_partkey") * 40).alias("c2"))
    writers.dual_counts(rows, path)
    return readers.tsv(spark, path, "kmer string, c1 int, c2 int")


def tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of each region's nations: its text is written, read and parsed again."""
    rows = _read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n_name")).alias("x"))
    path = scratch(spark, "trees")
    writers.trees(rows.select("n_regionkey", _T("(", F.array_join(F.transform("x", lambda s: F.concat(s, F.lit(":1.5"))), ","), ");").alias("newick")), path, "n_regionkey")

    def leaves(text):
        return text.map(lambda t: ",".join(x.name for x in cluster.parse_newick(t).leaves()))

    return readers.newick(spark, path).select(F.pandas_udf(leaves, "string", F.PandasUDFType.SCALAR)("newick").alias("leaves"))


def matrix_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    value = lambda i: _T((n + 1) * (i + 1) * F.lit(0.5))
    rows = _read(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions(n)
    return readers.norm_matrix(spark, _written(rows, F.concat_ws(",", *(value(i) for i in range(25))), "matrix.csv", one=True))


def matrix_long_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "matrix")
    writers.matrix(_read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("row"), F.col("n_nationkey").alias("col"), (F.col("n_nationkey") * 0.25).alias("m")), path)
    return readers.tsv(spark, path, "row int, col int, m double")


def _paf(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_partkey")
    rows = _read(spark, sf_dir, "lineitem")
    return rows.select(_T("q", F.col("l_orderkey")).alias("qname"), (p + 100).alias("qlen"), p.alias("qstart"), (p + 50).alias("qend"), N._strand(p).alias("strand"), _T("r", F.col("l_suppkey")).alias("rname"), (p + 900).alias("rlen"), (p + 1).alias("rstart"), (p + 51).alias("rend"), (p % 50).cast("int").alias("match"), F.lit(50).alias("alnlen"), F.lit(255).alias("mapq"), (90 + F.col("l_quantity") / 8).alias("identity"), _T(p % 50, "=", 50 - p % 50, "X").alias("cigar"))


def paf_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "paf")
    writers.paf(_paf(spark, sf_dir), path)
    return readers.paf(spark, path)


def sam_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_partkey")
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    line = F.concat_ws("\t", _T("r", F.col("l_suppkey")), (p % 2 * 16).cast("string"), _T("q", F.col("l_orderkey")), p.cast("string"), F.lit("255"), _T(p % 40 + 1, "M"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("*"), _T("AS:i:", p % 700), _T("PI:f:", p % 200 * F.lit(0.5)))
    return readers.sam_like(spark, _written(rows, line, "sam", "@HD\tVN:1.2")).drop("seq")


def gff_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    attributes = _T("ID=", n, ";gene_id=G", n % 7, ";gene_name=", F.col("event_type"), F.when(n % 2 == 0, _T(";exon_id=ENSE", n)).otherwise(""))
    line = F.concat_ws("\t", _T("chr", F.col("user_id") % 22), F.lit("x"), F.when(n % 2 == 0, "exon").otherwise("gene"), (n + 1).cast("string"), (n + 90).cast("string"), F.lit("."), N._strand(n), F.lit("."), attributes)
    return readers.gff3(spark, _written(_read(spark, sf_dir, "events"), line, "gff3", "##gff-version 3")).select("chrom", "type", "start", "end", "strand", "gene_name", "gene_id", "exon_id")


def bed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    line = F.concat_ws("\t", _T("c", F.col("user_id")), n.cast("string"), (n + 9).cast("string"), N._strand(n), _T("n", n), F.col("event_type"), F.lit("more"))
    return readers.bed6(spark, _written(_read(spark, sf_dir, "events"), line, "bed"))


def contig_size_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return readers.fai(spark, _written(_read(spark, sf_dir, "supplier"), F.concat_ws("\t", F.col("s_name"), (k * 1000 + 7).cast("string"), F.lit("52"), F.lit("60")), "fai"))


def error_region_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    mark = F.element_at(F.array(*(F.lit(x) for x in ("", "@", "#", "=", "\t", " "))), (k % 6 + 1).cast("int"))
    return readers.error_bed(spark, _written(_read(spark, sf_dir, "supplier"), F.concat(mark, F.concat_ws("\t", F.col("s_name"), k.cast("string"), (k + 9).cast("string"))), "errors"))


def gapped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment text in two blocks for each nation."""
    name = lambda x: _T(x, F.col("n_nationkey"))
    rows = _read(spark, sf_dir, "nation")
    text = F.concat(F.lit("# head\n"), name("q"), F.lit("     1 AC-T 3\n        |\n"), name("r"), F.lit("     1 ACGT 4\n\n"), name("q"), F.lit("     4 GG"), F.repeat(F.lit("A"), F.col("n_nationkey")), F.lit(" 9\n"), name("r"), F.lit("     5 G-\n"))
    return readers.stretcher(spark, _written(rows, text, "stretcher")).select("name", "row")


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FASTA files found through a folder, a list file and a manifest, which gives their samples."""
    rows = _alleles(spark, sf_dir)
    folders = [_written(rows.where(F.col("group_id") == g), _T(">", F.col("name"), "\n", F.col("seq")), f"part{g}", one=True) for g in range(3)]
    files = [[x for x in readers.path_list(spark, f) if x.rsplit("/", 1)[-1].startswith("part-")] for f in folders]
    lines = spark.createDataFrame([(x,) for x in files[1] + files[2]], "value string")
    listed = readers.path_list(spark, files[0], _written(lines, F.col("value"), "list"))
    samples = spark.createDataFrame([(f"s{i}\t{x}",) for i, x in enumerate(listed)], "value string")
    found = readers.manifested(spark, readers.manifest(spark, _written(samples, F.col("value"), "manifest")), readers.fasta)
    return found.select("sample", F.col("header").alias("name"))


def gene_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.collect_list("n_name"), ",").alias("x"))
    path = _written(rows, F.col("x"), "genes")
    given = readers.params(spark, _written(rows.agg(F.max("n_regionkey").alias("m")), _T('{"most": ', F.col("m"), ',\n "tag": "x"}'), "params"))
    return readers.gene_list(spark, path).select("gene", F.lit(given["most"]).cast("long").alias("most"), F.lit(given["tag"]).alias("tag"))


def linear_graph_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    chunks = _read(spark, sf_dir, "nation").select(_T("s", n).alias("id"), F.repeat(F.lit("AC"), n + 1).alias("seq"), (n * 2).alias("place"))
    alleles = _read(spark, sf_dir, "region").select(F.col("r_name").alias("name"), _T(">s", F.col("r_regionkey"), "<s", F.col("r_regionkey") + 1).alias("path"), _T(F.col("r_regionkey") + 5, "=").alias("cigar"))
    path = scratch(spark, "linear")
    writers.linear_graph(chunks, alleles, path)
    f = F.split("value", "\t")
    return spark.read.text(path).select(f[0].alias("type"), f[1].alias("name"), f[2].alias("x"), f[3].alias("y"), f[4].alias("z"))


def graph_alignment_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), _T(">a", p, "<b", p), F.lit("9="), _T(p, "_", p + 9, ";", p, "_", p + 3), F.lit("0_9;9_12"))
    got = readers.graph_alignments(spark, _written(_read(spark, sf_dir, "part"), line, "gaf"))
    return N.graph.exploded(got)


def gathered_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _paf(spark, sf_dir).select("qname", "rname", "match")
    return writers.gathered([rows.where(F.col("match") % 3 == i) for i in range(3)])


STRAND = "CASE WHEN {0} % 3 = 0 THEN '-' ELSE '+' END"
PAF_SQL = f"""SELECT 'q' || l_orderkey AS qname, l_partkey + 100 AS qlen, l_partkey AS qstart, l_partkey + 50 AS qend, {STRAND.format("l_partkey")} AS strand, 'r' || l_suppkey AS rname, l_partkey + 900 AS rlen, l_partkey + 1 AS rstart, l_partkey + 51 AS rend,
CAST(l_partkey % 50 AS INTEGER) AS match, 50 AS alnlen, 255 AS mapq, 90 + l_quantity / 8 AS identity, l_partkey % 50 || '=' || 50 - l_partkey % 50 || 'X' AS cigar FROM lineitem"""

QUERIES = {
    "fasta_alleles": (fasta_alleles, f"""SELECT 'a' || item_id AS name, 'c:' || item_id % 5 AS contig, item_id * 3 - 7 AS start, item_id * 3 + 50 AS "end", {STRAND.format("item_id")} AS strand, 'G' || item_id % 4 || ',H' || item_id % 3 AS genes, {N.BRIDGED} AS seq FROM benchmark"""),
    "fasta_contigs": (fasta_contigs, f"SELECT 'c' || item_id || ' x' AS header, {N.BRIDGED} AS seq FROM benchmark"),
    "fasta_samples": (fasta_samples, "SELECT 'h' || item_id % 6 AS haplo, 'a' || item_id AS name FROM benchmark"),
    "fasta_groups": (fasta_groups, f"WITH b AS ({Q.ITEMS}) SELECT group_id, n_sequences, n_kmers FROM (SELECT item_id % 3 AS group_id, count(*) AS n_sequences FROM benchmark GROUP BY 1) JOIN (SELECT item_id % 3 AS group_id, count(DISTINCT kmer) AS n_kmers FROM b GROUP BY 1) USING (group_id)"),
    "fastq_reads": (fastq_reads, f"SELECT 'r' || item_id AS header, {N.BRIDGED} AS seq FROM benchmark"),
    "kmer_count_file": (kmer_count_file, f"WITH b AS ({Q.ITEMS}) SELECT kmer, least(count(*), 255) AS cnt FROM b GROUP BY 1"),
    "hotspot_files": (hotspot_files, """SELECT 't' || event_id % 3 AS target, 's' || event_id % 4 AS sample, 'c' || user_id AS contig, event_id AS start, event_id * 2 AS "end" FROM events"""),
    "kmer_set_files": (kmer_set_files, f"WITH b AS ({Q.ITEMS}) SELECT DISTINCT kmer, CASE WHEN kmer IN (SELECT kmer FROM b WHERE item_id % 2 = 1) THEN 'exclude' ELSE 'include' END AS part FROM b WHERE item_id % 2 = 0"),
    "dual_count_file": (dual_count_file, "SELECT 'K' || p_partkey AS kmer, CAST(p_partkey % 256 AS INTEGER) AS c1, CAST(p_partkey * 40 AS INTEGER) AS c2 FROM part WHERE p_partkey % 256 NOT IN (0, 255)"),
    "tree_files": (tree_files, "SELECT string_agg(n_name, ',' ORDER BY n_name) AS leaves FROM nation GROUP BY n_regionkey"),
    "matrix_file": (matrix_file, "SELECT CAST(a.n_nationkey AS INTEGER) AS i, CAST(b.n_nationkey AS INTEGER) AS j, (a.n_nationkey + 1) * (b.n_nationkey + 1) * CAST(0.5 AS DOUBLE) AS m FROM nation a JOIN nation b ON a.n_nationkey <= b.n_nationkey"),
    "matrix_long_file": (matrix_long_file, "SELECT n_regionkey AS row, n_nationkey AS col, n_nationkey * CAST(0.25 AS DOUBLE) AS m FROM nation"),
    "paf_file": (paf_file, PAF_SQL),
    "sam_file": (sam_file, "SELECT 'r' || l_suppkey AS rname, CAST(l_partkey % 2 * 16 AS INTEGER) AS flag, 'q' || l_orderkey AS qname, l_partkey AS pos, 255 AS mapq, l_partkey % 40 + 1 || 'M' AS cigar, CAST(l_partkey % 700 AS INTEGER) AS score, l_partkey % 200 * CAST(0.5 AS DOUBLE) AS identity FROM lineitem"),
    "gff_file": (gff_file, f"""SELECT 'chr' || user_id % 22 AS chrom, CASE WHEN event_id % 2 = 0 THEN 'exon' ELSE 'gene' END AS type, event_id AS start, event_id + 90 AS "end", {STRAND.format("event_id")} AS strand, event_type AS gene_name, 'G' || event_id % 7 AS gene_id, CASE WHEN event_id % 2 = 0 THEN 'ENSE' || event_id END AS exon_id FROM events"""),
    "bed_file": (bed_file, f"""SELECT 'c' || user_id AS chrom, event_id AS start, event_id + 9 AS "end", {STRAND.format("event_id")} AS strand, 'n' || event_id AS name, event_type AS gene FROM events"""),
    "contig_size_file": (contig_size_file, "SELECT s_name AS contig, s_suppkey * 1000 + 7 AS size FROM supplier"),
    "error_region_file": (error_region_file, """SELECT s_name AS contig, s_suppkey AS start, s_suppkey + 9 AS "end" FROM supplier WHERE s_suppkey % 6 = 0"""),
    "gapped_rows": (gapped_rows, """SELECT 'q' || n_nationkey AS name, 'AC-TGG' || repeat('A', n_nationkey) AS row FROM nation UNION ALL SELECT 'r' || n_nationkey, 'ACGTG-' FROM nation"""),
    "listed_files": (listed_files, "SELECT 's' || item_id % 3 AS sample, 'a' || item_id AS name FROM benchmark"),
    "gene_list_file": (gene_list_file, "SELECT DISTINCT n_name AS gene, CAST((SELECT max(n_regionkey) FROM nation) AS BIGINT) AS most, 'x' AS tag FROM nation"),
    "linear_graph_file": (linear_graph_file, "SELECT 'S' AS type, 's' || n_nationkey AS name, repeat('AC', n_nationkey + 1) AS x, 'SN:i:' || n_nationkey * 2 AS y, 'LN:i:' || n_nationkey * 2 + 2 AS z FROM nation UNION ALL SELECT 'L', r_name, '+', '>s' || r_regionkey || '<s' || r_regionkey + 1, r_regionkey + 5 || '=' FROM region"),
    "graph_alignment_file": (graph_alignment_file, """SELECT CAST(p_partkey AS VARCHAR) AS allele, 0 AS place, 'a' || p_partkey AS segment, '>' AS strand, p_partkey AS start, p_partkey + 9 AS "end" FROM part UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, 'b' || p_partkey, '<', p_partkey, p_partkey + 3 FROM part"""),
    "gathered_parts": (gathered_parts, f"SELECT qname, rname, match FROM ({PAF_SQL})"),
}
