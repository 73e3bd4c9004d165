import gzip

from pyspark.sql import functions as F

from allelespan.plans import pipelines
from allelespan.sources import readers, writers


def test_fasta_round_trip(spark, tmp_path):
    path = tmp_path / "a.fa"
    path.write_text(">n1\tc:5-9+\tG1,G2\nAC\nGT\n>n2\n\n>n3\nTTT\n")
    got = readers.fasta(spark, str(path)).collect()
    assert [(r.header.split("\t")[0], r.seq) for r in got] == [("n1", "ACGT"), ("n2", ""), ("n3", "TTT")]
    a = readers.alleles(spark, str(path)).where("name = 'n1'")
    assert (a.first().contig, a.first().start, a.first().genes) == ("c", 5, ["G1", "G2"])
    writers.fasta(a, str(tmp_path / "out"))
    assert readers.alleles(spark, str(tmp_path / "out")).collect() == a.collect()


def test_fastq_gzip(spark, tmp_path):
    path = tmp_path / "a.fastq.gz"
    with gzip.open(path, "wt") as f:
        f.write("@r1\nACGT\n+\nIIII\n@r2\nGG\n+r2\nII\n")
    assert [(r.header, r.seq) for r in readers.sequences(spark, str(path)).collect()] == [("r1", "ACGT"), ("r2", "GG")]


def test_tables(spark, tmp_path):
    p = tmp_path / "g.gff3"
    p.write_text("##gff\nchr1\tx\tgene\t11\t20\t.\t+\t.\tID=1;gene_name=AB;gene_id=E1\n")
    r = readers.gff3(spark, str(p)).first()
    assert (r.chrom, r.start, r.end, r.gene_name, r.gene_id, r.exon_id) == ("chr1", 10, 20, "AB", "E1", None)
    p = tmp_path / "s.sam"
    p.write_text("@HD\nref\t0\tq\t7\t255\t5M\t*\t0\t0\tACGTA\t*\tAS:i:310\tPI:f:99.5\n")
    r = readers.sam_like(spark, str(p)).first()
    assert (r.qname, r.pos, r.mapq, r.cigar, r.score, r.identity) == ("q", 7, 255, "5M", 310, 99.5)
    p = tmp_path / "e.bed"
    p.write_text("#x\n@y\nc\t1\t2\n\tz\n")
    assert readers.error_bed(spark, str(p)).collect() == [("c", 1, 2)]
    p = tmp_path / "m.csv"
    p.write_text("1,2\n2,3\n")
    assert sorted(readers.norm_matrix(spark, str(p)).collect()) == [(0, 0, 1.0), (0, 1, 2.0), (1, 1, 3.0)]
    p = tmp_path / "params.json"
    p.write_text('{"a": 1,\n "b": ["x"]}')
    assert readers.params(spark, str(p)) == {"a": 1, "b": ["x"]}
    p = tmp_path / "genes.txt"
    p.write_text("A,B\nC\n")
    assert readers.gene_list(spark, str(p)).count() == 3
    p = tmp_path / "st.txt"
    p.write_text("# head\n\nq    1 AC-T 3\n      |\nr    1 ACGT 4\n\nq    4 GG 5\nr    5 GG 6\n")
    assert {r.name: r.row for r in readers.stretcher(spark, str(p)).collect()} == {"q": "AC-TGG", "r": "ACGTGG"}


def test_kmer_files(spark, tmp_path):
    df = spark.createDataFrame([("A", 2), ("C", 0)], "kmer string, cnt long")
    writers.kmer_counts(df, str(tmp_path / "c"))
    assert readers.kmer_list(spark, str(tmp_path / "c")).collect() == [("A", 2)]
    writers.kmer_counts(spark.createDataFrame([("A", 255, 900), ("C", 3, 3)], "kmer string, cnt long, n long"), str(tmp_path / "n"))
    assert "@targetsize\t903" in {r.value for r in spark.read.text(str(tmp_path / "n")).collect()}
    writers.kmer_sets(spark.createDataFrame([("A", True), ("C", False)], "kmer string, excluded boolean"), str(tmp_path / "k"))
    assert readers.kmer_list(spark, str(tmp_path / "k/include")).select("kmer").collect() == [("C",)]
    writers.hotspots(spark.createDataFrame([("t", "s", "c", 1, 2)], "target string, sample string, contig string, start int, end int"), str(tmp_path / "h"))
    assert (tmp_path / "h/target=t/sample=s").is_dir()


def test_manifest(spark, tmp_path):
    for s in "ab":
        (tmp_path / f"{s}.fa").write_text(f">x\n{s.upper()}C\n")
    (tmp_path / "list.txt").write_text("".join(f"{s}_h1\t{tmp_path}/{s}.fa\n" for s in "ab"))
    got = readers.manifested(spark, readers.manifest(spark, str(tmp_path / "list.txt")), readers.fasta)
    assert sorted((r.sample, r.seq) for r in got.collect()) == [("a_h1", "AC"), ("b_h1", "BC")]


def test_pipelines(spark):
    seqs = spark.createDataFrame([("a", "c", 0, 40, "+", "T" * 10 + "ACGGATCCATTGCA" + "T" * 16), ("b", "c", 50, 60, "+", "TTTTTTTTTT")], "name string, contig string, start long, end long, strand string, seq string")
    listed = spark.createDataFrame([("ACGGATCCATTGCA"[i : i + 5],) for i in range(10)], "kmer string")
    listed = listed.select(F.greatest("kmer", F.translate(F.reverse("kmer"), "ACGT", "TGCA")).alias("kmer"))
    kept, left = pipelines.trim_sequences(seqs, listed, k=5, cutoff=3, ratio=0.1, anchor=2)
    r = kept.first()
    assert kept.count() == 1 and "ACGGATCCATTGCA" in r.seq and len(r.seq) == r.end - r.start < 40 and left.count() == 10
    same, _ = pipelines.trim_sequences(seqs, listed, cutoff=0)
    assert same.count() == 2
    ins = seqs.select("name", "seq", (F.col("name") == "b").alias("excluded"))
    tg = seqs.where("name = 'a'").select(F.lit("t").alias("target"), "seq")
    assert set(pipelines.convert(2, ins, tg, k=5, c=3)) == {"counts", "hotspots"}
    assert pipelines.convert(3, ins, k=5)["kmers"].where("excluded").count() == 1
    assert pipelines.convert(4, ins, tg, k=5)["dual"].count() > 5
    al = spark.createDataFrame([("c", 100, 900, "+", "G", False), ("c", 40_000, 40_400, "-", "H", False)], "contig string, start long, end long, strand string, gene string, is_exon boolean")
    contigs = spark.createDataFrame([("c", "ACGT" * 20_000)], "contig string, seq string")
    loci = pipelines.allele_loci(al, contigs).collect()
    assert [(r.genes, len(r.seq) >= 8000) for r in loci] == [(["G"], True)]
