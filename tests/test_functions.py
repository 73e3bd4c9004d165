import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from allelespan.functions import cigar as C
from allelespan.functions import seq as S


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


def test_canonical_is_the_larger_strand(spark):
    assert one(spark, S.canonical(F.col("k")), k="ACG") == "CGT"


def test_kmers_do_not_span_other_letters(spark):
    df = spark.createDataFrame([("a", "ACGNACG"), ("b", "AC"), ("c", None)], "name string, seq string")
    assert [(r.name, r.pos) for r in S.kmers(df, "seq", 3, "name").collect()] == [("a", 0), ("a", 4)]


def test_masked_bases_count(spark):
    df = spark.createDataFrame([("a", "acgtACGTß"), ("b", "ACGTACGTN")], "name string, seq string")
    got = S.kmers(df, "seq", 4, "name").collect()
    assert [(r.pos, r.kmer) for r in got if r.name == "a"] == [(r.pos, r.kmer) for r in got if r.name == "b"] and len(got) == 10


def test_kmers_over_chunk_borders(spark):
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(1000))
    df = spark.createDataFrame([("a", seq)], "name string, seq string")
    flip = str.maketrans("ACGT", "TGCA")
    want = [(i, max(seq[i : i + 31], seq[i : i + 31][::-1].translate(flip))) for i in range(970)]
    assert sorted((r.pos, r.kmer) for r in S.kmers(df, "seq", 31).collect()) == want
    # the other strand has the same canonical k-mers
    other = spark.createDataFrame([("a", seq[::-1].translate(flip))], "name string, seq string")
    assert sorted(r.kmer for r in S.kmers(other, "seq", 31).collect()) == sorted(k for _, k in want)


def test_encoding_round_trip(spark):
    k = "ACGTTGCAACGTTGCAACGTTGCAACGTTGC"
    assert one(spark, S.decode2bit(S.encode2bit(F.col("k"))), k=k) == k
    assert one(spark, S.encode2bit(F.col("k")), k="ACN") is None and one(spark, S.encode2bit(F.col("k")), k="acGt") == 27
    assert one(spark, S.base64_code(F.lit(0).cast("long")), k="x") == "0"


def test_complexity_and_gc(spark):
    def low(k):
        return one(spark, S.low_complexity(F.col("k")), k=k)

    assert low("AC" * 10 + "GTGTCAGATCG") and not low("ACGTTGCAAGCTTAGGCATCCATGGATACAG")
    for n, kept in ((9, False), (10, True), (21, True), (22, False)):
        assert one(spark, S.gc_band(F.col("k")), k="G" * n + "A" * (31 - n)) is kept


def test_locus_parts_and_trim(spark):
    df = spark.createDataFrame([("c:x:-12-500-",)], "l string")
    assert tuple(df.select(*(c.alias(n) for n, c in S.locus_part(F.col("l")).items())).first()) == ("c:x", -12, 500, "-")
    a, b = S.trim_locus(F.lit(100), F.lit(200), F.lit("-"), F.lit(10), F.lit(30))
    assert tuple(df.select(a, b).first()) == (170, 190)


def test_names(spark):
    assert one(spark, S.haplotype(F.col("n")), n="HG002#1#chr1") == "HG002_h1"
    assert one(spark, S.haplotype(F.col("n")), n="NC_060925.1") == "CHM13_h1"
    assert one(spark, S.sanitized(F.col("n")), n="A#1:2-3.4") == "A_h1_2_3v4"
    assert one(spark, S.pangenome_contig(F.col("n"), F.lit("c1")), n="HG1_h2") == "HG1#2#c1"
    assert one(spark, S.gff_attribute(F.col("n"), "gene_name"), n="ID=x;gene_name=C4A;y=1") == "C4A"
    assert S.gene_pattern("C4") == "C4[AB]" and S.gene_pattern("AMY1") == "AMY1[A-Z;.,-]" and S.gene_pattern("ABC") == "ABC"
    assert one(spark, S.unique_bases(F.col("n")), n="acGTa") == 2
    assert one(spark, S.n_ends(F.col("n"))[0], n="NNACN") == 2
    names = F.split("n", ",")
    assert one(spark, S.group_name(names, "C4"), n="Z.1,XC4B,A,C4A") == "C4AOOOXC4BOOOA"
    assert one(spark, S.without_readthrough(names), n="A-B,A,C-D") == ["A", "C-D"]


def test_cigar_columns(spark):
    assert one(spark, C.length(F.col("c"), "MXI"), c="3H10M2I1X4D5M") == 18
    got = one(spark, C.lengths(F.col("c"), ref="MXI", clip="H", same="="), c="3H10M2XAC1I4D5M7=")
    assert (got.ref, got.clip, got.same) == (18, 3, 7)
    assert one(spark, C.length(F.col("c"), "M"), c="*") == one(spark, C.length(F.col("c"), "M"), c="") == 0
    assert one(spark, C.insert_kind(F.lit(49), F.lit(100)), c="x") == "Mutate"
    assert one(spark, C.insert_kind(F.lit(50), F.lit(100)), c="x") == "Novel(insert)"


def test_cigar_walks():
    assert C.extended("6M", "ACGTAC", "ACCTAC") == "2=1XC3="
    assert C.consistent("2=1XC3=", "ACGTAC", "ACCTAC") and not C.consistent("6=", "ACGTAC", "ACCTAC")
    assert C.clipped("10=5I10=", 5, 15) == (5, 20, "5=5I5=")
    assert C.clipped("10=5D10=", 12, 20) == (10, 15, "3D5=")
    assert C.clipped("10=", 20, 30) == (0, 0, "")
    assert C.from_gapped("AC-T", "ACG-") == "2=1D1IT"
    assert C.gapped_places("A-C") == [0, 2, 3] and C.ungapped_places("A-C") == [0, 1, 1, 2]
    assert C.spelled([("s", ">"), ("s", "<")], {"s": "AAC"}) == "AACGTT"


def test_segments_keep_good_stretches():
    got = C.segments("500=20X500=600D500=", 30, 100)
    assert [(a, b) for a, b, *_ in got] == [(0, 1020), (1620, 2120)] and C.segments("50=", 30, 300) == []


@settings(max_examples=60, deadline=None)
@given(st.text("ACGT", max_size=12), st.text("ACGT", max_size=12))
def test_alignment_is_best(a, b):
    x, y = C.align(a, b)
    assert x.replace("-", "") == a and y.replace("-", "") == b

    def score(x, y):
        total, run = 0, ""
        for p, q in zip(x, y):
            side = "x" if p == "-" else "y" if q == "-" else ""
            total += (5 if p == q else -4) if not side else (-4 if side == run else -16)
            run = side
        return total

    low = -(10**9)
    M = {(0, 0): (0, low, low)}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if (i, j) != (0, 0):
                d = max(M[i - 1, j - 1]) + (5 if a[i - 1] == b[j - 1] else -4) if i and j else low
                u = max(M[i - 1, j][0] - 16, M[i - 1, j][1] - 4, M[i - 1, j][2] - 16) if i else low
                v = max(M[i, j - 1][0] - 16, M[i, j - 1][1] - 16, M[i, j - 1][2] - 4) if j else low
                M[i, j] = (d, u, v)
    assert score(x, y) == max(M[len(a), len(b)])
