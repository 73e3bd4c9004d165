"""Column functions on sequences, loci and names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters to bases, for texts that stand in for sequences.
BRIDGE_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BRIDGE_TO = "ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC"

#: Gene families whose search pattern is not their name.
GENE_PATTERNS = {"C4": "C4[AB]", "PC": "PC;", "C2": "C2[;-]", "PACS": "PACS[12]", "MPI": "MPI;", "HBB": "HB[BD]", "GAL": "GAL;", "PLEK": "PLEK;", "LPA": "LPA[^R]", "HLA-D": "HLA-D[^a-zA-Z]*;", "TNKS": "TNKS;", "TNF": "TNF;", "CEL": "CEL;", "GK": "GK;", "GGN": "GGN;"}
DIGIT_SUFFIX = "[A-Z;.,-]"

LOCUS = r"^(.*):(-?\d+)-(\d+)([+-])$"


def bridge(text: str) -> Column:
    """A text as a sequence of ACGT."""
    return F.regexp_replace(F.translate(F.col(text), BRIDGE_FROM, BRIDGE_TO), "[^ACGT]", "")


def reverse_complement(seq: Column) -> Column:
    """Keeps case; what is not ACGT stays."""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def canonical(kmer: Column) -> Column:
    return F.greatest(kmer, reverse_complement(kmer))


#: Bases that are cut out together: places in a string cost time in proportion, so long sequences are cut twice.
CHUNK = 128


def kmers(df: DataFrame, seq: str, k: int, *keep: str) -> DataFrame:
    """A row for each k-mer of ACGT in either case: keep, pos (0-based start), kmer (canonical, upper case). The reverse complement
    is made once for each chunk, not for each k-mer."""
    long = df.where(F.length(seq) >= k).select(*keep, F.translate(seq, "acgt", "ACGT").alias("_seq"))
    cut = long.select(*keep, "_seq", F.explode(F.sequence(F.lit(0), F.length("_seq") - k, F.lit(CHUNK))).alias("_at"))
    cut = cut.select(*keep, "_at", F.substring("_seq", F.col("_at") + 1, F.lit(CHUNK + k - 1)).alias("_c"))
    cut = cut.select(*keep, "_at", "_c", reverse_complement(F.col("_c")).alias("_r"), F.col("_c").rlike("^[ACGT]*$").alias("_ok"))
    out = cut.select(*keep, "_at", "_c", "_r", "_ok", F.explode(F.sequence(F.lit(0), F.length("_c") - k)).alias("_i"))
    f, r = F.substring("_c", F.col("_i") + 1, F.lit(k)), F.substring("_r", F.length("_c") - k - F.col("_i") + 1, F.lit(k))
    out = out.select(*keep, (F.col("_at") + F.col("_i")).alias("pos"), "_ok", f.alias("_f"), r.alias("_g"))
    return out.where(F.col("_ok") | F.col("_f").rlike(f"^[ACGT]{{{k}}}$")).select(*keep, "pos", F.greatest("_f", "_g").alias("kmer"))


def encode2bit(kmer: Column) -> Column:
    """A=0, C=1, G=2, T=3 in either case, first base highest; null where a character is none of them. Up to 31 bases."""
    kmer = F.translate(kmer, "acgt", "ACGT")
    packed = F.aggregate(F.split(kmer, ""), F.lit(0).cast("long"), lambda a, c: F.when(c == "", a).otherwise(a * 4 + F.instr(F.lit("ACGT"), c) - 1))
    return F.when(kmer.rlike("^[ACGT]+$"), packed)


def decode2bit(code: Column, k: int = 31) -> Column:
    spots = F.sequence(F.lit(k - 1), F.lit(0), F.lit(-1))
    two = lambda i: F.call_function("shiftright", code, i * 2).bitwiseAND(F.lit(3))
    return F.array_join(F.transform(spots, lambda i: F.substring(F.lit("ACGT"), (two(i) + 1).cast("int"), F.lit(1))), "")


def binary_text(code: Column) -> Column:
    return F.bin(code)


def base64_code(code: Column) -> Column:
    """Digits 0-9a-zA-Z and two signs, lowest digit first; '0' for zero."""
    alphabet = F.lit("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+-")
    digits = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.substring(alphabet, (F.call_function("shiftrightunsigned", code, i * 6).bitwiseAND(F.lit(63)) + 1).cast("int"), F.lit(1)))
    text = F.regexp_replace(F.array_join(digits, ""), "0+$", "")
    return F.when(text == "", "0").otherwise(text)


def gc_count(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[^CG]", ""))


def gc_band(kmer: Column, low: float = 0.3, high: float = 0.7) -> Column:
    return (gc_count(kmer) > low * F.length(kmer)) & (gc_count(kmer) < high * F.length(kmer))


def _most(kmer: Column, n: int) -> Column:
    """The largest number of times that one n-mer stands in the k-mer, overlaps included."""
    parts = F.transform(F.sequence(F.lit(1), F.length(kmer) - n + 1), lambda i: F.substring(kmer, i, F.lit(n)))
    return F.array_max(F.transform(F.array_distinct(parts), lambda x: F.size(F.filter(parts, lambda y: y == x))))


def low_complexity(kmer: Column, dimers: int = 9, trimers: int = 6) -> Column:
    return (_most(kmer, 2) > dimers) | (_most(kmer, 3) > trimers)


def locus_part(locus: Column) -> dict[str, Column]:
    """contig, start (may be negative), end, strand of `contig:start-end±`."""
    part = lambda n: F.regexp_extract(locus, LOCUS, n)
    return {"contig": part(1), "start": part(2).try_cast("long"), "end": part(3).try_cast("long"), "strand": part(4)}


def trim_locus(start: Column, end: Column, strand: Column, left: Column, right: Column) -> tuple[Column, Column]:
    """Half-open locus of the part [left, right) of its sequence, which is read in the direction of the strand."""
    return F.when(strand == "-", end - right).otherwise(start + left), F.when(strand == "-", end - left).otherwise(start + right)


def haplotype(name: Column) -> Column:
    """SAMPLE_hN of SAMPLE#N#contig; references by their contig names."""
    parts = F.split(name, "#")
    return F.when(name.contains("NC_0609"), "CHM13_h1").when(F.size(parts) >= 3, F.concat(parts[0], F.lit("_h"), parts[1])).when(name.rlike("^(chr|NC_)"), "HG38_h1").otherwise(F.array_join(F.slice(F.split(name, "_"), 1, 2), "_"))


def sanitized(name: Column) -> Column:
    out = F.replace(name, F.lit("#"), F.lit("_h"))
    for a, b in ((":", "_"), ("-", "_"), (".", "v")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def pangenome_contig(sample: Column, contig: Column) -> Column:
    return F.concat(F.replace(sample, F.lit("_h"), F.lit("#")), F.lit("#"), contig)


def gff_attribute(attributes: Column, name: str) -> Column:
    found = F.regexp_extract(attributes, rf"(?:^|;)\s*{name}=([^;]*)", 1)
    return F.when(found != "", found)


def gene_pattern(gene: str) -> str:
    """Regular expression by which a gene family is found in gene_name attributes."""
    if gene in GENE_PATTERNS:
        gene = GENE_PATTERNS[gene]
        return gene + DIGIT_SUFFIX if gene[-1].isdigit() else gene
    return gene + DIGIT_SUFFIX if gene[-1:].isdigit() else gene


def n_ends(seq: Column) -> tuple[Column, Column]:
    """Lengths of the runs of N at the two ends."""
    return F.length(F.regexp_extract(seq, "^([Nn]*)", 1)), F.length(F.regexp_extract(seq, "([Nn]*)$", 1))


def unique_bases(seq: Column) -> Column:
    """Bases that are not masked, that is, in upper case."""
    return F.length(F.regexp_replace(seq, "[^A-Z]", ""))


def group_name(genes: Column, family: str) -> Column:
    """At most three names, those that hold the family's name first, joined for use in a file name."""
    names = F.array_sort(F.array_distinct(genes))
    own = F.filter(names, lambda g: g.contains(family))
    return F.replace(F.array_join(F.slice(F.concat(own, F.array_except(names, own)), 1, 3), "OOO"), F.lit("."), F.lit("v"))


def without_readthrough(genes: Column) -> Column:
    """Drops `A-B` where `A` is there too."""
    return F.filter(genes, lambda g: ~(g.contains("-") & F.array_contains(genes, F.split_part(g, F.lit("-"), F.lit(1)))))
