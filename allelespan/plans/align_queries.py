"""Alignment queries over lineitem, whose keys give each row a CIGAR string, an allele, a haplotype and a reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions import cigar as C
from allelespan.functions import runs
from allelespan.operators import annotate, graph
from allelespan.plans import function_queries as N
from allelespan.plans import kmer_queries as Q


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"), "l_discount", "l_returnflag")
    text = lambda n, op: F.concat(n.cast("string"), F.lit(op))
    cigar = F.concat(text(F.col("l_suppkey") % 9 + 1, "H"), text(F.col("q") * 10, "="), text(F.col("l_linenumber"), "X"), text(F.col("l_partkey") % 41 + 1, "I"), text(F.col("q") * 7 + 40, "="), text(F.col("l_partkey") % 23 + 1, "D"), text(F.col("q") * 5, "="))
    return li.withColumns({"allele": F.concat_ws("_", "l_orderkey", "l_linenumber"), "cigar": cigar})


def cigar_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cigar")
    got = rows(spark, sf_dir).select("allele", C.lengths(c, ref_len="=MXI", query_len="=MXD", clip="H", inserted="I").alias("n")).select("allele", "n.*")
    return got.withColumn("kind", C.insert_kind(F.col("inserted"), F.col("query_len") / 10))


def paf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("cigar")
    # lengths come out of a generator, so that the filter below does not cut and sum each CIGAR once for every use
    got = rows(spark, sf_dir).select("allele", "l_partkey", (100 - F.col("l_linenumber") * 2).alias("identity"), F.inline(F.array(C.lengths(c, match="=", ref_len="=MXI"))))
    got = got.select("allele", "identity", "match", (F.col("ref_len") - F.col("l_partkey") % 200).alias("unmasked"), (F.col("ref_len") * 2).alias("rlen"))
    return got.where(C.paf_filter()).select("allele", "match")


def uncertain_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_suppkey")
    name = F.concat_ws("_", "l_orderkey", (F.col("l_linenumber") / 2).cast("int"))
    haplo = F.concat(F.when(n % 3 == 0, "HG_h").when(n % 3 == 1, "NC_0609").otherwise("chr"), n.cast("string"))
    got = rows(spark, sf_dir).select(name.alias("allele"), haplo.alias("haplo"), F.col("l_partkey").alias("ref"), F.col("l_discount").alias("diff"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"))
    return annotate.uncertain(got, 0.08)


def alignment_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.explode(C.segments_udf(30, 100)("cigar"))
    return rows(spark, sf_dir).select("allele", s.alias("s")).select("allele", "s.qstart", "s.qend", "s.rstart", "s.rend", "s.peak", "s.cigar")


def graph_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as alleles: each line aligns its part to the order, the discount gives the score."""
    c = F.col("cigar")
    got = rows(spark, sf_dir).select(F.col("l_orderkey").alias("allele"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("id"), F.col("l_partkey").cast("string").alias("segment"), F.when(F.col("l_returnflag") == "R", "-").otherwise("+").alias("strand"), (F.col("l_partkey") % 500).alias("start"), (F.col("l_partkey") % 500 + C.length(c, "=MXD")).alias("end"), F.col("l_suppkey").alias("rstart"), "cigar", F.round(F.col("l_discount") * 100).cast("long").alias("score"))
    places = F.transform("steps", lambda s: F.concat_ws("_", s["rstart"].cast("string"), s["rend"].cast("string"), s["cigar"]))
    return graph.paths(got).select("allele", "path", F.size("steps").alias("n_steps"), F.md5(F.array_join(places, ";")).alias("places"))


def cigar_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_partkey") % 400
    got = rows(spark, sf_dir).select("allele", C.clipped_udf("cigar", start, start + 150).alias("c"))
    return got.select("allele", "c.start", "c.end", "c.cigar")


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with gaps for GA in one row and for the first of CC in the other."""
    seqs = Q.documents(spark, sf_dir).where(F.length("seq") > 0)
    return seqs.select("doc_id", F.regexp_replace("seq", "GA", "--").alias("q"), F.regexp_replace("seq", "CC", "-T").alias("r"))


def gapped_cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir).select("doc_id", F.md5(runs.from_gapped(F.col("q"), F.col("r"))).alias("cigar"))


def gapped_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir).select("doc_id", F.md5(runs.places_text(F.col("q"), True)).alias("gapped"), F.md5(runs.places_text(F.col("q"), False)).alias("ungapped"))


def extended_cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as queries of references with CA for CC, without four bases after a third, and with three more at the end."""
    n, third = F.length("seq"), F.floor(F.length("seq") / 3)
    seqs = Q.documents(spark, sf_dir).where(n >= 12).select("doc_id", "seq", n.alias("n"), third.cast("int").alias("m"))
    ref = F.concat(F.regexp_replace(F.expr("substring(seq, 1, m)"), "CC", "CA"), F.regexp_replace(F.expr("substring(seq, m + 5)"), "CC", "CA"), F.lit("ACG"))
    cigar = F.concat(F.col("m").cast("string"), F.lit("M4D"), (F.col("n") - F.col("m") - 4).cast("string"), F.lit("M3I"))
    return seqs.select("doc_id", F.md5(runs.extended(cigar, ref, F.col("seq"))).alias("cigar"))


def global_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items against the next one."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", Q.S.bridge("text").alias("seq"))
    pairs = items.join(items.select((F.col("item_id") - 1).alias("item_id"), F.col("seq").alias("ref")), "item_id")
    return pairs.select("item_id", C.aligned_udf("seq", "ref").alias("cigar"))


R_CTE = """WITH r AS (SELECT *, row_number() OVER () AS rn, l_orderkey || '_' || l_linenumber AS allele, CAST(floor(l_quantity) AS INTEGER) AS q FROM lineitem),
c AS (SELECT *, (l_suppkey % 9 + 1) || 'H' || (q * 10) || '=' || l_linenumber || 'X' || (l_partkey % 41 + 1) || 'I' || (q * 7 + 40) || '=' || (l_partkey % 23 + 1) || 'D' || (q * 5) || '=' AS cigar FROM r),
t AS (SELECT rn, allele, unnest(regexp_extract_all(cigar, '\\d+[A-Za-z=]')) AS t FROM c),
n AS (SELECT rn, allele, CAST(sum(CASE WHEN op IN ('=', 'X', 'I') THEN n ELSE 0 END) AS INTEGER) AS ref_len, CAST(sum(CASE WHEN op IN ('=', 'X', 'D') THEN n ELSE 0 END) AS INTEGER) AS query_len, CAST(sum(CASE WHEN op = 'H' THEN n ELSE 0 END) AS INTEGER) AS clip, CAST(sum(CASE WHEN op = 'I' THEN n ELSE 0 END) AS INTEGER) AS inserted, CAST(sum(CASE WHEN op = '=' THEN n ELSE 0 END) AS INTEGER) AS match FROM (SELECT rn, allele, CAST(left(t, -1) AS INTEGER) AS n, right(t, 1) AS op FROM t) GROUP BY rn, allele)"""

GAPS = f"""WITH s AS (SELECT doc_id, replace(seq, 'GA', '--') AS q, replace(seq, 'CC', '-T') AS r FROM (SELECT doc_id, {N.BRIDGED} AS seq FROM documents) WHERE length(seq) > 0),
p AS (SELECT *, unnest(range(1, length(q) + 1)) AS i FROM s)"""

QUERIES = {
    "cigar_lengths": (cigar_lengths, R_CTE + " SELECT allele, ref_len, query_len, clip, inserted, CASE WHEN inserted >= query_len / 10.0 * 0.5 THEN 'Novel(insert)' ELSE 'Mutate' END AS kind FROM n"),
    "paf_filter": (paf_filter, R_CTE + " SELECT allele, match FROM n JOIN (SELECT rn, 100 - l_linenumber * 2 AS identity, l_partkey % 200 AS z FROM r) USING (rn) WHERE identity > 90 AND ((ref_len - z > 300 AND match > 150) OR (match > 100 AND ref_len - z > ref_len * 2 / 3.0))"),
    "uncertain_alleles": (
        uncertain_alleles,
        """WITH r AS (SELECT l_orderkey || '_' || l_linenumber // 2 AS allele, CASE WHEN l_suppkey % 3 = 0 THEN 'HG_h' WHEN l_suppkey % 3 = 1 THEN 'NC_0609' ELSE 'chr' END || l_suppkey AS haplo, l_partkey AS ref, l_discount AS diff, l_orderkey * 10 + l_linenumber AS n FROM lineitem),
b AS (SELECT allele, lag(allele) OVER (ORDER BY n, allele) AS b FROM r),
x AS (SELECT *, count(*) OVER (PARTITION BY haplo, ref) AS same, row_number() OVER (PARTITION BY haplo, ref ORDER BY n, allele) AS seen FROM r WHERE haplo NOT LIKE 'chr%')
SELECT allele FROM b WHERE allele = b UNION SELECT allele FROM x WHERE same > 1 OR (seen = 1 AND diff > 0.08)""",
    ),
    "alignment_segments": (alignment_segments, None),
    "global_alignment": (global_alignment, None),
    "cigar_clip": (
        cigar_clip,
        R_CTE.split("\nt AS")[0]
        + """ l AS (SELECT rn, allele, l_partkey % 400 AS s, l_partkey % 400 + 150 AS e, list_filter(regexp_extract_all(cigar, '\\d+[A-Za-z=]'), lambda x: right(x, 1) <> 'H') AS l FROM c),
t AS (SELECT rn, allele, s, e, i, CAST(left(l[i], -1) AS INTEGER) AS n, right(l[i], 1) AS op FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM l)),
m AS (SELECT *, CASE WHEN op = 'I' THEN 0 ELSE n END AS step, CASE WHEN op = 'D' THEN 0 ELSE n END AS move FROM t),
p AS (SELECT *, coalesce(sum(step) OVER w, 0) AS a, coalesce(sum(move) OVER w, 0) AS b FROM m WINDOW w AS (PARTITION BY rn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, greatest(s, a) AS lo, least(e, a + step) AS hi FROM p),
z AS (SELECT rn, i, CASE WHEN step > 0 THEN hi - lo ELSE n END AS n, op, b + CASE WHEN move > 0 AND step > 0 THEN lo - a ELSE 0 END AS f, b + CASE WHEN step = 0 THEN move WHEN move > 0 THEN hi - a ELSE 0 END AS g FROM k WHERE (step > 0 AND lo < hi) OR (step = 0 AND s < a AND a < e)),
o AS (SELECT rn, arg_min(f, i) AS f, arg_max(g, i) AS g, string_agg(n || op, '' ORDER BY i) AS cigar FROM z GROUP BY rn)
SELECT allele, CAST(coalesce(f, 0) AS BIGINT) AS start, CAST(coalesce(g, 0) AS BIGINT) AS "end", coalesce(o.cigar, '') AS cigar FROM r LEFT JOIN o USING (rn)""",
    ),
    "gapped_cigar": (
        gapped_cigar,
        GAPS
        + """, o AS (SELECT doc_id, i, q[i] AS a, CASE WHEN q[i] = '-' THEN 'D' WHEN r[i] = '-' THEN 'I' WHEN q[i] = r[i] THEN '=' ELSE 'X' END AS op FROM p WHERE q[i] <> '-' OR r[i] <> '-'),
f AS (SELECT *, CASE WHEN lag(op) OVER (PARTITION BY doc_id ORDER BY i) = op THEN 0 ELSE 1 END AS f FROM o), g AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM f),
u AS (SELECT doc_id, g, count(*) || op || CASE WHEN op IN ('X', 'I') THEN string_agg(a, '' ORDER BY i) ELSE '' END AS t FROM g GROUP BY doc_id, g, op)
SELECT doc_id, md5(string_agg(t, '' ORDER BY g)) AS cigar FROM u GROUP BY doc_id""",
    ),
    "gapped_places": (
        gapped_places,
        GAPS
        + """, n AS (SELECT doc_id, i, q[i] AS a, length(q) AS size, count(*) FILTER (q[i] <> '-') OVER (PARTITION BY doc_id ORDER BY i) AS n FROM p)
SELECT doc_id, md5(coalesce(string_agg(i - 1, ',' ORDER BY i) FILTER (a <> '-') || ',', '') || max(size)) AS gapped, md5(string_agg(n - CASE WHEN a = '-' THEN 0 ELSE 1 END, ',' ORDER BY i) || ',' || max(n)) AS ungapped FROM n GROUP BY doc_id""",
    ),
    "extended_cigar": (
        extended_cigar,
        f"""WITH s AS (SELECT doc_id, seq, length(seq) // 3 AS m FROM (SELECT doc_id, {N.BRIDGED} AS seq FROM documents) WHERE length(seq) >= 12),
x AS (SELECT doc_id, seq, m, replace(substr(seq, 1, m), 'CC', 'CA') || 'NNNN' || replace(substr(seq, m + 5), 'CC', 'CA') AS ref FROM s),
o AS (SELECT doc_id, i, seq[i] AS a, CASE WHEN i > m AND i <= m + 4 THEN 'D' WHEN seq[i] = ref[i] THEN '=' ELSE 'X' END AS op FROM (SELECT *, unnest(range(1, length(seq) + 1)) AS i FROM x)),
f AS (SELECT *, CASE WHEN lag(op) OVER (PARTITION BY doc_id ORDER BY i) = op THEN 0 ELSE 1 END AS f FROM o), g AS (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM f),
u AS (SELECT doc_id, g, count(*) || op || CASE WHEN op IN ('X', 'D') THEN string_agg(a, '' ORDER BY i) ELSE '' END AS t FROM g GROUP BY doc_id, g, op)
SELECT doc_id, md5(string_agg(t, '' ORDER BY g) || '3I') AS cigar FROM u GROUP BY doc_id""",
    ),
    "graph_paths": (
        graph_paths,
        R_CTE
        + """, a AS (SELECT rn, l_suppkey AS rs, l_orderkey AS chrom, l_linenumber * 1000000 + l_partkey AS id, l_partkey AS segment, CASE WHEN l_returnflag = 'R' THEN '<' ELSE '>' END AS o, l_partkey % 500 AS start, l_partkey % 500 + query_len AS "end", CAST(round(l_discount * 100) AS BIGINT) AS score FROM r JOIN n USING (rn)),
p AS (SELECT chrom, start AS p FROM a UNION SELECT chrom, "end" FROM a), c2 AS (SELECT * FROM (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS t FROM p) WHERE t IS NOT NULL),
b AS (SELECT * FROM (SELECT x.chrom, s, t, id, row_number() OVER (PARTITION BY x.chrom, s ORDER BY score DESC, id) AS r FROM c2 x JOIN a ON x.chrom = a.chrom AND a.start < t AND s < a."end") WHERE r = 1),
f AS (SELECT *, CASE WHEN lag(id) OVER w = id AND lag(t) OVER w = s THEN 0 ELSE 1 END AS f FROM b WINDOW w AS (PARTITION BY chrom ORDER BY s)),
g AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY s) AS g FROM f), e AS (SELECT chrom, id, min(s) AS s, max(t) AS t FROM g GROUP BY chrom, g, id HAVING max(t) - min(s) > 30),
h AS (SELECT e.chrom, e.s AS es, e.t AS et, a.rn, o || segment AS step, rs, e.s - a.start AS s, e.t - a.start AS e FROM e JOIN a ON a.chrom = e.chrom AND a.id = e.id),
l AS (SELECT h.*, list_filter(regexp_extract_all(cigar, '\\d+[A-Za-z=]'), lambda x: right(x, 1) <> 'H') AS l FROM h JOIN c USING (rn)),
k AS (SELECT * EXCLUDE (l), CAST(left(l[i], -1) AS INTEGER) AS n, right(l[i], 1) AS op FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM l)),
m AS (SELECT *, CASE WHEN op = 'I' THEN 0 ELSE n END AS w, CASE WHEN op = 'D' THEN 0 ELSE n END AS v FROM k),
q AS (SELECT *, coalesce(sum(w) OVER z, 0) AS x, coalesce(sum(v) OVER z, 0) AS y FROM m WINDOW z AS (PARTITION BY rn, es ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
d AS (SELECT *, greatest(s, x) AS lo, least(e, x + w) AS hi FROM q),
z AS (SELECT chrom, es, et, step, rs, rn, i, CASE WHEN w > 0 THEN hi - lo ELSE n END || op AS t, y + CASE WHEN v > 0 AND w > 0 THEN lo - x ELSE 0 END AS first, y + CASE WHEN w = 0 THEN v WHEN v > 0 THEN hi - x ELSE 0 END AS last FROM d WHERE (w > 0 AND lo < hi) OR (w = 0 AND s < x AND x < e)),
y AS (SELECT h.chrom, h.es, h.et, h.step, h.rs + coalesce(arg_min(first, i), 0) AS f, h.rs + coalesce(arg_max(last, i), 0) AS g, coalesce(string_agg(t, '' ORDER BY i), '') AS t FROM h LEFT JOIN z ON z.rn = h.rn AND z.es = h.es GROUP BY h.chrom, h.es, h.et, h.step, h.rn, h.rs)
SELECT chrom AS allele, string_agg(step, '' ORDER BY es, et, step) AS path, CAST(count(*) AS INTEGER) AS n_steps, md5(string_agg(f || '_' || g || '_' || t, ';' ORDER BY es, et, step, f, g, t)) AS places FROM y GROUP BY chrom""",
    ),
}
