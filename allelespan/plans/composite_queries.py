"""Queries of the composite operators and the modes of the k-mer program, with SQL that says the whole chain again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.operators import cluster, graph, repeats
from allelespan.operators import kmer as K
from allelespan.plans import function_queries as N
from allelespan.plans import interval_queries as E
from allelespan.plans import kmer_queries as Q
from allelespan.plans import pair_queries as P
from allelespan.plans import pipelines
from allelespan.sources.staging import staged


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trimmed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    n = F.col("doc_id")
    seqs = Q.documents(spark, sf_dir).select(n.alias("name"), F.col("source").alias("contig"), (n * 10).alias("start"), (n * 10 + F.length("seq")).alias("end"), N._strand(n).alias("strand"), "seq")
    return pipelines.trim_sequences(seqs, Q.item_kmers(spark, sf_dir).select("kmer").distinct(), Q.LEN, 20, 0.1, 50)


def sequence_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = _trimmed(spark, sf_dir)
    return kept.select("name", "start", "end", F.md5("seq").alias("seq"))


def kmer_list_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir)[1]


def hotspot_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    spots = _read(spark, sf_dir, "events").select((n % 40).alias("contig"), (n * 7 % 200).alias("start"), (n * 7 % 200 + F.col("user_id") % 20 + 5).alias("end"))
    contigs = _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("contig"), Q.S.bridge("text").alias("seq"))
    return pipelines.hotspot_queries(spots, contigs, 10).select("name", "seq")


def group_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.intervals(spark, sf_dir).withColumn("gene", F.concat("kind", F.lit("."), (F.col("id") % 7).cast("string")))
    members = rows.where("kind = 'view'").select((F.col("id") % 200).alias("group_id"), "id", "chrom", "start", "end")
    return pipelines.group_names(members, E.second(rows, "click", "gene").unionByName(E.second(rows, "purchase", "gene")), "chase")


def type_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.intervals(spark, sf_dir).withColumn("gene", F.concat("kind", F.when(F.col("id") % 2 == 0, "-x").otherwise("")))
    n = F.col("id")
    members = rows.where("kind IN ('view', 'click')").select((n % 90).alias("type"), "id", F.when(n % 600 == 4, "Ref").when(n % 7 < 3, "Pri").otherwise("Dup").alias("tag"), F.concat(F.lit("r"), (n % 3).cast("string")).alias("ref"), (n % 50 == 1).cast("int").alias("exon"), "chrom", "start", "end")
    got = pipelines.annotated_types(members, E.second(rows, "purchase", "gene").unionByName(E.second(rows, "signup", "gene")))
    return got.select("type", "tag", "exon", "n", *(F.array_join(c, ",").alias(c) for c in ("genes", "refs", "members")))


def lift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, n = E.intervals(spark, sf_dir), F.col("id")
    alleles = rows.where("kind IN ('click', 'signup')").select("id", (F.col("end") - F.col("start")).alias("size"), (n % 4 == 0).cast("int").alias("exon"))
    cigar = F.concat(F.lit("50="), (n * 37 % 900).cast("string"), F.lit("I9X"), (n % 30).cast("string"), F.lit("I40="))
    mapped = rows.where("kind = 'click'").select("id", "chrom", "start", "end", cigar.alias("cigar"))
    refs = E.second(rows, "view", F.concat(F.lit("r"), n.cast("string")).alias("ref"), n.alias("place"))
    return pipelines.lifted(alleles, mapped, refs).select("id", "ref", "ref_align", "exon", "inserted", "kind")


def exclusive_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Q.documents(spark, sf_dir).withColumnRenamed("source", "haplo")
    return pipelines.exclusive_kmers(docs.where("lang = 'en'"), docs, Q.LEN)


def _mode(mode: int, key: str, targeted: bool = True):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = Q.documents(spark, sf_dir).select(F.col("doc_id").alias("name"), "seq")
        if mode == 3:
            labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("name"), (F.col("toxic") == 1).alias("excluded"))
            docs = docs.join(K.probe(labels, K.bounded(labels)), "name")
        targets = _read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("target"), Q.S.bridge("text").alias("seq"))
        return pipelines.convert(mode, docs, targets if targeted else None, Q.LEN)[key]

    return run


def regrouped_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = Q.documents(spark, sf_dir).select(F.col("doc_id").alias("name"))
    return cluster.regrouped_counts(names, P._counts(spark, sf_dir), "doc_id", [(0, 100), (3, 400)])


def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, size = F.col("event_id"), F.col("user_id") % 60
    hits = _read(spark, sf_dir, "events").select((n % 900).alias("segment"), (n % 900).alias("place"), (n * 31 % 5000).alias("start"), (n * 31 % 5000 + size).alias("end"), (n % 970).alias("rplace"), (n * 17 % 5000).alias("rstart"), F.greatest(F.lit(0), n * 17 % 5000 + F.when(n % 3 == 0, -size).otherwise(size)).alias("rend"))
    segments = _read(spark, sf_dir, "events").select((n % 900).alias("segment")).distinct()
    return repeats.without_repeats(hits, segments.select("segment", F.when(F.col("segment") % 10 == 0, F.col("segment") % 70 + 60).otherwise(F.col("segment") + 5200).alias("size")))


def graph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_partkey") % 8 * 400 + F.col("l_linenumber")
    steps = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("allele"), (F.col("l_partkey") % 20).alias("segment"), F.when(F.col("l_returnflag") == "R", "<").otherwise(">").alias("strand"), start.alias("start"), (start + 400 * (1 + F.col("l_suppkey") % 3)).alias("end"))
    return graph.chunks(steps)


SEQ_TRIM = (
    f"{Q.CTE}, hits AS (SELECT doc_id, pos, kmer, kmer IN (SELECT kmer FROM b) AS h FROM d),"
    + ",".join([Q.TRIM.format(side="left", order="ASC", pick="max", whole="min"), Q.TRIM.format(side="right", order="DESC", pick="min", whole="max")])
    + f""", s AS (SELECT doc_id, {N.BRIDGED} AS seq FROM documents),
i AS (SELECT doc_id, count(*) FILTER (h AND pos BETWEEN "left" AND "right") AS n FROM hits JOIN left_ USING (doc_id) JOIN right_ USING (doc_id) GROUP BY 1),
t AS (SELECT doc_id, seq, greatest(0, "left" - 50) AS lo, least(length(seq), "right" + 81) AS hi FROM s JOIN left_ USING (doc_id) JOIN right_ USING (doc_id) JOIN i USING (doc_id) WHERE "left" IS NOT NULL AND n >= 20 AND n >= (length(seq) - 100) * 0.1)"""
)

MEETS = """ AND a.start <= b."end" AND b.start <= a."end" """

QUERIES = {
    "sequence_trim": (
        sequence_trim,
        SEQ_TRIM + """ SELECT doc_id AS name, CASE WHEN doc_id % 3 = 0 THEN doc_id * 10 + length(seq) - hi ELSE doc_id * 10 + lo END AS start, CASE WHEN doc_id % 3 = 0 THEN doc_id * 10 + length(seq) - lo ELSE doc_id * 10 + hi END AS "end", md5(substr(seq, CAST(lo AS INTEGER) + 1, CAST(hi - lo AS INTEGER))) AS seq FROM t""",
    ),
    "kmer_list_left": (kmer_list_left, SEQ_TRIM + " SELECT DISTINCT kmer FROM b WHERE kmer NOT IN (SELECT kmer FROM hits LEFT JOIN t USING (doc_id) WHERE lo IS NULL OR pos < lo OR pos + 31 > hi)"),
    "hotspot_sequences": (
        hotspot_sequences,
        'WITH e AS (SELECT event_id % 40 AS chrom, event_id * 7 % 200 AS start, event_id * 7 % 200 + user_id % 20 + 5 AS "end" FROM events)'
        + E.RUNS.format(gap=10)
        + f""", p AS (SELECT chrom, greatest(0, start - 5) AS start, "end" + 5 AS "end" FROM m) SELECT chrom || '_' || start || '_' || "end" AS name, substr({N.BRIDGED}, CAST(start AS INTEGER) + 1, CAST("end" - start AS INTEGER)) AS seq FROM p JOIN benchmark ON item_id = chrom""",
    ),
    "group_naming": (
        group_naming,
        E.I_CTE
        + f""", x AS (SELECT a.id % 200 AS group_id, list_sort(list(DISTINCT b.kind || '.' || b.id % 7)) AS g FROM e a LEFT JOIN e b ON a.chrom = b.chrom AND b.kind IN ('click', 'purchase'){MEETS}WHERE a.kind = 'view' GROUP BY 1),
y AS (SELECT group_id, list_filter(g, lambda z: z IS NOT NULL) AS g FROM x) SELECT group_id, replace(array_to_string(list_concat(list_filter(g, lambda z: contains(z, 'chase')), list_filter(g, lambda z: NOT contains(z, 'chase')))[1:3], 'OOO'), '.', 'v') AS name FROM y""",
    ),
    "type_annotation": (
        type_annotation,
        E.I_CTE
        + f""", m AS (SELECT id % 90 AS type, id, CASE WHEN id % 600 = 4 THEN 'Ref' WHEN id % 7 < 3 THEN 'Pri' ELSE 'Dup' END AS tag, 'r' || id % 3 AS ref, CASE WHEN id % 50 = 1 THEN 1 ELSE 0 END AS exon, chrom, start, "end" FROM e WHERE kind IN ('view', 'click')),
t AS (SELECT type, tag, count(*) AS n FROM m GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY CASE WHEN tag = 'Ref' THEN 0 ELSE 1 END, n DESC, tag) AS r FROM t),
g AS (SELECT DISTINCT a.type, b.kind || CASE WHEN b.id % 2 = 0 THEN '-x' ELSE '' END AS gene, b.kind AS short, b.id % 2 = 0 AS long FROM m a JOIN e b ON a.chrom = b.chrom AND b.kind IN ('purchase', 'signup'){MEETS}),
k AS (SELECT type, string_agg(gene, ',' ORDER BY gene) AS genes FROM g WHERE NOT long OR NOT EXISTS (SELECT 1 FROM g h WHERE h.type = g.type AND h.gene = g.short) GROUP BY 1)
SELECT m.type, max(r.tag) AS tag, max(exon) AS exon, count(*) AS n, coalesce(max(genes), '') AS genes, string_agg(DISTINCT ref, ',' ORDER BY ref) AS refs, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS members FROM m JOIN r ON m.type = r.type AND r.r = 1 LEFT JOIN k ON k.type = m.type GROUP BY m.type""",
    ),
    "lift_summary": (
        lift_summary,
        E.I_CTE
        + """, a AS (SELECT id, "end" - start AS size, CASE WHEN id % 4 = 0 THEN 1 ELSE 0 END AS exon, kind = 'click' AS mapped, CAST(id * 37 % 900 + id % 30 AS INTEGER) AS ins, chrom || ':' || start || '-' || "end" AS al FROM e WHERE kind IN ('click', 'signup')),
f AS (SELECT a.id, min(b.id) AS ref FROM e a JOIN e b ON b.kind = 'view' AND a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" WHERE a.kind = 'click' AND a.start <= a."end" GROUP BY 1)
SELECT a.id, 'r' || ref AS ref, CASE WHEN mapped THEN al END AS ref_align, exon, CASE WHEN ref IS NOT NULL THEN ins END AS inserted, CASE WHEN NOT mapped THEN 'Novel(unmap)' WHEN ref IS NULL THEN 'Novel(trans)' WHEN ins >= size * 0.5 THEN 'Novel(insert)' ELSE 'Mutate' END AS kind FROM a LEFT JOIN f USING (id)""",
    ),
    "exclusive_kmers": (exclusive_kmers, f"{Q.SELECTED} SELECT kmer, count(*) AS n_haplo FROM s WHERE kmer IN (SELECT kmer FROM n WHERE g > 0) GROUP BY kmer HAVING bool_and(included)"),
    "mode_0_counts": (_mode(0, "counts", False), f"WITH d AS ({Q.DOCS}) SELECT kmer, least(count(*), 255) AS cnt FROM d GROUP BY kmer"),
    "mode_1_hotspots": (_mode(1, "hotspots"), Q.QUERIES["hotspot_regions"][1]),
    "mode_2_counts": (_mode(2, "counts"), f"{Q.CTE} SELECT doc_id AS name, target, kmer, least(n, 255) AS cnt FROM (SELECT doc_id, kmer, count(*) AS n FROM d GROUP BY 1, 2) JOIN (SELECT DISTINCT item_id AS target, kmer FROM b) USING (kmer)"),
    "mode_3_kmers": (_mode(3, "kmers"), f"{Q.LABELLED} SELECT kmer, x.kmer IS NOT NULL AS excluded FROM i LEFT JOIN x USING (kmer)"),
    "mode_4_dual": (_mode(4, "dual"), Q.QUERIES["kmer_dual_count"][1]),
    "regrouped_partition": (
        regrouped_partition,
        P.C_CTE.replace("WITH d", "WITH RECURSIVE d")
        + """, e AS (SELECT i AS a, j AS b, shared FROM p UNION SELECT j, i, shared FROM p),
r(name, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.name AND shared > 100),
g AS (SELECT name, min(root) AS root FROM r GROUP BY 1), big AS (SELECT name, root FROM g WHERE root IN (SELECT root FROM g GROUP BY 1 HAVING count(*) > 3)),
f AS (SELECT a, b FROM e JOIN big x ON x.name = a JOIN big y ON y.name = b WHERE x.root = y.root AND shared > 400),
s(name, root) AS (SELECT name, name FROM big UNION SELECT f.b, s.root FROM s JOIN f ON f.a = s.name)
SELECT g.name, coalesce(t.root, g.root) AS group_id FROM g LEFT JOIN (SELECT name, min(root) AS root FROM s GROUP BY 1) t USING (name)""",
    ),
    "repeat_removal": (
        repeat_removal,
        """WITH h AS (SELECT event_id % 900 AS chrom, event_id % 970 AS rplace, event_id * 31 % 5000 AS start, event_id * 31 % 5000 + user_id % 60 AS "end", event_id * 17 % 5000 AS rs, greatest(0, event_id * 17 % 5000 + CASE WHEN event_id % 3 = 0 THEN -(user_id % 60) ELSE user_id % 60 END) AS re FROM events),
e AS (SELECT * FROM h WHERE rplace <= chrom AND start > rs AND start > re)"""
        + E.RUNS.format(gap=30)
        + """, y AS (SELECT DISTINCT chrom, CASE WHEN chrom % 10 = 0 THEN chrom % 70 + 60 ELSE chrom + 5200 END AS size FROM h),
u AS (SELECT chrom, start, "end", 0 AS last FROM m UNION ALL SELECT chrom, size, size, 1 FROM y),
l AS (SELECT chrom, coalesce(lag("end") OVER (PARTITION BY chrom ORDER BY last, start), 0) AS a, start AS b FROM u),
q AS (SELECT chrom, greatest(0, a - 30) AS a, least(size, b + 30) AS b FROM l JOIN y USING (chrom))
SELECT DISTINCT chrom AS segment, CASE WHEN a > 0 AND b - a < 151 THEN a - least(a, 151 - (b - a)) ELSE a END AS start, CASE WHEN a = 0 AND b < 151 THEN 151 ELSE b END AS "end" FROM q""",
    ),
    "graph_chunks": (
        graph_chunks,
        """WITH s AS (SELECT l_partkey % 20 AS segment, CASE WHEN l_returnflag = 'R' THEN '<' ELSE '>' END AS strand, l_partkey % 8 * 400 + l_linenumber AS start, l_partkey % 8 * 400 + l_linenumber + 400 * (1 + l_suppkey % 3) AS "end" FROM lineitem),
p AS (SELECT segment, start AS pos FROM s UNION ALL SELECT segment, "end" FROM s), f AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY segment ORDER BY pos) < 50 THEN 0 ELSE 1 END AS f FROM p),
g AS (SELECT *, sum(f) OVER (PARTITION BY segment ORDER BY pos RANGE UNBOUNDED PRECEDING) AS g FROM f), n AS (SELECT segment, g, pos, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT segment, pos FROM (SELECT *, row_number() OVER (PARTITION BY segment, g ORDER BY n DESC, pos) AS r FROM n) WHERE r = 1),
c AS (SELECT * FROM (SELECT segment, pos AS a, lead(pos) OVER (PARTITION BY segment ORDER BY pos) AS b FROM r) WHERE b IS NOT NULL)
SELECT c.segment, a AS start, b AS "end", CASE WHEN sum(CASE WHEN strand = '<' THEN -1 ELSE 1 END) < 0 THEN '<' ELSE '>' END AS strand, count(*) AS n_alleles FROM c JOIN s ON s.segment = c.segment AND s.start < b AND a < s."end" GROUP BY c.segment, a, b""",
    ),
}
