"""Interval queries over events: user = contig, ts = start, value = length in minutes, type = name or side of a join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.operators import annotate
from allelespan.operators import interval as I

BIN = 86_400


def intervals(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    start = F.unix_timestamp("ts")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.col("user_id").alias("chrom"), start.alias("start"), (start + F.floor(F.abs("value")) * 60).alias("end"), F.col("event_type").alias("kind"), *more)


def second(df: DataFrame, kind: str, *more: str) -> DataFrame:
    return df.where(F.col("kind") == kind).select("chrom", F.col("start").alias("start2"), F.col("end").alias("end2"), *more)


def interval_merge_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.merge(intervals(spark, sf_dir).select("chrom", "start", "end"), ["chrom"], 20_000)


def interval_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.gaps(intervals(spark, sf_dir).select("chrom", "start", "end"), ["chrom"], 30)


def interval_overlap_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir)
    named = rows.withColumn("gene", F.col("kind"))
    genes = second(named, "click", "gene").unionByName(second(named, "purchase", "gene"))
    got = I.overlapping_names(rows.where("kind = 'view'").select("id", "chrom", "start", "end"), genes, BIN)
    return got.select("id", F.array_join("genes", ",").alias("genes"))


def error_region_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir)
    return I.without_errors(rows.where("kind <> 'error'").select("id", "chrom", "start", "end"), second(rows, "error"), BIN).select("id", "start", "end")


def first_overlap_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir)
    got = I.first_overlap(rows.where("kind = 'click'").select("id", "chrom", "start", "end"), second(rows, "view", F.col("id").alias("lift")), "lift", BIN)
    return got.select("id", "lift", F.when(F.col("lift").isNull(), "Novel(unmap)").otherwise("Mapped").alias("tag"))


def unmapped_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return annotate.unmapped(docs.select("doc_id", "source"), labels, "doc_id")


def edge_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir)
    sizes = rows.where("kind <> 'signup'").groupBy("chrom").agg(F.max("end").alias("size")).withColumnRenamed("chrom", "contig")
    first = rows.agg(F.min("start")).scalar()
    loci = rows.select(F.concat(F.lit("locus"), F.col("id").cast("string")).alias("name"), F.col("chrom").alias("contig"), (F.col("start") - first).alias("start"), (F.col("end") - first).alias("end"), "kind")
    sizes = sizes.withColumn("size", F.col("size") - first)
    return I.edge_filter(loci, sizes, F.col("kind") == "purchase").select("name", "edge")


def best_score_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir, F.floor(F.col("value") * 100).alias("score"))
    return I.envelope(rows.select("chrom", "id", "start", "end", "score"), "chrom", BIN).select("chrom", "id", "start", "end")


def _strand(df: DataFrame) -> DataFrame:
    return df.withColumn("strand", F.when(F.col("kind").isin("click", "error"), "-").otherwise("+"))


def locus_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _strand(intervals(spark, sf_dir)).select(F.concat(F.lit("g"), (F.col("chrom") % 50).cast("string")).alias("name"), F.col("chrom"), "strand", F.col("kind").alias("gene"), "start", "end")
    return I.collapse(rows).select("name", "chrom", "strand", "gene", "start", "end")


def strand_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _strand(intervals(spark, sf_dir)).groupBy("chrom").agg(I.strand_vote().alias("strand"), F.count("*").alias("n"))


def min_size_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = I.extend_to(15_000)
    return intervals(spark, sf_dir).select("id", start.alias("start"), end.alias("end"))


def break_cluster_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir).select("chrom", F.floor(F.col("start") / 3600).alias("pos"))
    return I.break_clusters(rows, "chrom", 50)


def majority_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = intervals(spark, sf_dir).select("chrom", F.when(F.col("kind") == "signup", "Ref").otherwise(F.col("kind")).alias("tag"), (F.col("kind") == "error").cast("int").alias("exon"))
    return annotate.majority(rows, "chrom", "tag", "exon")


def chunk_occurrence_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role")
    n = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    return rows.select("conv_id", "turn", F.when(n > 1, F.concat_ws("_", "role", n.cast("string"))).otherwise(F.col("role")).alias("visit"))


I_CTE = """WITH e AS (SELECT event_id AS id, user_id AS chrom, CAST(floor(epoch(ts)) AS BIGINT) AS start, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(abs(value)) AS BIGINT) * 60 AS "end", event_type AS kind, CAST(floor(value * 100) AS BIGINT) AS score FROM events)"""
RUNS = """, b AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM e),
g AS (SELECT *, sum(CASE WHEN start - b <= {gap} THEN 0 ELSE 1 END) OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS g FROM b),
m AS (SELECT chrom, min(start) AS start, max("end") AS "end", count(*) AS n FROM g GROUP BY chrom, g)"""
STRAND = "CASE WHEN kind IN ('click', 'error') THEN '-' ELSE '+' END"

QUERIES = {
    "interval_merge_gap": (interval_merge_gap, I_CTE + RUNS.format(gap=20000) + ' SELECT chrom, greatest(0, start - 10000) AS start, "end" + 10000 AS "end", n FROM m'),
    "interval_gaps": (interval_gaps, I_CTE + RUNS.format(gap=0) + ' SELECT * FROM (SELECT chrom, "end" AS start, lead(start) OVER (PARTITION BY chrom ORDER BY start) AS "end" FROM m) WHERE "end" - start > 30'),
    "interval_overlap_genes": (interval_overlap_genes, I_CTE + """ SELECT a.id, coalesce(string_agg(DISTINCT b.kind, ',' ORDER BY b.kind), '') AS genes FROM e a LEFT JOIN e b ON a.chrom = b.chrom AND b.kind IN ('click', 'purchase') AND a.start <= b."end" AND b.start <= a."end" WHERE a.kind = 'view' GROUP BY a.id"""),
    "error_region_anti": (error_region_anti, I_CTE + """ SELECT id, start, "end" FROM e a WHERE kind <> 'error' AND NOT EXISTS (SELECT 1 FROM e b WHERE b.kind = 'error' AND a.chrom = b.chrom AND a.start <= b."end" AND b.start <= a."end")"""),
    "first_overlap_lift": (first_overlap_lift, I_CTE + """ SELECT a.id, min(b.id) AS lift, CASE WHEN min(b.id) IS NULL THEN 'Novel(unmap)' ELSE 'Mapped' END AS tag FROM e a LEFT JOIN e b ON b.kind = 'view' AND a.chrom = b.chrom AND a.start < b."end" AND b.start < a."end" WHERE a.kind = 'click' GROUP BY a.id"""),
    "unmapped_anti": (unmapped_anti, "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"),
    "edge_filter": (
        edge_filter,
        I_CTE
        + """, o AS (SELECT min(start) AS o FROM e), z AS (SELECT chrom, max("end") - any_value(o) AS size FROM e, o WHERE kind <> 'signup' GROUP BY chrom),
x AS (SELECT 'locus' || id AS name, kind, least(start - o, coalesce(size, 1000000000) - ("end" - o)) AS edge FROM e JOIN o ON true LEFT JOIN z USING (chrom)),
h AS (SELECT coalesce(min(edge) FILTER (kind = 'purchase'), 40000) / 2 AS half FROM x)
SELECT name, edge FROM x, h WHERE edge >= least(20000.0, half)""",
    ),
    "best_score_envelope": (
        best_score_envelope,
        I_CTE
        + """, p AS (SELECT chrom, start AS p FROM e UNION SELECT chrom, "end" FROM e), c AS (SELECT * FROM (SELECT chrom, p AS s, lead(p) OVER (PARTITION BY chrom ORDER BY p) AS t FROM p) WHERE t IS NOT NULL),
b AS (SELECT * FROM (SELECT c.chrom, s, t, id, row_number() OVER (PARTITION BY c.chrom, s ORDER BY score DESC, id) AS r FROM c JOIN e ON c.chrom = e.chrom AND e.start < t AND s < e."end") WHERE r = 1),
f AS (SELECT *, CASE WHEN lag(id) OVER w = id AND lag(t) OVER w = s THEN 0 ELSE 1 END AS f FROM b WINDOW w AS (PARTITION BY chrom ORDER BY s)),
g AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY s) AS g FROM f)
SELECT chrom, id, min(s) AS start, max(t) AS "end" FROM g GROUP BY chrom, g, id HAVING max(t) - min(s) > 30""",
    ),
    "locus_collapse": (
        locus_collapse,
        I_CTE
        + f""", o AS (SELECT 'g' || chrom % 50 AS name, chrom, {STRAND} AS strand, kind AS gene, min(start) AS start, max("end") AS "end" FROM e GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY chrom, start, "end", strand, gene) AS n FROM o)
SELECT CASE WHEN n > 1 THEN name || '00' || n ELSE name END AS name, chrom, strand, gene, start, "end" FROM n""",
    ),
    "strand_vote": (strand_vote, I_CTE + f""" SELECT chrom, CASE WHEN sum(CASE WHEN {STRAND} = '-' THEN "end" - start ELSE 0 END) > sum(CASE WHEN {STRAND} = '-' THEN 0 ELSE "end" - start END) THEN '-' ELSE '+' END AS strand, count(*) AS n FROM e GROUP BY chrom"""),
    "min_size_extend": (min_size_extend, I_CTE + """ SELECT id, greatest(0, start - h) AS start, "end" + h AS "end" FROM (SELECT *, CAST(floor(greatest(0, 15000 - ("end" - start)) / 2.0) AS BIGINT) AS h FROM e)"""),
    "break_cluster_mode": (
        break_cluster_mode,
        I_CTE
        + """, p AS (SELECT chrom, CAST(floor(start / 3600.0) AS BIGINT) AS pos FROM e), f AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) < 50 THEN 0 ELSE 1 END AS f FROM p),
g AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY pos RANGE UNBOUNDED PRECEDING) AS g FROM f), n AS (SELECT chrom, g, pos, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY chrom, g ORDER BY n DESC, pos) AS r, sum(n) OVER (PARTITION BY chrom, g) AS t FROM n)
SELECT chrom, pos, CAST(t AS BIGINT) AS n_breaks FROM r WHERE r = 1""",
    ),
    "majority_type": (
        majority_type,
        I_CTE
        + """, t AS (SELECT chrom, CASE WHEN kind = 'signup' THEN 'Ref' ELSE kind END AS tag, max(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS exon, count(*) AS n FROM e GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY CASE WHEN tag = 'Ref' THEN 0 ELSE 1 END, n DESC, tag) AS r FROM t)
SELECT chrom, max(CASE WHEN r = 1 THEN tag END) AS tag, max(exon) AS exon, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY chrom""",
    ),
    "chunk_occurrence_number": (chunk_occurrence_number, "SELECT conv_id, turn, CASE WHEN n > 1 THEN role || '_' || n ELSE role END AS visit FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)"),
}
