"""K-mer queries over documents (sequences), their sources (haplotypes), benchmark items (targets) and labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import kmer as K
from allelespan.operators import superkmers
from allelespan.sources.staging import spread

LEN = 31


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")).select("doc_id", "source", "lang", S.bridge("text").alias("seq"))


def document_kmers(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return S.kmers(documents(spark, sf_dir), "seq", LEN, *keep)


def item_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.kmers(_read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("target"), S.bridge("text").alias("seq")), "seq", LEN, "target")


def kmer_canonical_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.counts(documents(spark, sf_dir), "seq", LEN)


def kmer_target_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.targets(item_kmers(spark, sf_dir), "target")
    at = K.listed_hits(documents(spark, sf_dir), found.select("kmer").distinct(), LEN, "source")
    return K.target_counts(at, found, "target", "source", small=K.bounded(found))


def kmer_dual_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.dual_counts_in(K.counts(item_kmers(spark, sf_dir), cap=None), documents(spark, sf_dir), LEN)


def _sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _read(spark, sf_dir, "labels").where("toxic IN (0, 1)").select("doc_id", (F.col("toxic") == 1).alias("toxic"))
    # sequences stay where they are read while labels are few enough
    return superkmers.judged(documents(spark, sf_dir).join(K.probe(labels, K.bounded(labels)), "doc_id"), "seq", LEN, "toxic", superkmers.of_sets, "kmer string, excluded boolean")


def kmer_set_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets(spark, sf_dir).where("NOT excluded").select("kmer")


def kmer_exclude_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets(spark, sf_dir).where("excluded").select("kmer")


def _selected(spark: SparkSession, sf_dir: str, judge: Callable, schema: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumnRenamed("source", "haplo")
    return K.selected(docs.where("lang = 'en'"), docs, LEN, judge, schema)


def kmer_exclusive_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _selected(spark, sf_dir, superkmers.selected_sums, "haplo string, n_included long, n_excluded long, sum_diff long")
    return sums.groupBy("haplo").agg(*(F.sum(c).alias(c) for c in ("n_included", "n_excluded", "sum_diff")))


def kmer_pan_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, superkmers.combined, "kmer string, n_haplo long")


def kmer_ref_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.ref_band(superkmers.counts(documents(spark, sf_dir), "seq", LEN), 2)


def kmer_gc_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.counts(item_kmers(spark, sf_dir), "target").where(S.gc_band(F.col("kmer")))


def kmer_low_complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = item_kmers(spark, sf_dir).select("kmer").distinct()
    return rows.select("kmer", S.low_complexity(F.col("kmer")).alias("low"), K.informative(F.col("kmer")).alias("informative"))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.targets(item_kmers(spark, sf_dir), "target")
    at = K.listed_hits(documents(spark, sf_dir), found.select("kmer").distinct(), LEN, "doc_id")
    return at.join(K.probe(found, K.bounded(found)), "kmer").select("target", F.col("doc_id").alias("contig"), (F.col("pos") + LEN).alias("pos"))


def hotspot_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.hotspots(_hits(spark, sf_dir), 50)


def kmer_end_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = item_kmers(spark, sf_dir).select("kmer").distinct()
    return K.end_trim_of(documents(spark, sf_dir).select("doc_id", "seq"), listed, 20, LEN, "doc_id")


def group_exclusive_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmers.judged(documents(spark, sf_dir), "seq", LEN, "lang", superkmers.of_one_group, "kmer string, key string, n long")
    return found.withColumnRenamed("key", "lang").groupBy("lang").agg(F.count("*").alias("n_kmers"), F.sum("n").alias("n_places"))


def mask_unique_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = item_kmers(spark, sf_dir).select("kmer").distinct()
    at = K.listed_hits(documents(spark, sf_dir), listed, LEN, "doc_id")
    runs = K.masked_runs(at.select("doc_id", "pos"), LEN, "doc_id")
    masked = K.unmask(documents(spark, sf_dir).select("doc_id", "seq"), runs, "doc_id")
    return masked.select("doc_id", F.length("seq").alias("n_bases"), S.unique_bases(F.col("seq")).alias("n_unique"))


def _sql(table: str, keep: str, where: str = "") -> str:
    return f"""
  SELECT {keep}, pos, greatest(f, reverse(translate(f, 'ACGT', 'TGCA'))) AS kmer
  FROM (SELECT {keep}, pos, substr(seq, pos + 1, {LEN}) AS f
    FROM (SELECT {keep}, seq, CAST(unnest(range(0, greatest(0, length(seq) - {LEN - 1}))) AS INTEGER) AS pos
      FROM (SELECT {keep}, regexp_replace(translate(text, '{S.BRIDGE_FROM}', '{S.BRIDGE_TO}'), '[^ACGT]', '', 'g') AS seq FROM {table} {where})))"""


DOCS = _sql("documents", "doc_id, source, lang")
ITEMS = _sql("benchmark", "item_id")
CTE = f"WITH d AS ({DOCS}), b AS ({ITEMS})"
LABELLED = f"""WITH d AS ({DOCS}), i AS (SELECT DISTINCT kmer FROM d JOIN labels USING (doc_id) WHERE toxic = 0), x AS (SELECT DISTINCT kmer FROM d JOIN labels USING (doc_id) WHERE toxic = 1)"""
SELECTED = f"""WITH d AS ({DOCS}), n AS (SELECT source AS haplo, kmer, count(*) AS n, count(*) FILTER (lang = 'en') AS g FROM d GROUP BY 1, 2),
h AS (SELECT haplo FROM n GROUP BY haplo HAVING sum(g) > 0),
s AS (SELECT haplo, kmer, least(n, 255) AS n, least(g, 255) AS g, least(n, 255) = least(g, 255) AND least(g, 255) < 255 AS included FROM n JOIN h USING (haplo))"""

TRIM = """
s{side} AS (SELECT doc_id, pos, sum(CASE WHEN h THEN 9 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY pos {order} ROWS UNBOUNDED PRECEDING) AS p FROM hits),
m{side} AS (SELECT *, least(0, coalesce(min(p) OVER (PARTITION BY doc_id ORDER BY pos {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS m FROM s{side}),
q{side} AS (SELECT *, max(CASE WHEN p - least(m, p) >= 180 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos {order} ROWS UNBOUNDED PRECEDING) AS past FROM m{side}),
{side}_ AS (SELECT doc_id, CASE WHEN max(past) = 1 THEN coalesce({pick}(CASE WHEN p < m AND past = 0 THEN pos END), {whole}(pos)) END AS "{side}" FROM q{side} GROUP BY doc_id)"""

QUERIES = {
    "kmer_canonical_count": (kmer_canonical_count, f"WITH d AS ({DOCS}) SELECT kmer, least(count(*), 255) AS cnt FROM d GROUP BY kmer"),
    "kmer_target_count": (kmer_target_count, f"{CTE} SELECT source, target, kmer, least(n, 255) AS cnt FROM (SELECT source, kmer, count(*) AS n FROM d GROUP BY 1, 2) JOIN (SELECT DISTINCT item_id AS target, kmer FROM b) USING (kmer)"),
    "kmer_dual_count": (kmer_dual_count, f"{CTE} SELECT kmer, least(t.n, 255) AS c1, least(coalesce(q.n, 0), 65535) AS c2 FROM (SELECT kmer, count(*) AS n FROM b GROUP BY 1) t LEFT JOIN (SELECT kmer, count(*) AS n FROM d GROUP BY 1) q USING (kmer) WHERE t.n < 255"),
    "kmer_set_filter": (kmer_set_filter, f"{LABELLED} SELECT kmer FROM i EXCEPT SELECT kmer FROM x"),
    "kmer_exclude_overlap": (kmer_exclude_overlap, f"{LABELLED} SELECT kmer FROM i INTERSECT SELECT kmer FROM x"),
    "kmer_exclusive_select": (kmer_exclusive_select, f"{SELECTED} SELECT haplo, count(*) FILTER (included) AS n_included, count(*) FILTER (NOT included) AS n_excluded, CAST(sum(CASE WHEN included THEN 0 ELSE n - g END) AS BIGINT) AS sum_diff FROM s GROUP BY haplo"),
    "kmer_pan_combine": (kmer_pan_combine, f"{SELECTED} SELECT kmer, count(*) AS n_haplo FROM s GROUP BY kmer HAVING bool_and(included)"),
    "kmer_ref_band": (kmer_ref_band, f"WITH d AS ({DOCS}) SELECT kmer, least(count(*), 255) AS cnt FROM d GROUP BY kmer HAVING count(*) BETWEEN 2 AND 254"),
    "kmer_gc_band": (kmer_gc_band, f"WITH b AS ({ITEMS}) SELECT item_id AS target, kmer, least(count(*), 255) AS cnt FROM b WHERE length(regexp_replace(kmer, '[^CG]', '', 'g')) BETWEEN 10 AND 21 GROUP BY 1, 2"),
    "kmer_low_complexity": (kmer_low_complexity, f"WITH b AS ({ITEMS}), k AS (SELECT DISTINCT kmer FROM b), t AS (SELECT kmer, n, max(c) AS c FROM (SELECT kmer, n, substr(kmer, i, n) AS x, count(*) AS c FROM k, (SELECT 2 AS n UNION ALL SELECT 3), unnest(range(1, 31)) AS u(i) WHERE i + n <= 32 GROUP BY ALL) GROUP BY 1, 2), l AS (SELECT kmer, bool_or(c > CASE WHEN n = 2 THEN 9 ELSE 6 END) AS low FROM t GROUP BY kmer) SELECT kmer, low, NOT low AND length(regexp_replace(kmer, '[^CG]', '', 'g')) BETWEEN 10 AND 21 AS informative FROM l"),
    "hotspot_regions": (
        hotspot_regions,
        f"""{CTE}, h AS (SELECT item_id AS target, doc_id AS contig, d.pos + {LEN} AS pos FROM d JOIN (SELECT DISTINCT item_id, kmer FROM b) t ON d.kmer = t.kmer),
s AS (SELECT * FROM (SELECT target, contig, lag(pos, 50) OVER (PARTITION BY target, contig ORDER BY pos) AS start, pos AS "end" FROM h) WHERE "end" - start < 1000),
f AS (SELECT *, CASE WHEN start - lag("end") OVER (PARTITION BY target, contig ORDER BY "end", start) < 1000 THEN 0 ELSE 1 END AS f FROM s),
g AS (SELECT *, sum(f) OVER (PARTITION BY target, contig ORDER BY "end", start ROWS UNBOUNDED PRECEDING) AS g FROM f)
SELECT target, contig, min(start) AS start, max("end") AS "end" FROM g GROUP BY target, contig, g""",
    ),
    "kmer_end_trim": (
        kmer_end_trim,
        f"{CTE}, hits AS (SELECT doc_id, pos, kmer IN (SELECT kmer FROM b) AS h FROM d),"
        + ",".join([TRIM.format(side="left", order="ASC", pick="max", whole="min"), TRIM.format(side="right", order="DESC", pick="min", whole="max")])
        + ' SELECT doc_id, "left", "right" FROM left_ JOIN right_ USING (doc_id)',
    ),
    "group_exclusive_kmers": (group_exclusive_kmers, f"WITH d AS ({DOCS}) SELECT lang, count(*) AS n_kmers, CAST(sum(n) AS BIGINT) AS n_places FROM (SELECT kmer, min(lang) AS lang, count(*) AS n FROM d GROUP BY kmer HAVING count(DISTINCT lang) = 1) GROUP BY lang"),
    "mask_unique_bases": (
        mask_unique_bases,
        f"""{CTE}, s AS (SELECT doc_id, length(regexp_replace(translate(text, '{S.BRIDGE_FROM}', '{S.BRIDGE_TO}'), '[^ACGT]', '', 'g')) AS n_bases FROM documents),
h AS (SELECT doc_id, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) <= {LEN} THEN 0 ELSE 1 END AS f FROM d WHERE kmer IN (SELECT kmer FROM b)),
g AS (SELECT doc_id, max(pos) - min(pos) AS n FROM (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM h) GROUP BY doc_id, g)
SELECT doc_id, CAST(n_bases AS INTEGER) AS n_bases, CAST(coalesce(n, 0) AS INTEGER) AS n_unique FROM s LEFT JOIN (SELECT doc_id, sum(n) AS n FROM g GROUP BY doc_id) USING (doc_id)""",
    ),
}
