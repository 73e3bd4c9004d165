"""Benchmark decontamination through a positional inverted index of the training texts.

Index: terms are pairs of neighbouring words (a next-word index; single words stand in long lists and cost four times the
disk). One row for each place of each training pair that some test item has: row number, position, term. It is stored once
(Parquet in the shared folder), with one row for each text that holds its id and number of words. Texts are read once.

Search: test items become windows of `size` consecutive words. The lists of a window's rarest terms (by their number of
postings, counted exactly over the index) are read, shifted by the terms' offsets and intersected; where they agree, a
start is a candidate, and the lists of the window's other terms, of the rows that have candidates, must agree as well.
A match is thus exact, with nothing hashed. `proximity` finds places at which the rarest terms stand near one another, where
all but one of them would make the window start within 2 * SLOP words; `contaminated` reports the items found that way in a
column of their own, and decides by exact matches only. Pairs that no test item has are not stored, so a new benchmark
needs a new index: with all pairs of the corpus, lists of common words would be as long as the corpus.

Only test terms, windows and their items are broadcast, each only while it has at most BOUND rows; beyond that the same joins are
shuffled, with hot terms split by adaptive execution. Test windows of equal text are one.

Edge cases: null and empty texts have no words, no hits and no items; items without words have no window. Repeated rows are
told apart by row numbers that are stored with the index. Items shorter than a window are one window. Extra columns are not
read. Empty tables give no rows or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import ascii_lower, numbered, staged, table

SIZE = 10
RAREST = 3
SLOP = 5
BOUND = 500_000


#: What stands between words: all of ASCII but letters and digits.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Cut at all that is no word, which is far quicker than to extract words."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


class Windows:
    """Test windows and their terms; `small` tells whether they may be broadcast."""

    def __init__(self, items: DataFrame, item_id: str, text: str, size: int = SIZE):
        words = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
        cut = words.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s"), F.lit(size)).alias("w"))
        self.items = staged(cut.select(F.array_join("w", " ").alias("window"), "item_id").distinct(), "test-windows")
        words = self.items.select("window").distinct().select("window", F.split("window", " ").alias("w"))
        pairs = F.zip_with("w", F.slice("w", 2, F.size("w")), lambda a, b: F.concat(a, F.lit(" "), b))
        terms = F.when(F.size("w") > 1, F.filter(pairs, lambda p: p.isNotNull())).otherwise(F.col("w"))
        self.terms = staged(words.select("window", F.size("w").alias("words"), F.size(terms).alias("terms"), F.posexplode(terms).alias("offset", "term")), "test-terms")
        self.small = self.terms.count() <= BOUND
        self.few = self.items.count() <= BOUND  # one text may be that of any number of items
        self.single = not self.terms.where("words = 1").isEmpty()

    def joined(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.small else df

    def items_of(self, found: DataFrame) -> DataFrame:
        """found: row, window. row, items: the sorted ids of the items that have the windows."""
        own = found.select("row", "window").distinct().join(F.broadcast(self.items) if self.few else self.items, "window")
        return own.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def index(docs: DataFrame, doc_id: str, text: str, windows: Windows) -> tuple[DataFrame, DataFrame]:
    """Postings (row, pos, term) of the test terms, and the texts (row, doc_id, n_words)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("w"))
    # place 0 is the text itself, so that one pass stores both with the same row numbers; its term is a pair of nothing
    pairs = F.arrays_zip(F.concat(F.array(F.lit("")), F.col("w")).alias("a"), F.concat(F.array(F.lit("")), F.slice("w", 2, F.greatest(F.lit(1), F.size("w")))).alias("b"))
    places = rows.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode(pairs).alias("pos", "p")).select("row", "doc_id", "n_words", "pos", "p.a", "p.b")
    pair = F.concat("a", F.lit(" "), "b")
    if windows.single:  # items of one word: its own list
        places = places.select("row", "doc_id", "n_words", "pos", F.explode(F.array(pair, F.when(F.col("pos") > 0, F.col("a")))).alias("term"))
    else:
        places = places.select("row", "doc_id", "n_words", "pos", pair.alias("term"))
    known = windows.terms.select("term").union(docs.sparkSession.range(1).select(F.lit(" ").alias("term"))).distinct()
    first = F.col("pos") == 0
    kept = places.join(windows.joined(known), "term").select("row", (F.col("pos") - 1).alias("pos"), "term", F.when(first, F.col("doc_id")).alias("doc_id"), F.when(first, F.col("n_words")).alias("n_words"))
    stored = staged(kept, "postings")
    return stored.where("pos >= 0").select("row", "pos", "term"), stored.where("pos < 0").select("row", "doc_id", F.col("n_words").cast("long").alias("n_words"))


def _rarest(postings: DataFrame, windows: Windows, rarest: int) -> DataFrame:
    """Terms of the windows with n (their postings) and place (1: the rarest); windows with a term that no text has are left out."""
    n = staged(postings.groupBy("term").agg(F.count("*").alias("n")), "term-counts")
    counted = windows.terms.join(F.broadcast(n) if windows.small else n, "term", "left")
    own = Window.partitionBy("window")
    counted = counted.withColumns({"place": F.row_number().over(own.orderBy(F.col("n").asc_nulls_first(), "offset")), "least": F.min(F.coalesce("n", F.lit(0))).over(own)})
    return staged(counted.where("least > 0").select("window", "offset", "term", "terms", "words", "place", F.least(F.lit(rarest), "terms").alias("asked")), "rarest-terms")


def matches(postings: DataFrame, windows: Windows, rarest: int = RAREST, ranked: DataFrame | None = None) -> DataFrame:
    """row, start, window, words (of the window): each exact place of each window. ranked: the windows' terms, if at hand."""
    ranked = _rarest(postings, windows, rarest) if ranked is None else ranked
    asked, rest = ranked.where("place <= asked"), ranked.where("place > asked")
    shifted = postings.join(windows.joined(asked), "term").select("row", "window", (F.col("pos") - F.col("offset")).alias("start"), "asked", "terms", "words")
    found = shifted.where("start >= 0").groupBy("row", "window", "start").agg(F.count("*").alias("n"), F.first("asked").alias("asked"), F.first("terms").alias("terms"), F.first("words").alias("words"))
    found = staged(found.where("n = asked").select("row", "window", "start", "terms", "words"), "candidates")
    # the other terms of the rows that have candidates must stand in their places
    wanted = found.where(F.col("terms") > rarest).join(windows.joined(rest.select("window", "offset", "term")), "window")
    wanted = wanted.select("row", "window", "start", "terms", "words", (F.col("start") + F.col("offset")).alias("pos"), "term")
    rows = staged(found.where(F.col("terms") > rarest).select("row").distinct(), "candidate-rows")
    there = wanted.join(postings.join(rows, "row", "left_semi"), ["row", "pos", "term"])
    exact = there.groupBy("row", "window", "start", "terms", "words").agg(F.count("*").alias("n")).where(F.col("n") == F.col("terms") - rarest)
    return found.where(F.col("terms") <= rarest).select("row", "window", "start", "words").union(exact.select("row", "window", "start", "words"))


def proximity(postings: DataFrame, windows: Windows, slop: int = SLOP, missing: int = 1, rarest: int = RAREST, ranked: DataFrame | None = None) -> DataFrame:
    """row, window, start: where the window's rarest terms, all but `missing` of them, stand so that each would make the window
    start at `start` or up to 2 * slop words later."""
    asked = (_rarest(postings, windows, rarest) if ranked is None else ranked).where("place <= asked").select("window", "offset", "term", "place", "asked")
    near = postings.join(windows.joined(asked), "term").select("row", "window", "asked", "place", (F.col("pos") - F.col("offset")).cast("long").alias("start"))
    ahead = Window.partitionBy("row", "window").orderBy("start").rangeBetween(0, 2 * slop)
    met = F.bit_count(F.bit_or(F.expr("shiftleft(1L, place)")).over(ahead))
    return near.withColumn("met", met).where(F.col("met") >= F.greatest(F.lit(1), F.col("asked") - missing)).select("row", "window", "start")


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = SIZE, near: bool = True) -> DataFrame:
    """row, doc_id, n_words, n_hit (words inside some window) and the sorted ids of the items found, of every text; near: also
    near_items, those found by proximity, exact ones among them."""
    windows = Windows(items, item_id, item_text, size)
    postings, texts = index(docs, doc_id, text, windows)
    ranked = _rarest(postings, windows, RAREST)
    found = staged(matches(postings, windows, RAREST, ranked), "matches")
    spans = found.groupBy("row", "start").agg(F.max("words").alias("words")).select("row", "start", (F.col("start") + F.col("words")).alias("stop"))
    before = F.max("stop").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("before", F.lit(0))))
    hits = spans.withColumn("before", before).groupBy("row").agg(F.sum(fresh).alias("n_hit"))
    none = F.array().cast("array<string>")
    out = texts.join(hits, "row", "left").join(windows.items_of(found), "row", "left")
    out = out.select("row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
    if near:
        around = windows.items_of(proximity(postings, windows, ranked=ranked)).withColumnRenamed("items", "near_items")
        out = out.join(around, "row", "left").withColumn("near_items", F.coalesce("near_items", none))
    return out


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined = lambda c: F.sha2(F.array_join(c, ","), 256)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), joined("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), F.size("near_items").cast("long").alias("n_near_items"), joined("near_items").alias("near_items_sha256"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    rows, row = numbered(docs, "decontaminate-rows")
    hit = contaminated(rows, table(spark, sf_dir, "benchmark"), doc_id=row, near=False).where("n_hit > 0").select(F.col("doc_id").alias(row))
    return rows.join(staged(hit, "contaminated"), row, "left_anti").select(docs.columns)


OP5_SQL = """
WITH w AS (
  SELECT rowid AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS k FROM win),
occ AS (
  SELECT d.r, d.s, d.k, win.item_id
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM w, sizes WHERE len(w) >= k) d
  JOIN win ON list_slice(d.w, d.s, d.s + d.k - 1) = win.win),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM occ GROUP BY r),
texts AS (SELECT DISTINCT win FROM win),
places AS (
  SELECT r, s - 1 AS pos, CASE WHEN s < len(w) THEN w[s] || ' ' || w[s + 1] END AS two, w[s] AS one
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM w)),
terms AS (
  SELECT win, o - 1 AS off, CASE WHEN len(win) = 1 THEN win[1] ELSE win[o] || ' ' || win[o + 1] END AS term, greatest(1, len(win) - 1) AS n_terms
  FROM (SELECT win, unnest(range(1, greatest(1, len(win) - 1) + 1)) AS o FROM texts)),
posted AS (
  SELECT r, pos, two AS term FROM places WHERE two IN (SELECT term FROM terms)
  UNION ALL SELECT r, pos, one FROM places WHERE one IN (SELECT term FROM terms WHERE n_terms = 1 AND len(win) = 1)),
counted AS (SELECT term, count(*) AS n FROM posted GROUP BY 1),
ranked AS (
  SELECT terms.*, row_number() OVER (PARTITION BY win ORDER BY n NULLS FIRST, off) AS place, min(coalesce(n, 0)) OVER (PARTITION BY win) AS least
  FROM terms LEFT JOIN counted USING (term)),
starts AS (
  SELECT p.r, k.win, k.n_terms, p.pos - k.off AS s, bit_or(1 << k.place) OVER (PARTITION BY p.r, k.win ORDER BY p.pos - k.off RANGE BETWEEN CURRENT ROW AND 10 FOLLOWING) AS met
  FROM posted p JOIN ranked k USING (term) WHERE k.least > 0 AND k.place <= least(3, k.n_terms)),
around AS (
  SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS near FROM starts JOIN win USING (win) WHERE bit_count(met) >= greatest(1, least(3, n_terms) - 1) GROUP BY r)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(len(near), 0) AS BIGINT) AS n_near_items, sha256(coalesce(array_to_string(near, ','), '')) AS near_items_sha256
FROM w LEFT JOIN hit USING (r) LEFT JOIN its USING (r) LEFT JOIN around USING (r)
"""
