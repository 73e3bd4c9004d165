"""K-mer relations: counts, probes, set logic, masks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespan.functions import seq as S
from allelespan.operators import scan, superkmers
from allelespan.sources.staging import staged

#: Largest distinct target set that is sent to all executors.
BROADCAST_ROWS = 2_000_000


def probe(df: DataFrame, bounded: bool) -> DataFrame:
    """Broadcast if the caller has checked its size."""
    return F.broadcast(df) if bounded else df


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    return df.limit(most + 1).count() <= most


def counts(kmers: DataFrame, *by: str, cap: int | None = 255) -> DataFrame:
    """Saturating count of each k-mer, in each `by`."""
    n = F.count("*")
    return kmers.groupBy(*by, "kmer").agg((n if cap is None else F.least(n, F.lit(cap))).alias("cnt"))


def targets(kmers: DataFrame, target: str) -> DataFrame:
    return kmers.select(target, "kmer").distinct()


def target_counts(kmers: DataFrame, found: DataFrame, target: str, *by: str, cap: int = 255, small: bool = False) -> DataFrame:
    """Count of each target k-mer in kmers; one in several targets counts for each. A small target set is probed first, so that
    only its k-mers are counted and shuffled; beside a large one k-mers are summed before the join."""
    if small:
        kmers = kmers.join(F.broadcast(found.select("kmer").distinct()), "kmer", "left_semi")
    summed = kmers.groupBy(*by, "kmer").agg(F.count("*").alias("n"))
    return summed.join(probe(found, small), "kmer").select(*by, target, "kmer", F.least("n", F.lit(cap)).alias("cnt"))


def exclusive(gene: DataFrame, whole: DataFrame, cap: int = 255) -> DataFrame:
    """gene, whole: (haplo, kmer, cnt). Of haplotypes that both have: included where the counts are equal and below the
    cap, else excluded with the difference."""
    both = gene.select("haplo").distinct().join(whole.select("haplo").distinct(), "haplo")
    g, w = gene.join(both, "haplo", "left_semi"), whole.join(both, "haplo", "left_semi")
    g, w = g.select("haplo", "kmer", F.col("cnt").alias("g")), w.select("haplo", "kmer", F.col("cnt").alias("w"))
    return _judged(g.join(w, ["haplo", "kmer"], "full"), cap)


def _judged(counted: DataFrame, cap: int) -> DataFrame:
    """counted: haplo, kmer, g, w; null for none."""
    out = counted.withColumns({"gene_cnt": F.coalesce("g", F.lit(0)), "whole_cnt": F.coalesce("w", F.lit(0))})
    ok = (F.col("gene_cnt") == F.col("whole_cnt")) & (F.col("gene_cnt") < cap)
    return out.select("haplo", "kmer", "gene_cnt", "whole_cnt", ok.alias("included"), F.when(~ok, F.abs(F.col("gene_cnt") - F.col("whole_cnt"))).alias("diff"))


def exclusive_within(counted: DataFrame, cap: int = 255) -> DataFrame:
    """counted: haplo, kmer, g and w, the uncapped counts in the gene's loci and in the whole assembly that holds them. As
    exclusive(), without a join of k-mers: both counts stand in one row. Read twice, so it should be stored."""
    both = counted.groupBy("haplo").agg(F.max("g").alias("most")).where("most > 0").select("haplo")
    capped = counted.join(both, "haplo", "left_semi").select("haplo", "kmer", F.least("g", F.lit(cap)).alias("g"), F.least("w", F.lit(cap)).alias("w"))
    return _judged(capped, cap)


def dual_counts(target: DataFrame, query: DataFrame) -> DataFrame:
    """target, query: (kmer, cnt uncapped). c1 in 1..254, c2 up to 65535."""
    out = target.select("kmer", F.least("cnt", F.lit(255)).alias("c1")).join(query.select("kmer", F.col("cnt").alias("q")), "kmer", "left")
    return out.where("c1 BETWEEN 1 AND 254").select("kmer", "c1", F.least(F.coalesce("q", F.lit(0)), F.lit(65535)).alias("c2"))


def dual_counts_of(target: DataFrame, kmers: DataFrame) -> DataFrame:
    """target: (kmer, cnt uncapped), kmers: kmer, uncounted. As dual_counts(); a small target is probed first, so that only its
    k-mers are counted."""
    small = bounded(target)
    if small:
        kmers = kmers.join(F.broadcast(target.select("kmer")), "kmer", "left_semi")
    return dual_counts(target, counts(kmers, cap=None))


def dual_counts_in(target: DataFrame, seqs: DataFrame, k: int, seq: str = "seq") -> DataFrame:
    """target: (kmer, cnt uncapped). As dual_counts_of(), of the k-mers of sequences; of others no row is made."""
    return dual_counts(target, counts(listed_hits(seqs, target.select("kmer"), k, seq=seq), cap=None))


def selected(gene: DataFrame, whole: DataFrame, k: int, judge: Callable, schema: str) -> DataFrame:
    """gene, whole: haplo, seq. What `judge` makes of the k-mers of haplotypes that both have, counted in both, by superkmers.judged()."""
    long = lambda df: df.where(F.col("haplo").isNotNull() & F.col("seq").rlike(f"[ACGTacgt]{{{k}}}")).select("haplo").distinct()
    both = long(gene).join(long(whole), "haplo")
    rows = [df.select(F.concat(F.lit(part), F.col("haplo").cast("string")).alias("part"), "haplo", "seq") for part, df in (("g", gene), ("w", whole))]
    return superkmers.judged(rows[0].unionByName(rows[1]).join(F.broadcast(both) if bounded(both) else both, "haplo", "left_semi"), "seq", k, "part", judge, schema)


def set_filter(includes: DataFrame, excludes: DataFrame) -> DataFrame:
    """Distinct k-mers of includes; excluded tells those that excludes has too."""
    out = includes.select("kmer").distinct().join(excludes.select("kmer").distinct().withColumn("x", F.lit(True)), "kmer", "left")
    return out.select("kmer", F.col("x").isNotNull().alias("excluded"))


def pan_combine(selected: DataFrame) -> DataFrame:
    """selected: (haplo, kmer, included). K-mers that some haplotype includes and none excludes."""
    return selected.groupBy("kmer").agg(F.bool_and("included").alias("ok"), F.count("*").alias("n_haplo")).where("ok").select("kmer", "n_haplo")


def ref_band(counted: DataFrame, low: int = 1, high: int = 254) -> DataFrame:
    return counted.where(F.col("cnt").between(low, high))


def informative(kmer: Column) -> Column:
    """GC band and complexity together."""
    return S.gc_band(kmer) & ~S.low_complexity(kmer)


def window_gc(df: DataFrame, by: str, pos: str, base: str, size: int = 100, cutoff: float = 0.7) -> DataFrame:
    """df: one row a base. ok: GC of the last `size` bases within (1 - cutoff, cutoff); ok while there are fewer."""
    w = Window.partitionBy(by).orderBy(pos).rowsBetween(-(size - 1), 0)
    gc, n = F.sum(F.when(F.upper(base).isin("G", "C"), 1).otherwise(0)).over(w), F.count("*").over(w)
    return df.withColumn("ok", (n < size) | ((gc > round((1 - cutoff) * size, 6)) & (gc < round(cutoff * size, 6))))


def hotspots(hits: DataFrame, c: int = 50, near: int = 1000, by: tuple[str, ...] = ("target", "contig")) -> DataFrame:
    """hits: by, pos. Runs in which the hit c before is less than `near` away. Hits are numbered over sorted parts, and the hit c before is
    met by its number, so a contig that holds most hits is many tasks."""
    keys = list(by)
    # stored first, as the ranges are found by a pass of their own
    parts = scan.dealt(staged(hits.select(*keys, "pos"), "hits"), keys, ["pos"])
    at = staged(scan.numbered(parts, keys, ["pos"], "n").select(*keys, "pos", "n"), "numbered-hits")
    before = at.select(*(F.col(x).alias(f"_{x}") for x in keys), (F.col("n") + c).alias("_n"), F.col("pos").alias("start"))
    met = F.col("n") == F.col("_n")
    for x in keys:
        met = met & F.col(x).eqNullSafe(F.col(f"_{x}"))
    spans = at.join(before, met).where(F.col("pos") - F.col("start") < near).select(*keys, "start", F.col("pos").alias("end"))
    order = ["end", "start"]
    reached = staged(scan.running_max(scan.dealt(spans, keys, order), keys, order, {"_reach": F.col("end")}), "reached")
    fresh = F.when(F.col("_reach").isNull() | (F.col("start") - F.col("_reach") >= near), F.col("end"))
    islands = scan.running_max(reached, keys, order, {"_island": fresh}).withColumn("_island", F.greatest("_island", fresh))
    return islands.groupBy(*keys, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def end_trim(hits: DataFrame, cutoff: int, hit: int = 9, miss: int = -1, by: str = "name") -> DataFrame:
    """hits: by, pos, is_hit for each k-mer of a sequence. by, left, right: places where the score, which restarts below
    zero, first reaches cutoff * hit from either end; null where it never does. Scores are whole numbers (r = 0.1: +9, -1).
    One shuffle of eight bytes a k-mer; a sequence's marks are folded from both ends in its row."""
    marks = hits.groupBy(by).agg(F.sort_array(F.collect_list(F.col("pos").cast("long") * 2 + F.col("is_hit").cast("int"))).alias("marks"))

    def step(acc: Column, mark: Column) -> Column:
        pos, score = F.shiftright(mark, 1), acc["score"] + F.when(mark % 2 == 1, F.lit(hit)).otherwise(F.lit(miss))
        start = F.when(score < 0, pos).otherwise(F.coalesce(acc["start"], pos))
        held = F.greatest(F.lit(0), score)
        return F.struct(held.alias("score"), start.alias("start"), F.coalesce(acc["edge"], F.when(held >= cutoff * hit, start)).alias("edge"))

    zero = F.struct(F.lit(0).alias("score"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("edge"))
    kind = hits.schema["pos"].dataType
    edge = lambda marks: F.aggregate(marks, zero, step)["edge"].cast(kind)
    return marks.select(by, edge(F.col("marks")).alias("left"), edge(F.reverse("marks")).alias("right"))


def _runs(seq: Column, k: int) -> Column:
    """Runs of ACGT that have k-mers, as (start, n, first): place, number of k-mers, and the number of the first one in the sequence."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("count"), F.array().cast("array<struct<start:int,n:int,first:int>>").alias("runs"))

    def step(acc: Column, piece: Column) -> Column:  # a piece begins with another letter, but for the first
        bad = (~F.substring(piece, 1, 1).isin(*"ACGTacgt")).cast("int")
        n = F.greatest(F.lit(0), F.length(piece) - bad - (k - 1))
        run = F.struct((acc["at"] + bad).alias("start"), n.alias("n"), acc["count"].alias("first"))
        return F.struct((acc["at"] + F.length(piece)).alias("at"), (acc["count"] + n).alias("count"), F.when(n > 0, F.array_append(acc["runs"], run)).otherwise(acc["runs"]).alias("runs"))

    return F.aggregate(F.split(seq, "(?=[^ACGTacgt])"), zero, step)["runs"]


def listed_hits(seqs: DataFrame, listed: DataFrame, k: int, *by: str, seq: str = "seq") -> DataFrame:
    """by, pos and kmer of the k-mers that the list (kmer, distinct) has. A bounded list is probed where the sequences are read."""
    if bounded(listed):
        return superkmers.hits(seqs, seq, k, listed, *by)
    return S.kmers(seqs, seq, k, *by).join(listed.select("kmer"), "kmer", "left_semi")


def end_trim_of(seqs: DataFrame, listed: DataFrame, cutoff: int, k: int, by: str = "name", seq: str = "seq", hit: int = 9, miss: int = -1, hits: DataFrame | None = None) -> DataFrame:
    """As end_trim(), from sequences and the k-mers of the list (kmer, distinct), or their listed_hits. Only hits are shuffled: what stands
    between two of them is a number of misses, which the sequence itself tells."""
    hits = listed_hits(seqs, listed, k, by, seq=seq) if hits is None else hits
    found = hits.groupBy(by).agg(F.sort_array(F.collect_list(F.col("pos").cast("int"))).alias("hits"))
    rows = seqs.select(by, _runs(F.col(seq), k).alias("runs")).where(F.size("runs") > 0).join(found, by, "left")
    last = F.element_at("runs", -1)
    rows = rows.select(by, "runs", (last["first"] + last["n"]).alias("n"), F.coalesce("hits", F.array().cast("array<int>")).alias("hits"))
    own = lambda pos: F.element_at(F.filter("runs", lambda r: r["start"] <= pos), -1)
    numbers = F.transform("hits", lambda pos: own(pos)["first"] + pos - own(pos)["start"])

    def edge(order: Column) -> Column:
        """Number of the k-mer at which the score that reaches the cutoff began."""

        def step(acc: Column, i: Column) -> Column:
            fall = (i - acc["before"] - 1) * -miss
            score = F.when(acc["score"] < fall, F.lit(0)).otherwise(acc["score"] - fall) + hit
            start = F.when(acc["score"] < fall, i - 1).otherwise(acc["start"])
            return F.struct(i.alias("before"), score.alias("score"), start.alias("start"), F.coalesce(acc["edge"], F.when(score >= cutoff * hit, start)).alias("edge"))

        zero = F.struct(F.lit(-1).alias("before"), F.lit(0).alias("score"), F.lit(0).alias("start"), F.lit(None).cast("int").alias("edge"))
        return F.aggregate(order, zero, step)["edge"]

    def pos(i: Column) -> Column:
        run = F.element_at(F.filter("runs", lambda r: r["first"] <= i), -1)
        return run["start"] + i - run["first"]

    rows = rows.withColumn("at", numbers)
    rows = rows.select(by, "runs", edge(F.col("at")).alias("l"), (F.col("n") - 1 - edge(F.reverse(F.transform("at", lambda i: F.col("n") - 1 - i)))).alias("r"))
    return rows.select(by, F.when(F.col("l").isNotNull(), pos(F.col("l"))).alias("left"), F.when(F.col("r").isNotNull(), pos(F.col("r"))).alias("right"))


def masked_runs(hits: DataFrame, k: int = 31, by: str = "name") -> DataFrame:
    """hits: by, pos (start of a k-mer of the set). Runs of hits at most k apart: start, end (half-open) of the bases from the
    first hit's last base to the last hit's last base."""
    w = Window.partitionBy(by).orderBy("pos")
    islands = hits.withColumn("island", F.sum(F.when(F.col("pos") - F.lag("pos").over(w) <= k, 0).otherwise(1)).over(w))
    return islands.groupBy(by, "island").agg((F.min("pos") + k - 1).alias("start"), (F.max("pos") + k - 1).alias("end")).drop("island")


def unmask(seqs: DataFrame, runs: DataFrame, name: str = "name", seq: str = "seq") -> DataFrame:
    """Sequence in lower case, but upper case within the runs."""
    own = runs.groupBy(name).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    start = F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("at"))

    def add(acc: Column, r: Column) -> Column:
        gap = F.lower(F.substring(F.col(seq), (acc["at"] + 1).cast("int"), (r["start"] - acc["at"]).cast("int")))
        run = F.upper(F.substring(F.col(seq), (r["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")))
        return F.struct(F.concat(acc["s"], gap, run).alias("s"), r["end"].cast("long").alias("at"))

    made = F.aggregate(F.coalesce("runs", F.array().cast("array<struct<start:long,end:long>>")), start, add)
    return seqs.join(own, name, "left").withColumn("_m", made).withColumn(seq, F.concat(F.col("_m.s"), F.lower(F.substring(F.col(seq), (F.col("_m.at") + 1).cast("int"), F.length(seq))))).drop("_m", "runs")


def members(kmers: DataFrame, name: str) -> DataFrame:
    """Sequences of each k-mer, with their counts."""
    return kmers.groupBy("kmer", name).agg(F.count("*").alias("cnt"))


def group_exclusive(kmers: DataFrame, group: str) -> DataFrame:
    """K-mers that one group only has."""
    found = kmers.groupBy("kmer").agg(F.min(group).alias("lo"), F.max(group).alias("hi"), F.count("*").alias("n"))
    return found.where("lo = hi").select("kmer", F.col("lo").alias(group), "n")
