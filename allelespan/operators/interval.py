"""Intervals: merges, gaps, overlap joins, envelopes, edges.

Intervals are (start, end) columns. Overlap joins cut the line into bins, join on the bin and keep each pair in the bin where
the later of the two begins, so no pair comes twice and nothing is compared with all else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespan.operators import scan
from allelespan.sources.staging import staged


def islands(df: DataFrame, by: list[str], gap: int = 0) -> DataFrame:
    """Adds island: a number for each run of intervals with at most `gap` between one's start and all ends before it. An interval without
    an end comes last of those with its start, so that it ends no run that goes on."""
    w = Window.partitionBy(*by).orderBy(F.asc_nulls_last("start"), F.asc_nulls_last("end"))
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_f", F.when(F.col("start") - before <= gap, 0).otherwise(1)).withColumn("island", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_f")


def merge(df: DataFrame, by: list[str], gap: int = 20_000, pad: int | None = None) -> DataFrame:
    """Merged intervals and how many each has; padded by half the gap, from 0 on."""
    pad = gap // 2 if pad is None else pad
    out = islands(df, by, gap).groupBy(*by, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"))
    return out.select(*by, F.greatest(F.lit(0), F.col("start") - pad).alias("start"), (F.col("end") + pad).alias("end"), "n")


def gaps(df: DataFrame, by: list[str], least: int = 30, sizes: DataFrame | None = None) -> DataFrame:
    """Stretches of more than `least` that no interval covers; with sizes (by, size) also before the first and after the last."""
    runs = merge(df, by, 0, 0)
    if sizes is not None:
        ends = sizes.select(*by, F.explode(F.array(F.lit(0).cast("long"), F.col("size").cast("long"))).alias("start")).withColumn("end", F.col("start"))
        runs = runs.select(*by, "start", "end").unionByName(ends)
    w = Window.partitionBy(*by).orderBy("start", "end")
    return runs.select(*by, F.col("end").alias("start"), F.lead("start").over(w).alias("end")).where(F.col("end") - F.col("start") > least)


def overlap_join(a: DataFrame, b: DataFrame, on: str, bin_size: int, strict: bool = False) -> DataFrame:
    """Pairs of a and b that overlap on the same `on`; b's other columns must have other names than a's, its interval is
    (start2, end2). Closed intervals: touching counts, unless strict."""
    spread = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / bin_size), F.floor(F.col(hi) / bin_size)))
    x, y = a.where("start <= end").withColumn("_bin", spread("start", "end")), b.where("start2 <= end2").withColumn("_bin", spread("start2", "end2"))
    meets = (F.col("start") < F.col("end2")) & (F.col("start2") < F.col("end")) if strict else (F.col("start") <= F.col("end2")) & (F.col("start2") <= F.col("end"))
    later = F.floor(F.greatest("start", "start2") / bin_size)
    return x.join(y, [on, "_bin"]).where(meets & (F.col("_bin") == later)).drop("_bin")


def overlapping_names(loci: DataFrame, genes: DataFrame, bin_size: int = 100_000) -> DataFrame:
    """loci: id, chrom, start, end; genes: chrom, start2, end2, gene. genes: sorted names of those that a locus meets."""
    pairs = overlap_join(loci, genes, "chrom", bin_size).groupBy("id").agg(F.sort_array(F.collect_set("gene")).alias("genes"))
    return loci.join(pairs, "id", "left").withColumn("genes", F.coalesce("genes", F.array().cast("array<string>")))


def first_overlap(loci: DataFrame, found: DataFrame, order: str, bin_size: int = 100_000) -> DataFrame:
    """For each locus (id) the strictly overlapping row of found with the smallest `order`; null columns where there is none."""
    w = Window.partitionBy("id").orderBy(order)
    best = overlap_join(loci, found, "chrom", bin_size, strict=True).withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return loci.join(best.select("id", *(c for c in found.columns if c != "chrom")), "id", "left")


def without_errors(loci: DataFrame, errors: DataFrame, bin_size: int = 100_000) -> DataFrame:
    """Loci that touch no error region."""
    hit = overlap_join(loci, errors, "chrom", bin_size).select("id").distinct()
    return loci.join(hit, "id", "left_anti")


REFERENCE_CONTIG = "chr|NC_0609|CN000|HQ100"


def edge_filter(loci: DataFrame, sizes: DataFrame, is_ref: Column, cutoff: int = 20_000, unknown: int = 1_000_000_000) -> DataFrame:
    """loci: name, contig, start, end. Keeps those as far from both ends of their contig as the nearest reference locus is,
    halved, or the cutoff if that is less; contigs of references stay."""
    sized = loci.join(sizes, "contig", "left").withColumn("size", F.coalesce("size", F.lit(unknown)))
    sized = sized.withColumn("edge", F.least(F.col("start"), F.col("size") - F.col("end")))
    least = sized.where(is_ref).agg(F.min("edge").alias("m")).select((F.coalesce(F.col("m"), F.lit(2 * cutoff)) / 2).alias("half"))
    needed = F.when(F.col("name").rlike(REFERENCE_CONTIG) | F.col("contig").rlike(REFERENCE_CONTIG), F.lit(0.0)).otherwise(F.least(F.lit(float(cutoff)), F.col("half")))
    return sized.withColumn("half", least.scalar()).where(F.col("edge") >= needed).drop("half")


def envelope(df: DataFrame, by: str, bin_size: int, least: int = 30) -> DataFrame:
    """df: by, id, start, end (half-open), score. At each place the interval of the highest score (smallest id of equals);
    neighbouring places of one interval together; pieces of at most `least` go."""
    places = df.select(by, F.col("start").alias("p")).union(df.select(by, F.col("end").alias("p"))).distinct()
    w = Window.partitionBy(by).orderBy("p")
    cuts = places.select(by, F.col("p").alias("start2"), F.lead("p").over(w).alias("end2")).where("end2 IS NOT NULL")
    over = overlap_join(df, cuts, by, bin_size, strict=True)
    best = over.withColumn("_r", F.row_number().over(Window.partitionBy(by, "start2").orderBy(F.desc("score"), "id"))).where("_r = 1")
    w = Window.partitionBy(by).orderBy("start2")
    fresh = F.when((F.lag("id").over(w) == F.col("id")) & (F.lag("end2").over(w) == F.col("start2")), 0).otherwise(1)
    runs = best.withColumn("_f", fresh).withColumn("_g", F.sum("_f").over(w))
    out = runs.groupBy(by, "_g", "id").agg(F.min("start2").alias("start"), F.max("end2").alias("end"))
    return out.where(F.col("end") - F.col("start") > least).drop("_g")


def collapse(df: DataFrame) -> DataFrame:
    """BED rows of one name, chrom, strand and gene as one; a name that stays more than once gets 00N from the second on."""
    one = df.groupBy("name", "chrom", "strand", "gene").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    n = F.row_number().over(Window.partitionBy("name").orderBy("chrom", "start", "end", "strand", "gene"))
    return one.withColumn("n", n).withColumn("name", F.when(F.col("n") > 1, F.concat("name", F.lit("00"), F.col("n").cast("string"))).otherwise(F.col("name"))).drop("n")


def strand_vote() -> Column:
    """Aggregate: the strand with the greater length; + for equals."""
    size = F.col("end") - F.col("start")
    return F.when(F.sum(F.when(F.col("strand") == "-", size).otherwise(0)) > F.sum(F.when(F.col("strand") == "-", 0).otherwise(size)), "-").otherwise("+")


def extend_to(least: int) -> tuple[Column, Column]:
    """Start and end of a locus that is grown on both sides to the least size, from 0 on."""
    more = F.greatest(F.lit(0), F.lit(least) - (F.col("end") - F.col("start")))
    half = F.floor(more / 2)
    return F.greatest(F.lit(0), F.col("start") - half), F.col("end") + half


def break_clusters(df: DataFrame, by: str, near: int = 50) -> DataFrame:
    """df: by, pos. Places less than `near` from the one before stand together; pos: the most frequent, the smallest of equals."""
    w = Window.partitionBy(by).orderBy("pos")
    rows = df.withColumn("_f", F.when(F.col("pos") - F.lag("pos").over(w) < near, 0).otherwise(1)).withColumn("cluster", F.sum("_f").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    n = rows.groupBy(by, "cluster", "pos").agg(F.count("*").alias("n"))
    return n.groupBy(by, "cluster").agg(F.sum("n").alias("n_breaks"), F.max(F.struct("n", (-F.col("pos")).alias("m")))["m"].alias("m")).select(by, (-F.col("m")).alias("pos"), "n_breaks")


def resolve_overlaps(df: DataFrame, by: str = "contig", core: tuple[str, str] = ("start", "end"), order: tuple[str, str] = ("start", "end")) -> DataFrame:
    """df: by, id, start, end. In order, a locus that begins before the one before it ends meets it at the middle of
    the overlap, but not before the core of the one has ended nor after the core of the other has begun; where cores overlap, the
    later start counts. core: what a locus was before it was extended; by default it is the locus itself, so the earlier one ends
    where the later one starts. A locus does not end before it starts."""
    w = Window.partitionBy(by).orderBy(*order, "id")
    middle = lambda start, end, core_end, core_start: F.least(F.greatest(F.floor((start + end) / 2), core_end), core_start)
    before = middle(F.col("start"), F.lag("end").over(w), F.lag(core[1]).over(w), F.col(core[0]))
    after = middle(F.lead("start").over(w), F.col("end"), F.col(core[1]), F.lead(core[0]).over(w))
    at = df.withColumns({"_s": F.when(F.col("start") < F.lag("end").over(w), before), "_e": F.when(F.lead("start").over(w) < F.col("end"), after)})
    kinds = {c: df.schema[c].dataType for c in ("start", "end")}
    at = at.withColumns({"start": F.coalesce("_s", "start").cast(kinds["start"]), "end": F.coalesce("_e", "end").cast(kinds["end"])})
    return at.withColumn("end", F.greatest("start", "end")).drop("_s", "_e")


def loci(df: DataFrame, gap: int) -> DataFrame:
    """df: contig, start, end. Adds locus: the start of the run of intervals it stands in, with at most `gap` between one's start and
    all ends before it. A contig of any size is many tasks."""
    by, order = ["contig"], ["start", "end"]
    parts = scan.dealt(df, by, order)
    reached = staged(scan.running_max(parts, by, order, {"_reach": F.col("end")}), "reached")
    fresh = F.when(F.col("_reach").isNull() | (F.col("start") - F.col("_reach") > gap), F.col("start"))
    out = scan.running_max(reached, by, order, {"locus": fresh})
    return out.withColumn("locus", F.greatest("locus", fresh)).drop("_reach", "_part", "_row")


def exon_borders(df: DataFrame, apart: int = 10_000, same_gene: int = 20_000) -> DataFrame:
    """df: contig, locus, start, end, gene, is_exon. contig, locus, at: the middle between an exon and all before it in its locus, if they
    end more than `apart` before and no gene that goes on has ended same_gene or less before. A gene that pauses at e and goes
    on at s forbids borders before exons at e + 1 to min(s, e + same_gene), so the open genes of a place are intervals too, and
    all that is carried along a locus is how far exons and pauses reach."""
    by, order = ["contig", "locus"], ["start", "_pause"]
    exons = df.where("is_exon").select("contig", "locus", "start", "end", "gene")
    own = scan.dealt(exons, [*by, "gene"], ["start", "end"])
    paused = scan.running_max(own, [*by, "gene"], ["start", "end"], {"_reach": F.col("end")}).where("start > _reach")
    pauses = paused.select(*by, F.col("_reach").alias("start"), F.lit(None).cast("long").alias("end"), F.least(F.col("start"), F.col("_reach") + same_gene).alias("_pause"))
    events = exons.select(*by, "start", F.col("end").cast("long").alias("end"), F.lit(None).cast("long").alias("_pause")).unionByName(pauses)
    at = scan.running_max(scan.dealt(events, by, order), by, order, {"_reach": F.col("end"), "_open": F.col("_pause")})
    cut = at.where(F.col("end").isNotNull() & (F.col("start") - F.col("_reach") > apart) & F.coalesce(F.col("_open") < F.col("start"), F.lit(True)))
    return cut.select(*by, F.floor((F.col("start") + F.col("_reach")) / 2).alias("at"))


def split_overmerged(df: DataFrame, apart: int = 10_000, same_gene: int = 20_000) -> DataFrame:
    """df: contig, locus, start, end, gene, is_exon. A row for each part of its locus that an alignment's start or end stands in, with
    the borders of the part (low, null before the first; high, null after the last); a place on a border belongs to what is
    before it."""
    by, order = ["contig", "locus"], ["_at", "_border"]
    borders = staged(exon_borders(df, apart, same_gene).distinct(), "borders")
    rows = staged(df.withColumn("_id", F.monotonically_increasing_id()), "alignments")
    places = rows.select(*by, F.explode(F.array("start", "end")).alias("_at"), "_id", F.lit(None).cast("long").alias("_border"))
    marks = borders.select(*by, F.col("at").alias("_at"), F.lit(None).cast("long").alias("_id"), F.col("at").alias("_border"))
    # nulls sort first, so a border comes after the places it shares
    met = scan.running_max(scan.dealt(places.unionByName(marks), by, order), by, order, {"low": F.col("_border")})
    parts = met.where("_id IS NOT NULL").select("_id", "low").distinct()
    ahead = Window.partitionBy(*by).orderBy("low")
    spans = borders.select(*by, F.col("at").alias("low")).unionByName(borders.select(*by).distinct().withColumn("low", F.lit(None).cast("long")))
    spans = spans.withColumn("high", F.lead("low").over(ahead)).withColumn("_low", F.coalesce("low", F.lit(-1))).drop("low")
    out = rows.join(parts, "_id").drop("_id").withColumn("_low", F.coalesce("low", F.lit(-1)))
    return out.join(spans, [*by, "_low"], "left").drop("_low")
