"""Composite operators (C1-C9) and the modes of the k-mer program."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelespan.functions import cigar as C
from allelespan.functions import seq as S
from allelespan.operators import annotate, cluster, graph, growth, interval, kmer, repeats, similarity, superkmers
from allelespan.sources.staging import staged


def trim_sequences(seqs: DataFrame, listed: DataFrame, k: int = 31, cutoff: int = 500, ratio: float = 0.1, anchor: int = 5000) -> tuple[DataFrame, DataFrame]:
    """seqs: name, contig, start, end, strand, seq; listed: kmer. Kept sequences, trimmed to their informative part with the
    anchor at both sides, and the k-mers that stay once those of dropped and cut-off parts are gone. cutoff or ratio 0: all
    sequences pass as they are."""
    if not cutoff or not ratio:
        return seqs, listed
    known = staged(listed.select("kmer").distinct(), "listed")
    hits = staged(kmer.listed_hits(seqs, known, k, "name"), "hits")  # all that follows reads hits, never all k-mers
    ends = staged(kmer.end_trim_of(seqs, known, cutoff, k, hit=round(1 / ratio) - 1, hits=hits), "ends")
    inner = hits.join(ends, "name").where("pos BETWEEN left AND right").groupBy("name").agg(F.count("*").alias("n"))
    got = seqs.join(ends, "name", "left").join(inner, "name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    keep = F.col("left").isNotNull() & (F.col("n") >= cutoff) & (F.col("n") >= (F.length("seq") - 2 * anchor) * ratio)
    kept = got.where(keep).withColumns({"lo": F.greatest(F.lit(0), F.col("left") - anchor).cast("long"), "hi": F.least(F.length("seq"), F.col("right") + k + anchor).cast("long")})
    start, end = S.trim_locus(F.col("start"), F.col("end"), F.col("strand"), F.col("lo"), F.col("hi"))
    trimmed = kept.select("name", "contig", start.alias("start"), end.alias("end"), "strand", F.substring(F.col("seq"), (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("seq"))
    spans = kept.select("name", "lo", "hi")
    lost = hits.join(spans, "name", "left").where(F.col("lo").isNull() | (F.col("pos") < F.col("lo")) | (F.col("pos") + k > F.col("hi"))).select("kmer").distinct()
    return trimmed, listed.join(lost, "kmer", "left_anti")


def hotspot_queries(hotspots: DataFrame, contigs: DataFrame, gap: int = 20_000) -> DataFrame:
    """Merged hotspots with their sequences; one without an end has no name."""
    merged = interval.merge(hotspots, ["contig"], gap)
    name = F.concat(F.col("contig").cast("string"), F.lit("_"), F.col("start").cast("string"), F.lit("_"), F.col("end").cast("string"))
    named = merged.select(name.alias("name"), "contig", "start", "end", F.lit("+").alias("strand"))
    return annotate.fetch(named, contigs)


def allele_loci(aligned: DataFrame, contigs: DataFrame, anchor: int = 3000, apart: int = 10_000, same_gene: int = 20_000, margin: int = 100, least: int = 500, keep_cores: bool = False) -> DataFrame:
    """aligned: contig, start, end, strand, gene, is_exon. Loci of alleles with their sequences. Alignments near one another merge; a
    locus is cut between exons that are far apart, and each part ends at its borders, but half a margin beyond its exons; it
    gets the strand of the greater length and its genes (`ENSE` if it has exons only). Parts without exons stay if longer than `least`. All
    grow to five anchors and give way to their neighbours: where the later one starts, or, with keep_cores, in the middle of what
    both grew into."""
    by = ["contig", "locus", "low", "high"]
    gene = F.element_at(F.split("gene", "_"), -1)
    found = interval.loci(aligned, 2 * anchor)
    parts = interval.split_overmerged(found.withColumns({"name": F.col("gene"), "gene": gene}), apart, same_gene)
    exon = lambda f, c: f(F.when(F.col("is_exon"), F.col(c)))
    sums = parts.groupBy(*by).agg(F.min("start").alias("a"), F.max("end").alias("b"), exon(F.min, "start").alias("x"), exon(F.max, "end").alias("y"), interval.strand_vote().alias("strand"), F.array_sort(F.collect_set(F.when(~F.col("is_exon"), F.col("name")))).alias("genes"))
    start, end = F.greatest("a", F.coalesce("low", F.lit(0))), F.least("b", F.coalesce("high", "b"))
    sums = sums.withColumns({"_a": start, "_b": end})
    first = F.when(F.col("x") < F.col("_a") + margin // 2, F.greatest(F.lit(0), F.col("x") - margin // 2)).otherwise(F.col("_a"))
    last = F.when(F.col("y") > F.col("_b") - margin // 2, F.col("y") + margin // 2).otherwise(F.col("_b"))
    named = F.when(F.size("genes") > 0, F.col("genes")).otherwise(F.array(F.lit("ENSE")))
    cores = sums.select("contig", F.concat_ws("_", "contig", "locus", F.coalesce("low", F.lit(0))).alias("id"), first.alias("start"), last.alias("end"), "strand", named.alias("genes"), F.col("x").isNotNull().alias("exon"))
    cores = cores.where(F.col("exon") | (F.col("end") - F.col("start") > least)).drop("exon").withColumns({"_core_start": F.col("start"), "_core_end": F.col("end")})
    start, end = interval.extend_to(5 * anchor)
    order = ("_core_start", "_core_end")
    met = interval.resolve_overlaps(cores.withColumns({"start": start, "end": end}), core=order if keep_cores else ("start", "end"), order=order)
    return annotate.fetch(met.drop("_core_start", "_core_end").withColumnRenamed("id", "name"), contigs)


def masked_trees(seqs: DataFrame, listed: DataFrame, group: str, k: int = 31) -> tuple[DataFrame, DataFrame]:
    """seqs: group, name, seq. Sequences unmasked where listed k-mers stand, and the group's tree by their k-mers."""
    at = kmer.listed_hits(seqs, listed.select("kmer").distinct(), k, group, "name")
    masked = kmer.unmask(seqs, kmer.masked_runs(at.select("name", "pos"), k))
    counts = at.groupBy(group, "name", "kmer").agg(F.count("*").alias("cnt"))
    pair = F.concat_ws("\x01", F.col(group).cast("string"), "kmer")
    pairs = similarity.gram(counts.withColumn("kmer", pair), "name")
    own = similarity.self_weights(counts.withColumn("kmer", pair), "name")
    names = seqs.select(group, "name").distinct()
    matrix = pairs.join(names.select(group, F.col("name").alias("i")), "i").select(group, "i", "j", F.col("m").cast("double").alias("m"))
    whole = names.select(group, F.col("name").alias("i")).join(own, "i", "left").select(group, "i", F.col("i").alias("j"), F.coalesce("own", F.lit(0.0)).alias("m"))
    return masked, cluster.trees(matrix.unionByName(whole), group)


def linear_graph(steps: DataFrame, group: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """steps: allele, segment, strand, start, end, qstart, and group if there is more than one graph. Chunks of the segments, each
    allele's visits to them in order, and the linear order of all visits of a graph."""
    cut = graph.chunks(steps)
    at = cut.withColumnsRenamed({"start": "start2", "end": "end2", "strand": "own"})
    over = interval.overlap_join(steps, at, "segment", 10_000, strict=True)
    chunk = F.concat_ws("_", "segment", F.col("start2").cast("string"), F.col("end2").cast("string"))
    place = F.col("qstart") + F.when(F.col("strand") == "<", F.col("end") - F.col("end2")).otherwise(F.col("start2") - F.col("start"))
    graph_of = F.col(group) if group else F.lit("")
    visits = over.select(graph_of.alias(group or "graph"), "allele", chunk.alias("chunk"), place.alias("place"), F.when(F.col("strand") == F.col("own"), ">").otherwise("<").alias("strand"))
    visits = graph.numbered(visits, "allele", "chunk", "place")
    # a visit's name holds its graph, so that successors of one graph are not counted with those of another
    own = visits.withColumn("visit", F.concat_ws("\x01", F.col(group or "graph").cast("string"), "visit"))
    edges = graph.successors(own, "allele", "visit", "place")
    parts = F.split("next", "\x01", 2)
    edges = edges.select(parts[0].alias(group or "graph"), F.split("visit", "\x01", 2)[1].alias("visit"), parts[1].alias("next"), "n", "first")
    return cut, visits, graph.linear_orders(edges, group or "graph")


def group_names(members: DataFrame, genes: DataFrame, family: str) -> DataFrame:
    """members: group_id, id, chrom, start, end. A display name for each group, by the genes that its reference loci meet."""
    met = interval.overlapping_names(members, genes)
    return met.groupBy("group_id").agg(S.group_name(F.flatten(F.collect_set("genes")), family).alias("name"))


def annotated_types(members: DataFrame, genes: DataFrame) -> DataFrame:
    """members: type, id, tag, ref, exon, chrom, start, end. Tag by majority, genes without read-through names, references."""
    tags = annotate.majority(members, "type", "tag", "exon")
    met = interval.overlapping_names(members.select("type", "id", "chrom", "start", "end"), genes)
    names = met.groupBy("type").agg(S.without_readthrough(F.array_sort(F.array_distinct(F.flatten(F.collect_set("genes"))))).alias("genes"))
    refs = members.groupBy("type").agg(F.sort_array(F.collect_set("ref")).alias("refs"), F.sort_array(F.collect_list("id")).alias("members"))
    return tags.join(names, "type").join(refs, "type")


def lifted(alleles: DataFrame, mapped: DataFrame, refs: DataFrame) -> DataFrame:
    """alleles: id, size, exon; mapped: id, chrom, start, end, cigar (an allele's alignment to the assembly); refs: chrom, start2,
    end2, ref, place. Of each allele the first reference whose locus its alignment strictly overlaps, the inserted bases and
    the kind: Novel(trans) where the alignment meets no reference, Novel(unmap) where there is none. Each allele keeps its own
    exon flag."""
    found = interval.first_overlap(mapped, refs, "place").select("id", "ref", "cigar", F.concat(F.col("chrom"), F.lit(":"), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string")).alias("ref_align"))
    best = alleles.join(found, "id", "left")
    inserted = F.when(F.col("ref").isNotNull(), C.length(F.col("cigar"), "I"))
    return best.withColumn("inserted", inserted).withColumn("kind", C.insert_kind(F.col("inserted"), F.col("size"), F.col("cigar").isNotNull())).drop("cigar")


def exclusive_kmers(gene: DataFrame, whole: DataFrame, k: int = 31) -> DataFrame:
    """gene, whole: haplo, seq. K-mers that stand nowhere but in the gene's loci, over all haplotypes in one job."""
    return kmer.selected(gene, whole, k, superkmers.combined, "kmer string, n_haplo long")


def convert(mode: int, inputs: DataFrame, targets: DataFrame | None = None, k: int = 31, c: int = 50) -> dict[str, DataFrame]:
    """The k-mer program. inputs: name, seq (mode 3: also excluded); targets: target, seq. 0: counts; 1: hotspots; 2: both;
    3: included and excluded k-mers; 4: dual counts."""
    found = kmer.targets(S.kmers(targets, "seq", k, "target"), "target") if targets is not None else None
    out = {}
    if mode == 0 or (mode == 2 and found is None):
        out["counts"] = superkmers.counts(inputs, "seq", k)
    if mode in (1, 2) and found is not None:
        at = kmer.listed_hits(inputs, found.select("kmer").distinct(), k, "name")
        small = kmer.bounded(found)
        if mode == 2:
            out["counts"] = kmer.target_counts(at, found, "target", "name", small=small)
        hits = at.join(kmer.probe(found, small), "kmer").select("target", F.col("name").alias("contig"), (F.col("pos") + k).alias("pos"))
        out["hotspots"] = kmer.hotspots(hits, c)
    if mode == 3:
        out["kmers"] = superkmers.judged(inputs, "seq", k, "excluded", superkmers.of_sets, "kmer string, excluded boolean")
    if mode == 4:
        out["dual"] = kmer.dual_counts_in(kmer.counts(S.kmers(targets, "seq", k, "target"), cap=None), inputs, k)
    return out


def graph_pipeline(alleles: DataFrame, group: str, selfhits: DataFrame | None = None, aligned: DataFrame | None = None, k: int = 31, gap: int = 30, pad: int = 60, least: int = 300, shortest: int = 151) -> dict[str, DataFrame]:
    """alleles: group, name, seq. Every stage of each group's graph: segments as it grows; kept, segments without repeats; paths of the alleles;
    chunks, visits and linear order. selfhits (columns of repeats.self_hits) and aligned (those of graph.paths, with the group, over the
    names in kept) come from an aligner where there is one, else from shared k-mers."""
    ids = alleles.select(group, F.col("name").cast("string").alias("name"), "seq")
    made = staged(growth.graphs(ids, group, lambda: growth.KmerSet(k), gap, pad, least), "segments")
    whole = key_of(group, "segment")
    named = made.select(group, whole.alias("segment"), "seq", "place")
    if selfhits is None:
        selfhits = repeats.self_hits(named, group)
    else:
        selfhits = selfhits.withColumn("segment", whole)
    spans = repeats.without_repeats(selfhits, named.select("segment", F.length("seq").alias("size")), gap, gap, shortest)
    part = F.substring(F.col("seq"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    short = F.split(F.col("segment"), "\x01")[1]
    kept = staged(spans.join(named, "segment").select(group, F.concat_ws("_", short, "start", "end").alias("segment"), part.alias("seq")), "kept")
    found = repeats.exact_hits(ids, kept, group, k, best=True) if aligned is None else aligned
    path = graph.paths(found.withColumn("allele", key_of(group, "allele")))
    groups = ids.select(group, key_of(group, "name").alias("allele")).distinct()
    path = staged(path.join(groups, "allele"), "paths")
    step = path.select(group, "allele", F.explode("steps").alias("s"))
    step = step.withColumn("name", F.expr("substring(s.step, 2)"))
    steps = step.select(group, "allele", key_of(group, "name").alias("segment"), F.substring("s.step", 1, 1).alias("strand"), F.col("s.rstart").alias("start"), F.col("s.rend").alias("end"), F.col("s.qstart").alias("qstart"))
    cut, visits, order = linear_graph(steps, group)
    bare = lambda df, *cs: df.withColumns({c: F.regexp_replace(c, "^[^\x01]*\x01", "") for c in cs})
    return {"segments": made, "kept": kept, "paths": bare(path, "allele"), "chunks": cut, "visits": bare(visits, "allele", "chunk", "visit"), "order": bare(order, "chunk")}


def key_of(group: str, name: str) -> Column:
    """A name that is told apart between graphs."""
    return F.concat_ws("\x01", F.col(group).cast("string"), F.col(name))


def leaf_ranks(trees: DataFrame, group: str) -> DataFrame:
    return trees.select(group, F.posexplode("leaves").alias("leaf", "name"))


def occurrence(by: str, order: str) -> Column:
    return F.row_number().over(Window.partitionBy(by).orderBy(order))
