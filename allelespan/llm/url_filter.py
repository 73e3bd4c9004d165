"""URL filter: host and path rules, then the ratio of two character language models.

Rules fit a host and its subdomains and a path prefix; the longest rule wins. URLs that no rule fits are judged by two
smoothed variable-order Markov models of the characters of host and path in lower case, one learned from the URLs
that rules allow and one from those that rules block. Each order's estimate is smoothed towards the next lower order:
p_k = (count(context, char) + STRENGTH * p_(k-1)) / (count(context) + STRENGTH), from a uniform p_0. The score is the
difference of the log-likelihoods a character. A fifth of the labelled URLs, by hash, is kept out of training; the
threshold is the one with the best balanced accuracy on it.

Counts are held in hashed slots: SLOTS of them, doubled until there are LOAD for each distinct gram and context of the
training URLs, so the share of grams that meet in a slot does not grow with the input. The model is one row, summed over
all labelled rows; it grows with the distinct grams. All of it is DataFrame functions.

Edge cases: a null url or one without `://` has empty host and path, fits no rule and scores 0, so it is blocked where the
threshold is above 0 and allowed elsewhere. Empty tables and tables
without labelled rows give scores and threshold 0, so all is allowed. Repeated rows get equal answers. Extra columns are
carried along by `judge`; columns of the names that it adds are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import ascii_lower, free_name, staged, table

#: Fewest slots, and slots for each distinct gram at least.
SLOTS, LOAD = 1 << 17, 8
ORDERS = 5
STRENGTH = 2.0
SYMBOLS = 64.0
#: Scores are counted in steps of 1/STEPS when the threshold is sought, within +-EDGE.
STEPS, EDGE = 50, 5
FOLDS = 5

#: The contract's rules: host, path prefix, verdict.
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct of the longest rule that fits and its verdict, or null."""
    found = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def characters(host: Column, path: Column) -> Column:
    """What the models read."""
    return F.lower(F.concat(host, path))


def _slot(gram: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(gram), slots)


def _context(s: Column, i: Column, k: int) -> Column:
    """The k characters before place i (from 1); s is padded with ORDERS - 1 marks in front."""
    return F.substring(s, i + (ORDERS - 1 - k), F.lit(k)) if k else F.lit("")


def _padded(s: str) -> Column:
    return F.concat(F.lit("^" * (ORDERS - 1)), F.col(s))


def _places(s: str) -> Column:
    return F.when(F.length(s) > 0, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))


def slots_for(n: int) -> int:
    """Slots for n distinct grams and contexts."""
    slots = SLOTS
    while slots < LOAD * n:
        slots *= 2
    return slots


def model(labelled: DataFrame) -> DataFrame:
    """labelled: s (string), ok (boolean). One row: m, a struct of two arrays of counts, one a slot."""
    rows = labelled.select(_padded("s").alias("p"), "ok", F.explode(_places("s")).alias("i"))
    grams = []
    for k in range(ORDERS):
        ctx = _context(F.col("p"), F.col("i"), k)
        grams += [F.concat(ctx, F.substring(F.col("p"), F.col("i") + (ORDERS - 1), F.lit(1))), F.concat(ctx, F.lit("\n"))]
    counts = rows.select("ok", F.explode(F.array(*grams)).alias("gram")).groupBy("gram").agg(F.count_if("ok").alias("a"), F.count_if(~F.col("ok")).alias("r"))
    counts = staged(counts, "url-grams")
    slots = slots_for(counts.count())
    counts = counts.groupBy(_slot(F.col("gram"), F.lit(slots)).alias("slot")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    full = labelled.sparkSession.range(slots).withColumnRenamed("id", "slot").join(counts, "slot", "left")
    one = full.agg(F.sort_array(F.collect_list(F.struct("slot", F.coalesce("a", F.lit(0)).cast("double").alias("a"), F.coalesce("r", F.lit(0)).cast("double").alias("r")))).alias("x"))
    return one.select(F.struct(F.col("x.a").alias("a"), F.col("x.r").alias("r")).alias("m"))


def scored(df: DataFrame, m: DataFrame, s: str = "s") -> DataFrame:
    """Adds score: the difference of the log-likelihoods a character; 0 for an empty string. Each distinct string is scored once, a row for
    each place, in functions that are compiled together, so that the model is read where it lies; a lambda over the places would
    have it copied into every row."""
    pad, at, near, counts, sum_ = (free_name(df, x) for x in ("_p", "_i", "_w", "_m", "_l"))
    texts = df.select(F.col(s)).where(F.length(s) > 0).distinct()
    places = texts.select(s, _padded(s).alias(pad), F.explode(_places(s)).alias(at))
    # a place's character and all that its contexts need
    windows = places.select(s, F.substring(F.col(pad), F.col(at), F.lit(ORDERS)).alias(near), m.scalar().alias(counts))
    slots = F.size(F.col(counts)["a"])
    p = {"a": F.lit(1 / SYMBOLS), "r": F.lit(1 / SYMBOLS)}
    for k in range(ORDERS):
        part = lambda n: F.substring(F.col(near), F.lit(ORDERS - k), F.lit(n)) if n else F.lit("")  # noqa: B023,E731
        gram, total = _slot(part(k + 1), slots), _slot(F.concat(part(k), F.lit("\n")), slots)
        p = {c: (F.get(F.col(counts)[c], gram.cast("int")) + STRENGTH * p[c]) / (F.get(F.col(counts)[c], total.cast("int")) + STRENGTH) for c in p}
    summed = windows.select(s, (F.log(p["a"]) - F.log(p["r"])).alias(sum_)).groupBy(s).agg(F.sum(sum_).alias(sum_))
    return df.join(summed, s, "left").withColumn("score", F.coalesce(F.col(sum_) / F.length(s), F.lit(0.0))).select(*df.columns, "score")


def threshold(held: DataFrame) -> DataFrame:
    """held: score, ok. One row: the lower edge of the score step with the best balanced accuracy, nearest to 0."""
    step = F.greatest(F.lit(-STEPS * EDGE), F.least(F.lit(STEPS * EDGE), F.floor(F.col("score") * STEPS)))
    counts = held.groupBy(step.alias("b")).agg(F.count_if("ok").alias("a"), F.count_if(~F.col("ok")).alias("r"))
    below, every = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.select("b", F.sum("a").over(every).alias("na"), F.sum("r").over(every).alias("nr"), F.coalesce(F.sum("a").over(below), F.lit(0)).alias("la"), F.coalesce(F.sum("r").over(below), F.lit(0)).alias("lr"))
    good = F.when((F.col("na") > 0) & (F.col("nr") > 0), (F.col("na") - F.col("la")) / F.col("na") + F.col("lr") / F.col("nr"))
    best = counts.select(good.alias("g"), "b").where("g IS NOT NULL").agg(F.max(F.struct("g", (-F.abs("b")).alias("z"), "b")).alias("x"))
    return best.select((F.col("x.b") / STEPS).alias("t"))


def judge(pages: DataFrame, url: str = "url", rules: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Adds host, path, rule, score and verdict."""
    rules = RULES if rules is None else rules
    pages = pages.drop("host", "path", "rule", "score", "verdict")
    own, text, limit_ = (free_name(pages, x) for x in ("_rule", "_s", "_t"))
    parts = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    parts = parts.withColumns({own: rule_of(F.col("host"), F.col("path"), rules), text: characters(F.col("host"), F.col("path"))})
    labelled = parts.where(F.col(own).isNotNull()).select(F.col(text).alias("s"), (F.col(own)["verdict"] == "allow").alias("ok"), (F.pmod(F.xxhash64(text), F.lit(FOLDS)) == 0).alias("held"))
    m = staged(model(labelled.where("NOT held")), "url-model")  # many expressions read it
    limit = threshold(scored(labelled.where("held"), m))
    out = scored(parts, m, text).withColumn(limit_, F.coalesce(limit.scalar(), F.lit(0.0)))
    verdict = F.coalesce(F.col(own)["verdict"], F.when(F.col("score") >= F.col(limit_), "allow").otherwise("block"))
    return out.withColumns({"rule": F.col(own)["rule"], "verdict": verdict}).drop(text, own, limit_)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")
