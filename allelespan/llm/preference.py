"""Preference formatting: chosen and rejected conversations become one prompt and two masked completions.

The longest common prefix of turns (equal role and text) is rendered once as the prompt; what follows it in each
conversation is its completion. In a completion only assistant turns are to be learned: `spans` lists them as
start-end character places (end exclusive), the closing mark included; all else is masked.

The query takes conversation 2p as chosen and 2p + 1 as rejected; a conversation without its partner has a null partner
and all its turns in its completion. A conversation becomes one row, so it must fit in a task.

Edge cases: turns are ordered by turn, role and text, nulls first; repeated turns stay. A null role or text is empty. Marks
inside a text or role are broken up by a space, and line ends in a role become spaces, so that neither can open a turn. Equal conversations have empty completions;
`usable` is true where both completions have something to learn. A null conversation id is no conversation. Empty tables
give no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelespan.llm._common import table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNED = "assistant"


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns: array of (role, text) in order."""
    safe = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|im_"), F.lit("< |im_"))
    name = F.regexp_replace(safe(role), r"[\r\n]", " ")
    rows = turns.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).alias("conv_id"), F.struct(F.col(turn).alias("turn"), name.alias("role"), safe(text).alias("text")).alias("t"))
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return got.select("conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit(OPEN), x["role"], F.lit("\n"), x["text"], F.lit(CLOSE + "\n"))), "")


def _spans(turns: Column) -> Column:
    """start-end of what is learned, comma-joined."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + len(OPEN) + 1 + F.length(x["role"])
        end = start + F.length(x["text"]) + len(CLOSE)
        span = F.concat(start.cast("string"), F.lit("-"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(x["role"] == LEARNED, F.concat(acc["s"], F.array(span))).otherwise(acc["s"]).alias("s"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("s"))
    return F.array_join(F.aggregate(turns, zero, step)["s"], ",")


def preferences(pairs: DataFrame) -> DataFrame:
    """pairs: pair_id, chosen_id, rejected_id and chosen and rejected as arrays of (role, text), null for none."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    df = pairs.withColumns({"c": F.coalesce("chosen", none), "r": F.coalesce("rejected", none)})
    shorter = F.least(F.size("c"), F.size("r"))
    places = F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>"))
    unequal = F.filter(places, lambda i: F.get(F.col("c"), i) != F.get(F.col("r"), i))
    df = df.withColumn("n_prefix", F.coalesce(F.get(unequal, F.lit(0)), shorter).cast("long"))
    rest = lambda c: F.slice(c, F.col("n_prefix").cast("int") + 1, F.greatest(F.lit(1), F.size(c)))
    df = df.withColumns({"prompt": _rendered(F.slice("c", F.lit(1), F.col("n_prefix").cast("int"))), "c": rest("c"), "r": rest("r")})
    df = df.withColumns({"chosen_completion": _rendered(F.col("c")), "rejected_completion": _rendered(F.col("r")), "chosen_spans": _spans(F.col("c")), "rejected_spans": _spans(F.col("r"))})
    usable = (F.col("chosen_spans") != "") & (F.col("rejected_spans") != "")
    return df.select("pair_id", "chosen_id", "rejected_id", "n_prefix", "prompt", "chosen_completion", "chosen_spans", "rejected_completion", "rejected_spans", usable.alias("usable"))


def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = conversations(table(spark, sf_dir, "conversations"))
    pair = F.floor(F.col("conv_id") / 2).alias("pair_id")
    side = lambda n, name: F.max(F.when(F.pmod("conv_id", F.lit(2)) == n, F.col(name)))
    pairs = got.groupBy(pair).agg(side(0, "conv_id").alias("chosen_id"), side(1, "conv_id").alias("rejected_id"), side(0, "turns").alias("chosen"), side(1, "turns").alias("rejected"))
    return preferences(pairs)


OP2_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, replace(replace(replace(coalesce(role, ''), '<|im_', '< |im_'), chr(10), ' '), chr(13), ' '), replace(coalesce(text, ''), '<|im_', '< |im_')) AS i,
    replace(replace(replace(coalesce(role, ''), '<|im_', '< |im_'), chr(10), ' '), chr(13), ' ') AS role, replace(coalesce(text, ''), '<|im_', '< |im_') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT *, CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 AS side FROM t),
ids AS (SELECT pair_id, max(CASE WHEN side = 0 THEN conv_id END) AS chosen_id, max(CASE WHEN side = 1 THEN conv_id END) AS rejected_id, max(CASE WHEN side = 0 THEN i END) AS nc, max(CASE WHEN side = 1 THEN i END) AS nr FROM p GROUP BY pair_id),
diff AS (SELECT c.pair_id, min(c.i) AS first FROM p c JOIN p r ON c.pair_id = r.pair_id AND c.i = r.i AND c.side = 0 AND r.side = 1 WHERE c.role <> r.role OR c.text <> r.text GROUP BY c.pair_id),
n AS (SELECT ids.*, coalesce(first - 1, least(coalesce(nc, 0), coalesce(nr, 0))) AS n_prefix FROM ids LEFT JOIN diff USING (pair_id)),
seg AS (
  SELECT p.pair_id, side, i, role, n_prefix, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS s,
    coalesce(sum(CASE WHEN i > n_prefix THEN 24 + length(role) + length(text) END) OVER (PARTITION BY p.pair_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off,
    length(role) AS lr, length(text) AS lt
  FROM p JOIN n ON p.pair_id = n.pair_id),
txt AS (
  SELECT pair_id,
    string_agg(s, '' ORDER BY i) FILTER (WHERE i <= n_prefix AND side = 0) AS prompt,
    string_agg(s, '' ORDER BY i) FILTER (WHERE i > n_prefix AND side = 0) AS chosen_completion,
    string_agg(s, '' ORDER BY i) FILTER (WHERE i > n_prefix AND side = 1) AS rejected_completion,
    string_agg(CAST(off + 13 + lr AS BIGINT) || '-' || CAST(off + 23 + lr + lt AS BIGINT), ',' ORDER BY i) FILTER (WHERE i > n_prefix AND side = 0 AND role = 'assistant') AS chosen_spans,
    string_agg(CAST(off + 13 + lr AS BIGINT) || '-' || CAST(off + 23 + lr + lt AS BIGINT), ',' ORDER BY i) FILTER (WHERE i > n_prefix AND side = 1 AND role = 'assistant') AS rejected_spans
  FROM seg GROUP BY pair_id)
SELECT n.pair_id, n.chosen_id, n.rejected_id, CAST(n.n_prefix AS BIGINT) AS n_prefix, coalesce(prompt, '') AS prompt, coalesce(chosen_completion, '') AS chosen_completion, coalesce(chosen_spans, '') AS chosen_spans,
  coalesce(rejected_completion, '') AS rejected_completion, coalesce(rejected_spans, '') AS rejected_spans, chosen_spans IS NOT NULL AND rejected_spans IS NOT NULL AS usable
FROM n LEFT JOIN txt USING (pair_id)
"""
