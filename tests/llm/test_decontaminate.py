import random
import re

import duckdb
from pyspark.sql import functions as F

from allelespan.llm import decontaminate as d

DOCS = [(1, "foo bar"), (2, "a b c d e f g h i j k"), (3, None), (4, ""), (5, "A! b, c-d e f g h i j; x"), (5, "solo"), (None, "x y z solo"), (6, "é ß " * 3000 + "a b c d e f g h i j " * 3), (7, "a b c d e x f g h i j")]
ITEMS = [(1, "bar"), (2, "a b c d e f g h i j k"), (3, None), (4, "..."), (5, "solo"), (6, "y z"), (7, "y z")]


def tables(spark, path, docs=DOCS, items=ITEMS):
    x = spark.createDataFrame([(*r, 1, "w") for r in docs], "doc_id long, text string, row int, window string")
    y = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, row int")
    x.write.parquet(f"{path}/documents.parquet")
    y.write.parquet(f"{path}/benchmark.parquet")


def test_edges_equal_sql(spark, tmp_path):
    tables(spark, tmp_path)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = sorted(map(repr, con.execute(d.OP5_SQL).fetchall()))
    assert sorted(repr(tuple(r)) for r in d.op5_decontaminate(spark, str(tmp_path)).collect()) == want


def test_shuffled_search_is_the_same(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    want = sorted(map(repr, d.op5_decontaminate(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(d, "BOUND", 0)
    assert sorted(map(repr, d.op5_decontaminate(spark, str(tmp_path)).collect())) == want


def test_empty_tables(spark, tmp_path):
    tables(spark, tmp_path / "a", items=[])
    assert d.op5_decontaminate(spark, str(tmp_path / "a")).where("contaminated").count() == 0
    tables(spark, tmp_path / "b", docs=[])
    assert d.op5_decontaminate(spark, str(tmp_path / "b")).count() == 0


def test_proximity_finds_what_a_word_split(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame([ITEMS[1]], "item_id long, text string")
    w = d.Windows(items, "item_id", "text")
    postings, texts = d.index(docs, "doc_id", "text", w)
    near = d.proximity(postings, w, 1).join(texts, "row").select("doc_id").distinct()
    assert {2, 5, 6, 7} == {r.doc_id for r in near.collect()}
    assert 7 not in {r.doc_id for r in d.matches(postings, w).join(texts, "row").collect()}


def test_proximity_against_brute_force(spark):
    """All windows, all places of their rarest terms, all starts."""
    rng = random.Random(3)
    docs = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(25)]
    items = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9))) for _ in range(12)]
    w = d.Windows(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), "item_id", "text")
    postings, texts = d.index(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), "doc_id", "text", w)
    got = {(r.doc_id, r.window, r.start) for r in d.proximity(postings, w, 2).join(texts, "row").select("doc_id", "window", "start").collect()}
    want = set()
    split = [x.split() for x in docs]
    terms_at = lambda x, single: [(i, t) for i, t in enumerate(x if single else zip(x, x[1:]))]
    for item in {i for i in items if i}:
        words = item.split()
        terms = terms_at(words, len(words) == 1)
        n = [sum(t == u for x in split for _, u in terms_at(x, len(words) == 1)) for _, t in terms]
        if min(n) == 0:
            continue
        asked = [terms[k] for k in sorted(range(len(terms)), key=lambda k: (n[k], k))[: min(3, len(terms))]]
        for doc, x in enumerate(split):
            starts = [(i - o, k) for k, (o, t) in enumerate(asked) for i, u in terms_at(x, len(words) == 1) if u == t]
            for s, _ in starts:
                if len({k for z, k in starts if s <= z <= s + 4}) >= max(1, len(asked) - 1):
                    want.add((doc, item, s))
    assert got == want and len(want) > 20


def test_words_are_those_of_the_contract(spark):
    rng = random.Random(1)
    texts = ["".join(chr(rng.choice([*range(0, 128), 0xE9, 0x3042, 0x1F600, 0x130])) for _ in range(200)) for _ in range(50)] + [None, "", " ", "a", ".a."]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", d.words_of(F.col("t")).alias("w")).collect()
    for r in rows:
        assert r.w == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.t or "").translate({i: i + 32 for i in range(65, 91)}))


def test_stage_and_plan(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = d.stage_decontaminate(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == [3, 4, 7]
    plan = d.op5_decontaminate(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
