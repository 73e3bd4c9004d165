import re
from collections import Counter

import numpy as np

from allelespan.llm import langid


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.op9_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert sum(r.rejected for r in got) / len(got) < 0.01


def test_edges(spark):
    rows = [(1, "the thing and the other", "en"), (2, "der die das und nicht", "de"), (3, None, "en"), (4, "", "de"), (5, "123 !?", "en"), (6, "the thing and the other", None), (7, "und nicht " * 200_000, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit(df)
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert [got[i].lang_pred for i in range(1, 8)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert all(got[i].lang_score == 0 and got[i].lang_rejected for i in (3, 4, 5)) and all(0 <= r.lang_score <= 1 for r in got.values())
    none = langid.fit(df.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predict(df, none).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0


TEXTS = ["Étion dans ça, the thing\nund nicht " * 50, "a", "ab", " , 12 a ,, b ..", "x" * 500, "... " * 200, "", None, "ß İ 日本 語", "end of it..."]


def test_blocks_do_not_matter(monkeypatch):
    whole, has = langid._counts(TEXTS)
    for block in (1, 2, 3, 7, 97):
        monkeypatch.setattr(langid, "BLOCK", block)
        parts, same = langid._counts(TEXTS)
        assert (whole == parts).all() and (has == same).all()


def grams(text):
    """Bigrams and trigrams of the lower-case letters, runs of all else being one mark, as there are at both ends."""
    s = re.sub("\0+", "\0", "\0" + "".join(c.lower()[0] if c.isalpha() else "\0" for c in text) + "\0")
    return Counter(s[i : i + n] for n in (2, 3) for i in range(len(s) - n + 1))


def test_against_brute_force(spark):
    """Predictions are those of exact n-gram vectors, centroid by centroid, where no two n-grams share a feature that matters."""
    for t in TEXTS:
        counts, has = langid._counts([t])
        want = grams(t or "") if any(c.isalpha() for c in t or "") else Counter()
        got = Counter()
        for g, n in want.items():
            code = np.array([ord(c) for c in g], dtype=np.uint32)
            got[int(langid._hashed(code)[-1])] += n  # the n-gram itself is hashed last
        assert has[0] == bool(want) and {i: int(counts[0, i]) for i in np.flatnonzero(counts[0])} == dict(got)
    rows = [("the thing and the other one", "en"), ("it is here and there", "en"), ("der hund und die katze", "de"), ("das ist nicht so", "de")]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), centroids=2)
    vectors = [langid._counts([t])[0][0] for t, _ in rows]
    n = sum(v > 0 for v in vectors)
    idf = np.log(5 / (1 + n)) + 1
    unit = lambda v: v / np.linalg.norm(v)
    tfidf = lambda v: unit(np.where(v > 0, 1 + np.log(np.maximum(v, 1)), 0) * idf)
    for text in ("and the cat is here", "und der ist nicht hier", "other", "katze"):
        x = tfidf(langid._counts([text])[0][0])
        # as many centroids as texts: each text is its own centroid
        cos = [(float(x @ tfidf(v)), lang) for v, (_, lang) in zip(vectors, rows)]
        got, score, _ = model.predict([text])
        assert got[0] == max(cos)[1] and abs(score[0] - max(cos)[0]) < 1e-4


def test_strange_text_is_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.trained(docs)
    _, _, rejected = model.predict(["зжщ юяэ ъыь ёйц " * 20, "qxzj kvwq xqzv " * 20])
    assert rejected.all()


def test_copies_and_rare_languages_in_the_fit(spark):
    """A third of all rows are one text, and one language has three rows: the fit holds each distinct text once."""
    rows = [("copied words here", "en")] * 300 + [(f"the thing number {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(500)] + [(t, "de") for t in ("und nicht", "der hund", "die katze")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(7)
    model = langid.fit(df, fit_rows=20, centroids=2)
    assert set(model.langs) == {"de", "en"}
    assert model.predict(["die katze und der hund"])[0] == ["de"]
    again = langid.fit(df.repartition(3), fit_rows=20, centroids=2)
    assert (again.centroids == model.centroids).all() and (again.idf == model.idf).all()
