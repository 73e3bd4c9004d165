import numpy as np
import pytest

from allelespan.llm import pieces as P

TEXTS = ["", " ", "Hello  world\n x", "a▁b", "日本語 テキスト 𝔘𝔫𝔦 \n\n\t x", "é" * 10, "word" * 200, "日本語" * 300, "the thing and nothing " * 50, "\x00 \ufffd"]


@pytest.fixture(scope="module")
def vocab():
    return P.Pieces()


def test_without_dropout_it_is_the_library(vocab):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    off, ids = P.encode(vocab, TEXTS, np.arange(len(TEXTS)), dropout=0)
    for i, t in enumerate(TEXTS):
        if "▁" not in t and "\x00" not in t and "\ufffd" not in t:
            assert ids[off[i] : off[i + 1]].tolist() == sp.encode(t)


@pytest.mark.parametrize("dropout", [0, 0.1, 0.5, 1])
def test_lossless_and_repeatable(vocab, dropout):
    off, ids = P.encode(vocab, TEXTS, np.arange(len(TEXTS)), seed=3, dropout=dropout)
    assert [P.decode(vocab, ids[a:b].tolist()) for a, b in zip(off, off[1:])] == TEXTS
    again = P.encode(vocab, TEXTS[::-1], np.arange(len(TEXTS))[::-1].copy(), seed=3, dropout=dropout)
    assert again[1][again[0][0] : again[0][1]].tolist() == ids[off[-2] : off[-1]].tolist()
    if dropout == 1:
        assert len(ids) >= sum(len(t) for t in TEXTS)


def test_words_vary_from_place_to_place(vocab):
    """Each place draws for itself: far more cuts than a fixed number of variants, at the rate that is asked for."""
    n, word = 4000, " nothingness"
    salt = P.salts(np.array([5]), np.zeros(n, int), np.arange(n), 0)
    count, ids = P.segment(vocab, [word] * n, salt, 0.1)
    at = np.concatenate(([0], np.cumsum(count)))
    assert len({tuple(ids[a:b].tolist()) for a, b in zip(at, at[1:])}) > 12
    assert P.decode(vocab, P.encode(vocab, [word[1:] * 9], np.array([5]))[1].tolist()) == word[1:] * 9
    spans = [P._span(np.array([i]), np.array([j])) for i in range(12) for j in range(i + 2, 13)]
    skipped = np.array([P._skipped(salt, x, 0.1) for x in spans])
    assert 0.095 < skipped.mean() < 0.105 and 0.08 < skipped.mean(axis=1).min() and skipped.mean(axis=1).max() < 0.12
    both = skipped[:, None] & skipped[None]  # spans draw apart from one another
    assert abs(both.mean() - (0.01 * (len(spans) - 1) + 0.1) / len(spans)) < 0.001
    plain = P.segment(vocab, [word] * n, salt, 0)[1]
    assert len(ids) > len(plain)


WORDS = (" " + "word" * 20 + "ing", " hello", "   x", " straße", " " + "a" * 60, " nothing", " 日本語テキスト", " x", " internationalisation", " ")


def test_heap_and_matrix_agree(vocab):
    salt = P._mix(np.arange(40, dtype=np.uint64) + np.uint64(7))
    for d in (0, 0.1, 0.3, 0.9, 1):
        chunks = [s for s in WORDS for _ in salt]
        count, ids = P.segment(vocab, chunks, np.tile(salt, len(WORDS)), d)
        want = [P._expanded(vocab, P._one(vocab, s, x, d), s) for s in WORDS for x in salt]
        assert ids.tolist() == [x for w in want for x in w] and count.tolist() == [len(w) for w in want]


def test_blocks_do_not_matter(vocab, monkeypatch):
    texts = [*TEXTS, "a longer text of many words " * 40, "   " * 50, "x" * 300 + " y" * 300]
    keys = np.arange(len(texts)) * 7 - 3
    off, ids = P.encode(vocab, texts, keys, seed=9, dropout=0.2)
    for block, part in ((50, 16), (7, 3000), (400, 1)):
        monkeypatch.setattr(P, "BLOCK", block)
        monkeypatch.setattr(P, "TOGETHER", part)
        again = P.encode(vocab, texts, keys, seed=9, dropout=0.2)
        assert (again[0] == off).all() and (again[1] == ids).all()
        assert P.lossless(vocab, [*texts, None], np.append(off, off[-1]), ids) == [True] * len(texts) + [None]
    wrong = ids.copy()
    wrong[off[3]] += 1
    assert P.lossless(vocab, texts, off, wrong) == [i != 3 for i in range(len(texts))]


def test_query_over_long_and_short_texts(spark, sf_dir, vocab):
    """The registered query's rows are those of the heap, place by place; its parts of the table do not matter."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in P.op7_merge_dropout(spark, sf_dir).collect()}
    assert set(got) == set(docs) and all(r.lossless and r.n_tokens == len(r.ids) for r in got.values())
    key = {r.doc_id: r.k for r in spark.createDataFrame([(d,) for d in docs], "doc_id long").selectExpr("doc_id", "xxhash64(doc_id) AS k").collect()}
    for d in sorted(docs, key=lambda d: len(docs[d]))[::20]:
        chunks = P.CHUNK.findall(" " + docs[d])
        salt = P.salts(np.array([key[d]]), np.zeros(len(chunks), int), np.arange(len(chunks)), 0)
        assert got[d].ids == [x for c, z in zip(chunks, salt) for x in P._expanded(vocab, P._one(vocab, c, z, 0.1), c)]


def test_table(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "So it is", "c"), (3, "So it is", "c"), (None, "x▁y", "d")], "doc_id long, text string, ids string")
    got = P.encoded(df, "doc_id", "text", ["doc_id", "text", "ids"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 5 and by[1].ids is None and by[1].lossless is None and by[2].ids == [] and by[2].n_tokens == 0
    assert all(r.lossless for r in got if r.text is not None) and len({tuple(r.ids) for r in got if r.doc_id == 3}) == 1
    assert P.encoded(df.limit(0), "doc_id", "text", ["doc_id"]).count() == 0
