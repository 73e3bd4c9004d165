import heapq
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from allelespan.llm import token_counts as m

PATH = public_tokenizers.path(m.NAME)


@pytest.fixture(scope="module")
def merges():
    return m.Merges(PATH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def texts(n, seed):
    rng = random.Random(seed)
    wide = [*range(0, 0x250), *range(0x3040, 0x30A0), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F620), 0x85, 0xA0, 0x2028, 0x558, 0x10940, 0x323B0, 0x1E6C0, 0x3000, 0x200B, 0xFEFF]
    some = [" ", "  ", "\n", "the", "'s", "'ll", "<|endoftext|>", "<|endoftext", "1", "aaaa", "ing", "\r\n", "\t"]
    return ["".join(chr(rng.choice(wide)) if rng.random() < 0.5 else rng.choice(some) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_equals_the_library(merges, library):
    f = merges.counter()
    assert [f(t) for t in texts(2000, 1)] == [library(t) for t in texts(2000, 1)]


def test_later_letters_are_no_letters(merges, library):
    f = merges.counter()
    ends = [c for c in m.NEWER if c != "-"]
    for c in ends:
        t = f"ab{c}cd 1{c}2 {c}{c} x"
        assert f(t) == library(t), ascii(c)


def test_long_pieces(merges, library, monkeypatch):
    """Parts, arrays and reading piece by piece, on runs without a space."""
    rng = random.Random(2)
    long = ["a" * 5000, "ab" * 3000, "日本語テキスト" * 2000, "".join(rng.choice("etaoins") for _ in range(20000)), " " * 3000 + "x", "é" * 4000, "word " * 5000]
    f = merges.counter()
    want = [library(t) for t in long]
    assert [f(t) for t in long] == want
    monkeypatch.setattr(m, "LARGE", 0)
    monkeypatch.setattr(m, "LONG", 2)
    assert [f(t) for t in long] == want


def test_counts_do_not_depend_on_what_is_kept(merges, monkeypatch):
    want = [merges.counter()(t) for t in texts(300, 3)]
    monkeypatch.setattr(m, "KEPT", 3)
    f = merges.counter()
    assert [f(t) for t in texts(300, 3)] == want


def test_heap_order_against_plain_search(merges):
    """Always the lowest rank, the leftmost of equals, by looking at all pairs each time."""
    rng = random.Random(4)
    for _ in range(300):
        part = bytes(rng.choice(b"thein g") for _ in range(rng.randrange(1, 40)))
        s = [merges.first[b] for b in part]
        while True:
            ranked = [(r, i) for i in range(len(s) - 1) if (r := merges.rank.get(s[i] << 20 | s[i + 1])) is not None]
            if not ranked:
                break
            r, i = heapq.nsmallest(1, ranked)[0]
            s[i : i + 2] = [merges.made[r]]
        assert merges.count(part) == len(s)


def test_rows(spark, tmp_path, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello <|endoftext|> world", "x"), (3, "hello <|endoftext|> world", "x"), (None, "a b " * 1000, None), (4, "ümläut 日本", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = m.op12_heap_bpe(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, len((t or "").encode()), library(t or ""), library(t or "") > 512)) for i, t, _ in rows)
    kept = m.counted(df, "text", m.Merges(PATH), df.columns)
    assert kept.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"] and kept.count() == len(rows)
    assert m.counted(df.limit(0), "text", m.Merges(PATH), ["doc_id"]).count() == 0


def test_whole_table(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = m.op12_heap_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs) and all(r.n_tokens == library(docs[r.doc_id] or "") for r in got)
