import corpus_pipeline as c
from allelespan.llm import langid, pii, pieces
from allelespan.sources.staging import staged
from tests.llm.test_simhash import kept as kept_rows


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    model = langid.trained(docs)
    kept = {r.doc_id: r.text for r in docs.collect()}
    _, _, rejected = model.predict(list(kept.values()))
    kept = {d: t for (d, t), x in zip(kept.items(), rejected) if not x}
    docs = staged(c.STAGES[0][1](spark, docs, sf_dir), "t")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == kept

    kept = {d: kept[d] for d in kept_rows([(d, t, d) for d, t in kept.items()])}
    docs = staged(c.STAGES[1][1](spark, docs, sf_dir), "t")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == kept

    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}
    kept = {d: t for d, t in kept.items() if not any(tuple(w[i : i + n]) in windows for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))}
    docs = staged(c.STAGES[2][1](spark, docs, sf_dir), "t")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == kept

    kept = {d: pii.rewrite(t, {}, pii.PUBLIC_KEY)[0] for d, t in kept.items()}
    docs = staged(c.STAGES[3][1](spark, docs, sf_dir), "t")
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == kept
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    vocab = pieces.Pieces()
    got = c.STAGES[4][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: pieces.decode(vocab, r.ids) for r in got} == kept and all(r.lossless for r in got)
    assert sorted(r.doc_id for r in c.run(spark, sf_dir).collect()) == sorted(kept)


def words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({i: i + 32 for i in range(65, 91)}))


def test_empty_documents(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "t")
    assert docs.count() == 0
