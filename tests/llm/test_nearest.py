import numpy as np

from allelespan.llm import nearest as n


def test_chi_square():
    assert abs(n.chi_square_inverse(0.95, 8) - 15.507) < 1e-3 and abs(n.chi_square_inverse(0.5, 2) - 1.3863) < 1e-3


def recall(spark, x, ids, **kw):
    df = spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "vec_id long, embedding array<float>")
    got = n.nearest(df, df.where("vec_id % 20 = 0"), 20, **kw).collect()
    e = x.astype(np.float32).astype(float)
    hit = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    for q, rows in by.items():
        at = int(np.flatnonzero(ids == q)[0])
        score = np.einsum("ij,ij->i", e, np.broadcast_to(e[at], e.shape))
        keep = ids != q
        order = np.lexsort((ids[keep], -score[keep]))[:20]
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, min(20, len(x) - 1) + 1))
        value = dict(zip(ids.tolist(), score))
        assert all(r.score == value[r.vec_id] for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hit += len({r.vec_id for r in rows} & set(ids[keep][order].tolist()))
        total += len(order)
    return hit / total


def test_recall_on_spread_and_clustered_vectors(spark):
    rng = np.random.default_rng(1)
    spread = rng.standard_normal((3000, 32)) * rng.uniform(0.5, 2, (3000, 1))
    assert recall(spark, spread, np.arange(3000), block=1000) >= 0.9
    clustered = rng.standard_normal((30, 32))[rng.integers(0, 30, 3000)] + 0.05 * rng.standard_normal((3000, 32))
    assert recall(spark, clustered, np.arange(3000), block=1000) >= 0.9


def test_equal_vectors_go_by_id(spark):
    x = np.ones((200, 4))
    assert recall(spark, x, np.arange(200), block=70) == 1


def test_cells_and_hot_groups(spark):
    """Several cells and parts; a third of the rows are one vector. Far clusters are not sent to each other."""
    rng = np.random.default_rng(2)
    x = 3 * rng.standard_normal((12, 16))[rng.integers(0, 12, 2400)] + 0.02 * rng.standard_normal((2400, 16))
    x[:800] = x[0]
    assert recall(spark, x, rng.permutation(2400), block=150, fit_rows=1000) >= 0.9
    low = n.projected(x, float((x * x).sum(axis=1).max()))
    cells = n.Cells(low[::3], 4)
    own = cells.of(low)
    assert own.min() >= 0 and own.max() < 16 and len(set(own[:800])) == 1 and len(set(own)) > 4
    boxes = [(low[own == c].min(axis=0)[None], low[own == c].max(axis=0)[None]) for c in sorted(set(own))]
    inside = np.array([n._gaps(low, a, b)[:, 0] for a, b in boxes])
    assert (inside.min(axis=0) == 0).all()


def test_pairs_grow_less_than_quadratically(spark):
    """Four times the rows and queries meet in clearly fewer than sixteen times the pairs, and stay as good."""
    rng = np.random.default_rng(5)
    centres, met = 2 * rng.standard_normal((64, 16)), []
    for rows in (1500, 6000):
        x = centres[rng.integers(0, 64, rows)] + 0.1 * rng.standard_normal((rows, 16))
        x /= np.linalg.norm(x, axis=1)[:, None]
        rounds = []
        assert recall(spark, x, np.arange(rows), block=50, fit_rows=4000, rounds=rounds) >= 0.9
        assert [q for q, _ in rounds] == sorted((q for q, _ in rounds), reverse=True)
        met.append(sum(pairs for _, pairs in rounds))
    assert met[0] < 75 * 1500 * 0.4 and met[1] < 6 * met[0]


def test_registered_query(spark, sf_dir):
    """The query itself, row by row, against all pairs."""
    tb = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    e, ids = np.stack(tb.embedding).astype(float), tb.vec_id.to_numpy()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in n.op8_stable_projections(spark, sf_dir).collect()}
    want = {}
    for at in np.flatnonzero(ids % 20 == 0):
        score, keep = np.einsum("ij,ij->i", e, np.broadcast_to(e[at], e.shape)), ids != ids[at]
        for rank, i in enumerate(np.lexsort((ids[keep], -score[keep]))[:20], 1):
            want[int(ids[at]), rank] = (int(ids[keep][i]), float(score[keep][i]))
    assert set(got) == set(want) and sum(got[k] == want[k] for k in want) / len(want) >= 0.9


def test_documents_table(spark, sf_dir):
    tb = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    assert recall(spark, np.stack(tb.embedding), tb.vec_id.to_numpy()) >= 0.9


def test_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (None, [9.0, 9.0]), (20, None), (1, [2.0, 0.0]), (40, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = n.nearest(df, df.where("vec_id % 20 = 0"), 20).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == [(0, 1, 1, 2.0), (0, 2, 1, 2.0), (0, 3, 40, 0.5), (40, 1, 1, 1.0), (40, 2, 1, 1.0), (40, 3, 0, 0.5)]
    assert n.nearest(df.limit(0), df.limit(0), 20).collect() == []
