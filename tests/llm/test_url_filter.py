import math

import xxhash

from allelespan.llm import url_filter as u


def slot(s):
    h = xxhash.xxh64_intdigest(s.encode(), 42)
    return (h - (1 << 64) if h >> 63 else h) % u.SLOTS


def grams(s):
    p = "^" * (u.ORDERS - 1) + s
    for i in range(u.ORDERS - 1, len(p)):
        yield [(slot(p[i - k : i + 1]), slot(p[i - k : i] + "\n")) for k in range(u.ORDERS)]


def brute(rows):
    """page_id: verdict, score of (page_id, url)."""
    def parts(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        path = rest[cut:]
        end = min((path.index(c) for c in "?#" if c in path), default=len(path))
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]

    def rule(h, p):
        fits = [(len(a + b), a + b, v) for a, b, v in u.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        return max(fits)[1:] if fits else (None, None)

    info = {i: (*parts(x), *rule(*parts(x))) for i, x in rows}
    held = lambda s: (lambda h: (h - (1 << 64) if h >> 63 else h) % u.FOLDS == 0)(xxhash.xxh64_intdigest(s.encode(), 42))
    count = {True: {}, False: {}}
    for h, p, r, v in info.values():
        s = (h + p).lower()
        if r and not held(s):
            for levels in grams(s):
                for pair in levels:
                    for x in pair:
                        count[v == "allow"][x] = count[v == "allow"].get(x, 0) + 1

    def score(s):
        total = 0.0
        for levels in grams(s):
            q = {True: 1 / u.SYMBOLS, False: 1 / u.SYMBOLS}
            for g, c in levels:
                q = {k: (count[k].get(g, 0) + u.STRENGTH * q[k]) / (count[k].get(c, 0) + u.STRENGTH) for k in q}
            total += math.log(q[True]) - math.log(q[False])
        return total / len(s) if s else 0.0

    scores = {i: score((h + p).lower()) for i, (h, p, _, _) in info.items()}
    marks = [(max(-u.STEPS * u.EDGE, min(u.STEPS * u.EDGE, math.floor(scores[i] * u.STEPS))), v == "allow") for i, (h, p, r, v) in info.items() if r and held((h + p).lower())]
    na, nr = sum(ok for _, ok in marks), sum(not ok for _, ok in marks)
    limit = 0.0
    if na and nr:
        limit = max(((sum(ok and b >= t for b, ok in marks)) / na + sum(not ok and b < t for b, ok in marks) / nr, -abs(t), t) for t in {b for b, _ in marks})[2] / u.STEPS
    return {i: (h, p, r, v or ("allow" if scores[i] >= limit else "block"), scores[i]) for i, (h, p, r, v) in info.items()}


def test_against_brute_force(spark):
    rows = [(r.page_id, r.url) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()]
    want = brute(rows)
    got = u.op3_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    for r in got:
        h, p, rule, v, s = want[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (h, p, rule, v) and abs(r.score - s) < 1e-9


def test_plan_is_native(spark, sf_dir):
    plan = u.op3_url_filter(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_slots_follow_the_grams(spark):
    urls = [f"{xxhash.xxh64_hexdigest(str(i))}{xxhash.xxh64_hexdigest('x' + str(i))}" for i in range(2000)]
    distinct = len({("^" * (u.ORDERS - 1) + s)[i - k : i] + c for s in urls for i in range(u.ORDERS - 1, u.ORDERS - 1 + len(s)) for k in range(u.ORDERS) for c in (("^" * (u.ORDERS - 1) + s)[i], "\n")})
    m = u.model(spark.createDataFrame([(s, True) for s in urls], "s string, ok boolean")).first().m
    assert len(m.a) == len(m.r) >= 8 * distinct > u.SLOTS and sum(m.a) == 2000 * 32 * u.ORDERS * 2 and sum(m.r) == 0


def test_edges(spark):
    urls = [None, "", "abc", "://", "x://A.COM", "http://a.com/en/1?x", "http://b.example.com/en/7#y", "http://xcom/en/", "http://é.net/de/ü", "http://a.com/" + "z" * 20_000, "http://a.com/en/1?x"]
    df = spark.createDataFrame([(i, x, "old", 1) for i, x in enumerate(urls)], "page_id int, url string, verdict string, score int")
    got = {r.page_id: r for r in u.judge(df).collect()}
    assert len(got) == len(urls) and (got[0].host, got[0].path, got[0].rule, got[0].score) == ("", "", None, 0.0)
    assert got[4].host == "a.com" and got[5].rule == "com/en/" and got[6].rule == "example.com/en/7" and got[6].verdict == "allow"
    assert got[7].rule is None and got[8].rule == "net/de/" and got[5].verdict == got[10].verdict == "block"
    assert u.judge(df.limit(0)).count() == 0


def test_clashing_columns_stay(spark):
    rows = [(i, f"http://{h}/{p}/{i}", 1, 2, 3, 4, 5) for i, (h, p) in enumerate([("example.com", "en"), ("a.net", "de"), ("b.org", "fr")] * 5)]
    df = spark.createDataFrame(rows, "page_id int, url string, _s int, _rule int, _p int, _m int, _T int")
    got = u.judge(df)
    assert sorted(got.columns) == sorted([*df.columns, "host", "path", "score", "rule", "verdict"])
    assert all((r._s, r._rule, r._p, r._m, r._T) == (1, 2, 3, 4, 5) for r in got.collect())


def test_model_is_not_copied_into_rows(spark):
    m = u.model(spark.createDataFrame([("a.com/x", True), ("b.com/y", False)], "s string, ok boolean"))
    got = u.scored(spark.createDataFrame([("a.com/x", 1), ("a.com/x", 2), ("", 3)], "s string, n int"), m)
    # a lambda is not compiled with the plan around it, so all columns of its row are copied before it
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    rows = {r.n: r.score for r in got.collect()}
    assert len(rows) == 3 and rows[1] == rows[2] > 0 and rows[3] == 0
