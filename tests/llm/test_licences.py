import random
from itertools import groupby

from allelespan.llm import licences as m


def maximal(templates, text):
    """(template, text place after, template place after, length) of every match that neither side can extend, by comparing all places."""
    out = set()
    for t, words in enumerate(templates):
        for i in range(len(text)):
            for j in range(len(words)):
                n = 0
                while i + n < len(text) and j + n < len(words) and text[i + n] == words[j + n]:
                    n += 1
                if n >= m.MIN_MATCH and (i == 0 or j == 0 or text[i - 1] != words[j - 1]):
                    out.add((t, i + n, j + n, n))
    return out


def spans_of(templates, text):
    """(template, first, stop, covered) of the spans and the largest share, over all pairs of matches and of spans."""
    found = sorted(maximal(templates, text), key=lambda x: (x[1], x[2]))
    best = []
    for t, at, end, n in found:
        own = (n, at - n)
        for (t2, x, y, _), (held, head) in zip(found, best):
            over = max(0, x - (at - n), y - (end - n))
            if t2 == t and x < at and y < end and over < n and at - n + over - x <= m.MAX_GAP and end - n + over - y <= m.MAX_GAP:
                own = max(own, (held + n - over, head))
        best.append(own)
    chains = sorted({(-c, len(templates[t]), head, at, t) for (t, at, _, _), (c, head) in zip(found, best)})
    kept = []
    for c, size, first, stop, t in chains:
        if -c / size >= m.COVER and not any(first < y and x < stop and ((-d, len(templates[u])) < (c, size) or t == u) for u, x, y, d in kept):
            kept.append((t, first, stop, -c))
    return kept, max([-c / size for c, size, *_ in chains], default=0)


def scanned(auto, text):
    spans, score = auto.spans(auto.coded(text.encode()))
    return {x[0] for x in spans}, score


def test_matches_and_chains_against_brute_force():
    rng = random.Random(2)
    for turn in range(150):
        letters = "abcd" if turn % 2 else "abcdefghij"
        templates = [[rng.choice(letters) for _ in range(rng.randrange(3, 25))] for _ in range(3)]
        text = []
        while len(text) < 60:  # parts of templates and noise
            t = rng.choice(templates)
            i = rng.randrange(len(t))
            text += t[i : i + rng.randrange(2, 15)] + [rng.choice(letters + "z") for _ in range(rng.randrange(3))]
        auto = m.Automaton([(str(i), " ".join(t)) for i, t in enumerate(templates)], [])
        runs, at = [], 0
        for known, part in groupby(text, lambda w: any(w in t for t in templates)):
            part = list(part)
            runs += list(auto.matches([auto.ids[w.encode()] for w in part], at)) if known else []
            at += len(part)
        assert len(set(runs)) == len(runs) and set(runs) == maximal(templates, text)
        want, share = spans_of(templates, text)
        got, score = auto.spans(auto.coded(" ".join(text).encode()))
        assert sorted(got) == sorted((str(t), first, stop - 1, c) for t, first, stop, c in want)
        assert score == min(1.0, share)


def test_base_phrases_and_counts(spark):
    rows = [(None, None), (2, ""), (3, "mit license MIT  License cc by-nc"), (4, "MIT licenses; gnu general\npublic-license"), (5, "é apache license " * 3)]
    got = {r.doc_id: r for r in m.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, labels int"), "doc_id", "text").collect()}
    assert (got[None].n_words, got[None].n_base, got[None].first_word, got[None].labels, got[None].score) == (0, 0, None, "", 0.0)
    assert (got[3].n_words, got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (7, 3, 0, 4, "cc-by,mit")
    assert (got[4].n_base, got[4].base_labels, got[4].first_word) == (1, "gpl", 2)
    assert (got[5].n_words, got[5].n_base, got[5].last_word) == (9, 3, 7)


def test_templates_with_gaps_and_blocks(monkeypatch):
    auto = m.Automaton(m.TEMPLATES, m.PHRASES)
    words = m.TEMPLATES[1][1].split()
    labels, score = scanned(auto, "start " + " ".join(words[:30]) + " odd one " + " ".join(words[33:]))
    assert labels == {"MIT"} and 0.9 < score < 1
    assert scanned(auto, " ".join(words[:20]))[0] == set()
    text = "Foo bar, Licensed under the Apache License, Version 2.0. " * 30
    whole = auto.coded(text.encode())
    found, score = auto.spans(whole)
    assert score == 1 and [x[0] for x in found] == ["Apache-2.0"] * 30 and found[1] == ("Apache-2.0", 12, 19, 8)
    for block in (7, 37, 41):
        monkeypatch.setattr(m, "BLOCK", block)
        assert (auto.coded(text.encode()) == whole).all()
        assert (auto.coded(text.upper().encode()) == whole).all() and len(auto.coded(("MIXEDcase wORDS " * 9).encode())) == 18


def test_edited_licences_keep_their_label():
    auto = m.Automaton(m.TEMPLATES, m.PHRASES)
    for label, text in m.TEMPLATES:
        words = text.split()
        if len(words) < 40:
            continue
        half = len(words) // 2
        repeat = words[:half] + words[:3] + words[half:]  # its own start again in the middle
        changed = [w if i % 8 != 7 else "changed" for i, w in enumerate(words)]
        assert scanned(auto, text)[0] == {label} and scanned(auto, " ".join(repeat)) == ({label}, 1)
        labels, score = scanned(auto, " ".join(changed))
        assert label in labels and score >= 0.85
    both = f"{m.TEMPLATES[1][1]} some words between that no licence holds at all {m.TEMPLATES[3][1]}"
    spans, _ = auto.spans(auto.coded(both.encode()))
    assert [x[0] for x in spans] == ["MIT", "ISC"] and spans[0][1] == 0 and spans[1][2] == len(both.split()) - 1


def test_against_brute_force(spark, sf_dir):
    import re

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in m.op10_license_scan(spark, sf_dir).collect():
        low = docs[r.doc_id].translate({i: i + 32 for i in range(65, 91)})
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(i, label) for p, label in m.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(at)) and r.base_labels == ",".join(sorted({x for _, x in at}))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
