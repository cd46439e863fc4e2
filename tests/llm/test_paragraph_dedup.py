import random

import numpy as np

from tessera.llm import paragraph_dedup as p


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def test_cuts_and_spans():
    rng = random.Random(1)
    for t in ("", " \n", "one", "a b", " ".join(words(rng, 500)), "the " * 300, "é" * 50 + " ü"):
        q = p.Paragraphs(t.encode())
        assert q.n.sum() == len(t.split()) and (len(q.n) == 0 or q.n.max() <= p.LONGEST)
        assert b" ".join(t.encode()[a:b] for a, b in zip(q.start, q.end)).split() == t.encode().split()
        h = q.h
        for i in range(1, len(q.at)):
            assert q.at[i] - q.at[i - 1] > p.REACH or q.n[i - 1] == p.LONGEST or i == 1
        assert all(len(m) == len(q.at) for m in q.minima(2)) and len(h) == len(t.split())


def test_bands():
    assert p.bands_for(0.8, 0.95) == 2 and p.bands_for(0.8, 0.99) == 3


def test_planted_passages(spark):
    rng = random.Random(2)
    shared = [" ".join(words(rng, n)) for n in (51, 60, 75, 100, 180, 55, 58, 64, 90, 120) * 4]
    docs = [(i, " ".join(words(rng, rng.randint(20, 200)) + [s] + words(rng, rng.randint(5, 200)))) for i, s in enumerate(shared + shared)]
    clean = [(1000 + i, " ".join(words(rng, 150)) + " this work is licensed under the usual license of everyone here") for i in range(30)]
    df = spark.createDataFrame(docs + clean, "doc_id long, text string").selectExpr("*", "length(text) as n_chars", "0 as key", "1 as unit")
    rows = p.repeated_passages(df).collect()
    assert {r.doc_id for r in rows} <= {d for d, _ in docs}
    missed = {d for d, _ in docs} - {r.doc_id for r in rows}
    assert len(missed) <= 8, missed
    for r in rows:
        s = shared[r.doc_id % len(shared)]
        got = dict(docs)[r.doc_id].encode()[r.start_byte : r.end_byte].decode().split()
        assert sum(w in s.split() for w in got) >= len(got) - 3  # paragraphs may differ at a word or two
        assert r.first_key == r.doc_id % len(shared) and r.removed == (r.doc_id >= len(shared))
    left = {r.doc_id: r for r in p.remove_repeats(df).collect()}
    assert len(left) == len(docs) + len(clean)
    assert all(left[d].text == t for d, t in docs[: len(shared)] + clean)
    assert all(len(left[d].text) == left[d].n_chars for d, _ in docs)


def test_near_paragraphs_against_all_pairs(spark):
    rng = random.Random(4)
    base = words(rng, 40)
    texts = set()
    for i in range(120):
        w = list(base)
        if i % 3:
            w[rng.choice([0, -1])] = rng.choice(words(rng, 9))
        if i % 5 == 0:
            w[rng.randrange(40)] = "zz"
        texts.add(" ".join(w))
    sets, where = {}, []
    for k, t in enumerate(sorted(texts)):
        q = p.Paragraphs(t.encode())
        for i, c in enumerate(q.content.view(np.int64).tolist()):
            sets[c] = set(q.shingles(i).tolist())
            where.append((c, k))
    df = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string")
    units = p.paragraphs(df, "doc_id", "text", 2)
    groups = units.groupBy("content").agg({"key": "min", "m0": "min", "m1": "min"}).toDF("content", *[c for c in units.groupBy("content").agg({"key": "min", "m0": "min", "m1": "min"}).columns[1:]])
    groups = groups.selectExpr("content", "`min(key)` key", "`min(m0)` m0", "`min(m1)` m1")
    ok = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = {(a, b) for a in sets for b in sets if a < b and ok(a, b)}
    got = {(r.a, r.b) for r in p.near_links(df, groups, "doc_id", "text", 2).collect()}
    assert got <= want and len(got) >= 0.85 * len(want)
    few = {(min(r.a, r.b), max(r.a, r.b)) for r in p.near_links(df, groups, "doc_id", "text", 2, hot=4).collect()}
    assert few <= want

    def parts(links):
        root = {c: c for c in sets}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[find(a)] = find(b)
        return {frozenset(c for c in sets if find(c) == find(x)) for x in sets}

    assert parts(few) == parts(got)


def test_edges(spark):
    t = " ".join(words(random.Random(9), 80))
    df = spark.createDataFrame([(1, None), (2, ""), (None, t), (3, t), (3, t), (4, "the " * 400), (5, "the " * 400)], "doc_id long, text string")
    rows = {(r.doc_id, r.removed) for r in p.repeated_passages(df).collect()}
    assert {d for d, _ in rows} == {4, 5}
    assert sorted(str(r.doc_id) for r in p.remove_repeats(df).collect()) == ["1", "2", "3", "3", "4", "None"]
    assert p.repeated_passages(df.limit(0)).count() == 0
