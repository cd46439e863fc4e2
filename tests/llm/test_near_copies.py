import random

import corpus_pipeline

from tessera.llm import near_copies


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def components(docs, similarity=0.8):
    root, sets = {k: k for k in docs}, {k: shingles(t) for k, t in docs.items()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(docs)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k: find(k) for k in keys}


def corpus():
    rng = random.Random(8)
    words = lambda n: ["".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(n)]
    texts = [words(rng.randint(30, 200)) for _ in range(40)]
    foot = words(12)
    for base in texts[:12]:
        for edits in range(1, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = words(1)[0]
            texts.append(w)
    texts += [words(rng.randint(3, 60)) + foot for _ in range(60)]
    return dict(enumerate([" ".join(w) for w in texts] + ["", None, "one two", "One  two"]))


def test_components_against_all_pairs(spark):
    docs = corpus()
    want = components(docs)
    assert sum(want[k] != k for k in want) > 20
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for hot in (64, 4):
        assert {r.doc_id: r.component_id for r in near_copies.near_copies(df, hot=hot).collect()} == want


def test_stage_of_the_pipeline_drops_near_copies(spark):
    docs = corpus()
    df = spark.createDataFrame(list(docs.items()) + [(None, docs[0]), (3, docs[3])], "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect() if r.doc_id is not None)
    assert kept == sorted(k for k, c in components(docs).items() if c == k)
    assert near_copies.near_copies(df.limit(0)).count() == 0
