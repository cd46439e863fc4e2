import random

from test_paragraph_dedup import words

from tessera.llm import paragraph_dedup as p


def spans(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    texts = {d: t.encode() for d, t in docs}
    return {(r.doc_id, texts[r.doc_id][r.start_byte : r.end_byte].decode(), r.n_words, r.first_key, r.removed) for r in p.repeated_passages(df).collect()}


def test_every_exact_passage_to_its_last_word(spark):
    rng = random.Random(21)
    shared = [" ".join(words(rng, 51 + i % 30)) for i in range(200)]
    docs = [(i + 1000 * c, " ".join(words(rng, 40)) + " 1" + str(c) + " " + s + " 2" + str(c) + " " + " ".join(words(rng, 40))) for c in (0, 1) for i, s in enumerate(shared)]
    want = {(i + 1000 * c, s, len(s.split()), i, c == 1) for c in (0, 1) for i, s in enumerate(shared)}
    assert spans(spark, docs) == want


def test_passages_with_changed_words(spark):
    rng = random.Random(22)
    docs, size = [], {}
    for i, (n, edits) in enumerate([(60, 1), (100, 2), (200, 4)] * 40):
        s = words(rng, n)
        t = list(s)
        for at in sorted(rng.sample(range(6, n - 6), edits)):
            t[at] = "changed"
        grams = lambda w: {tuple(w[j : j + 5]) for j in range(n - 4)}
        if len(grams(s) & grams(t)) >= 0.8 * len(grams(s) | grams(t)):
            docs += [(i, " ".join([*words(rng, 30), "left", *s, "right", *words(rng, 30)])), (i + 1000, " ".join([*words(rng, 30), "here", *t, "there", *words(rng, 30)]))]
            size[i + 1000] = n
    assert len(size) > 90
    found = dict.fromkeys(size, 0)
    for d, _, n, first, removed in spans(spark, docs):
        assert removed == (d >= 1000) and first == d % 1000
        if removed:
            found[d] += n
    assert found == size
