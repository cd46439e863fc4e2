import random

import numpy as np
from test_paragraph_dedup import words

from tessera.llm import paragraph_dedup as p


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def changed(rng, w, n):
    w = list(w)
    for at in rng.sample(range(len(w)), n):
        w[at] = words(rng, 1)[0] + "q"
    return w


def test_every_link_and_every_copy_is_compared(spark):
    rng, texts = random.Random(31), []
    for _ in range(12):
        x = words(rng, 57)  # chains of links that reach further than a link
        y = changed(rng, x, 3)
        z = changed(rng, y, 3)
        texts += [x, y, z, y, changed(rng, z, 3), z]
        again = words(rng, 20) * 4  # less than half of the words are different
        texts += [again, changed(rng, again, 1), changed(rng, again, 1)]
        short = words(rng, 20)  # a short paragraph
        texts += [short, changed(rng, short, 1), short[:-1]]
    texts = [" ".join(t) for t in texts]
    bands = p.bands_for(0.8, 0.95, p.ROWS)
    first, where, at, minima = {}, [], {}, {}
    for key, t in enumerate(texts):
        q = p.Paragraphs(t.encode())
        found = np.column_stack(q.minima(bands, p.ROWS))
        for i, c in enumerate(q.content.tolist()):
            first.setdefault(c, key)
            where.append((key, c))
            at[c], minima[c] = t.split()[q.at[i] : q.at[i] + q.n[i]], found[i]
    linked = [(a, b) for a in at for b in at if a < b and (minima[a] == minima[b]).any() and edits(at[a], at[b]) <= int(0.2 * max(len(at[a]), len(at[b])) + 1e-6)]
    want = {(max(first[a], first[b]), min(first[a], first[b])) for a, b in linked if first[a] != first[b]}
    want |= {(key, first[c]) for key, c in where if key != first[c]}
    few = [len(set(at[a])) * 2 < len(at[a]) for a, _ in linked]
    small = [len(at[a]) < 25 for a, _ in linked]
    assert sum(few) >= 10 and sum(small) >= 10 and len(linked) > 60
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = p.materialise(p.index(df, "doc_id", "text", bands, p.ROWS), "index")
    lines = {(r.key, r.first_key) for r in p.paragraph_lines(index, bands, p.SIMILARITY, 32).collect()}
    assert want <= lines, len(want - lines)

