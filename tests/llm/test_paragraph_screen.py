import random

from test_paragraph_links import edits

from tessera.llm import crowds
from tessera.llm import paragraph_dedup as p


def lines_of(spark, monkeypatch, texts):
    """Links that the lines show between texts of one paragraph each, all in one bucket, and how many pairs were screened."""
    rows = [(i, "".join(map(chr, t)).encode("utf-16-le"), [0], [len(t)], [i], [7]) for i, t in enumerate(texts)]
    index = p.materialise(spark.createDataFrame(rows, "key long, words binary, para_pos array<int>, para_n array<int>, para array<long>, bands array<long>"), "index")
    pairs, materialise = [], crowds.materialise

    def counted(df, name):
        table = materialise(df, name)
        if name == "pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(crowds, "materialise", counted)
    return {(r.first_key, r.key) for r in p.paragraph_lines(index, 1, p.SIMILARITY, 32).collect()}, sum(pairs)


def test_paragraphs_with_a_common_phrase_are_not_all_compared(spark, monkeypatch):
    rng, phrase = random.Random(3), list(range(200, 212))
    # each has a word of its own, an even number of times: no two are similar
    texts = [[1000 + i] * rng.randrange(20, 120, 2) + phrase for i in range(100)]
    found, pairs = lines_of(spark, monkeypatch, texts)
    assert not found and pairs <= 2 * len(texts), pairs  # in all: 4,950


def test_screen_loses_no_link(spark, monkeypatch):
    rng, texts = random.Random(5), set()
    for k in range(10):
        base = [rng.choice([300 + k, rng.randrange(400, 440)]) for _ in range(rng.randint(10, 60))]
        for _ in range(6):
            t = list(base)
            for _ in range(rng.randint(0, len(t) // 4)):
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 1)] = [rng.randrange(400, 440)] * rng.randint(0, 2)
            texts.add(tuple(t))
    texts = sorted(texts)
    links = {(a, b) for a, x in enumerate(texts) for b, y in enumerate(texts) if a < b and edits(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-6)}
    found, _ = lines_of(spark, monkeypatch, texts)
    root = list(range(len(texts)))
    for _ in texts:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert len(links) > 40 and len(texts) > 32
    assert {(root[i], i) for i in range(len(texts)) if root[i] != i} <= found and all(root[a] == root[b] for a, b in found)
