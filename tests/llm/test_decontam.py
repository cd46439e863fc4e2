import random

import numpy as np

from tessera.llm import decontam as d


def edits(item, text):
    """Least edits of all of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        old, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(old[j - 1] + (a != b), old[j] + 1, row[j - 1] + 1))
    return min(row)


def plain(text):
    return "".join(chr(c) for c in d.normalise(text)[0])


def test_normalise():
    assert plain(" Ab,  c!\n") == "ab c" and plain(None) == plain("?!") == "" and plain("É 漢字🙂x") == "é 漢字🙂x"
    x, at = d.normalise("--Ab,  c")
    assert [("--Ab,  c"[i]).lower() if chr(c) != " " else "," for c, i in zip(x, at)] == ["a", "b", ",", "c"]


def test_banded_alignment():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 25))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 60))]
        want, k = edits(item, text), rng.randrange(8)
        got = d.banded_distance(np.array(item, np.uint32), np.array(text, np.uint32), k, -len(item), len(item) + len(text))
        assert (got is None) == (want > k)
        if got:
            assert got[0] == want == edits(item, text[got[1] : got[2]])


def test_search_against_brute_force(spark):
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) for _ in range(n))
    items = [(i, text(rng.randint(2, 30)).capitalize() + ".") for i in range(25)]
    docs = []
    for n in range(160):
        body = list(rng.choice(items)[1])
        for _ in range(rng.randrange(0, max(1, len(body) // 7))):
            j = rng.randrange(len(body))
            body[j : j + 1] = rng.choice([[], ["x"], [body[j], "y"], [" "]])
        docs.append((n, text(rng.randrange(40)) + rng.choice([" ", "\n", ", "]) + "".join(body) + " " + text(rng.randrange(40)) if n % 4 else text(60)))
    want = {}
    for n, t in docs:
        for i, s in items:
            e = edits(plain(s), plain(t))
            if e <= d.budget(len(plain(s))):
                want[n, i] = e
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (d.PASS_CHARS, 900):
        got = {(r.doc_id, r.item_id): r.edits for r in d.contaminated(df, bench, pass_chars=size).collect()}
        assert got == want and len(want) > 60
    for r in d.contaminated(df, bench).collect():
        assert edits(plain(dict(items)[r.item_id]), plain(dict(docs)[r.doc_id][r.start : r.end])) == r.edits


def test_edges(spark):
    bench = spark.createDataFrame([(1, "Some benchmark question of a certain length?"), (2, None), (3, ""), (4, "..."), (None, "another item that has no id at all")], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, "some BENCHMARK question -- of a certain length"), (3, "x " * 100_000 + "some benchmark\nquestion of a certain length " + "y" * 1000), (3, "nothing"), (5, "another item that has no id at all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as key")
    assert sorted((str(r.doc_id), str(r.item_id), r.edits) for r in d.contaminated(df, bench).collect()) == [("3", "1", 0), ("5", "None", 0), ("None", "1", 0)]
    assert sorted(str(r.doc_id) for r in d.decontaminate(df, bench).collect()) == ["1", "2", "None"]
    assert d.contaminated(df.limit(0), bench).count() == d.contaminated(df, bench.limit(0)).count() == 0


def test_short_items_in_texts_of_any_length():
    index = d.Index([(1, "abcdefg")])
    for n in (1_000_000, 9_000_000):
        assert index.search(["x" * n + " abcdefg " + "y" * 50, "abcdefg"]) == [(0, 1, n + 1, n + 8, 0), (1, 1, 0, 7, 0)]
