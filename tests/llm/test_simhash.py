import re

import xxhash

from tessera.llm import simhash


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps):
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k: find(k) for k in keys}


def test_fingerprint_matches_a_plain_one():
    for t in (None, "", " \n", "One", "one two", "a b c", "Ünï x Y z w q", "a b c d " * 300, "x" * 9000, "\x1c a \x85 b c d"):
        assert simhash.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {k: slow_fingerprint(t) for k, t in docs.items()}
    want = {(k, f"{fps[k]:016x}", c) for k, c in slow_components(fps).items()}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.op1_simhash_near_dedup(spark, sf).collect()} == want


def test_links_of_random_fingerprints_and_crowded_cells(spark):
    import random

    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for _ in range(900):
        x = rng.choice(base[:3] if rng.random() < 0.7 else base)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    want = slow_components({f: f for f in fps})
    groups = {}
    for k, v in want.items():
        groups.setdefault(v, set()).add(k)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for hot, bits in ((2000, 2), (20, 2), (2000, 1)):
        got = {}
        for r in simhash.connected_components(simhash.hamming_links(df, bits=bits, hot=hot)).collect():
            got.setdefault(r.root, set()).add(r.node % (1 << 64))
        assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in groups.values() if len(g) > 1}


def test_edges_of_the_table(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "a b c d", 1), (3, "a b c d", 2), (3, "a b c d", 2), (4, "A b  c d", 3), (5, "z y", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, 3), (3, 3), (3, 3), (4, 3), (5, 5)], key=str)
    assert sorted(r.doc_id or 0 for r in simhash.keep_one(df).collect()) == [0, 1, 3, 5]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
