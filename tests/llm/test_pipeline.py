"""The pipeline over a small corpus with planted cases, against a plain version of each stage."""

import random

import corpus_pipeline
from test_decontam import edits, plain
from test_simhash import slow_components, slow_fingerprint

from tessera.llm import decontam, sp_dropout, toxicity


def corpus(spark, path):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bad = ["idiotic", "wretchedly", "despicable", "vile"]
    items = [(i, text(25)) for i in range(5)]
    docs, labels, shared = {}, [], text(90)
    for i in range(160):
        docs[i] = text(rng.randint(60, 160))
        labels.append((i, 1, int(i % 8 == 0)))
        if i % 8 == 0:
            words = docs[i].split()
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
            docs[i] = " ".join(words)
    docs[200], docs[201] = docs[1], docs[1].upper()
    docs[202], docs[203] = text(40) + " " + shared + " " + text(30), text(70) + "\n" + shared + " " + text(50)
    docs[204] = text(40) + ". " + items[2][1].capitalize() + "! " + text(20)
    docs[205], docs[206], docs[207] = "", None, "only three words"
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, labels, items, shared


def test_pipeline_against_plain_stages(spark, tmp_path):
    docs, labels, items, shared = corpus(spark, f"file://{tmp_path}")
    sf = f"file://{tmp_path}"
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {k: t for k, t in docs.items() if model.at_least(set(toxicity.words_of((t or "").encode())))[0] < 0.5}
    assert set(docs) - set(kept) == {k for k, _, toxic in labels if toxic}
    classes = slow_components({k: slow_fingerprint(t) for k, t in kept.items()})
    kept = {k: t for k, t in kept.items() if classes[k] == k}
    assert 1 in kept and not {200, 201, 206} & set(kept)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    leaks = {k for k, t in kept.items() if any(edits(plain(s), plain(t)) <= decontam.budget(len(plain(s))) for _, s in items)}
    assert leaks == {204} and set(got) == {k for k in kept if k not in leaks}
    encoder = sp_dropout.Encoder()
    for k, r in got.items():
        text = encoder.decode(r.ids)
        assert r.lossless and r.lang == "en" and r.source == "s"
        if k == 203:
            assert len(set(shared.split()) & set(text.split())) < 45 and text.split()[:70] == docs[203].split()[:70]
        else:
            assert text == (docs[k] or "")


def test_stages_keep_the_columns_of_documents():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "sentencepiece_encoding"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_whose_names_they_use(spark, tmp_path):
    sf = f"file://{tmp_path}"
    docs, labels, items, shared = corpus(spark, sf)
    names = ["grade", "p_toxic", "expected_severity", "_text", "whole", "_n", "n", "kept", "_kept", "low", "_spans", "spans", "of", "key", "_found", "found", "cut", "gone", "component_id", "c0", "c1", "x0", "row"]
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    rows = rows.select(*(rows.columns[:1]), *((rows["doc_id"] * 7 + i).alias(n) for i, n in enumerate(names)), *rows.columns[1:])
    empty = rows.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, sf)
        assert out.columns == rows.columns and out.dtypes == rows.dtypes, name
        got = out.collect()
        assert got and all(r[n] == r.doc_id * 7 + i for r in got for i, n in enumerate(names)), name
        assert stage(spark, empty, sf).count() == 0, name
    assert corpus_pipeline.tokenise(spark, rows, sf).count() == len(docs) and corpus_pipeline.tokenise(spark, empty, sf).count() == 0


def test_stages_over_odd_rows(spark, tmp_path):
    """Null keys, repeated keys with other texts, a text that was once a mark, one very long text."""
    sf = f"file://{tmp_path}"
    docs, labels, items, shared = corpus(spark, sf)
    odd = [(None, docs[1]), (None, None), (5, "another text under a key that is there"), (900, "\x00￾ gone ￾\x00"), (901, "long " * 70_000 + shared), (902, " ".join(["x"] * 3))]
    rows = spark.read.parquet(f"{sf}/documents.parquet").unionByName(spark.createDataFrame([(k, t, None, None, None if t is None else len(t)) for k, t in odd], "doc_id long, text string, lang string, source string, n_chars long"))
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, rows, sf).collect()
        keys = [r.doc_id for r in got]
        assert {900, 902} <= set(keys) and keys.count(None) == 2, name
    left = {r.doc_id: r.text for r in corpus_pipeline.substring_dedup(spark, rows, sf).collect() if r.doc_id}
    assert left[900] == odd[3][1] and left[901].split() == ["long"] * 70_000 and shared not in left[901]
