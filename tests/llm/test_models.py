import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import quality_pu as q
from tessera.llm import quality_rules as r
from tessera.llm import toxicity as t
from tessera.llm.rows import labelled_sample

SF = "/root/testdata/sf0.1"
RULES_SF = "/root/testdata/sf0.01"


def test_ordinal_fit_recovers_grades():
    rng = random.Random(1)
    docs, grades = [], []
    for _ in range(600):
        g = rng.choice([0, 0, 0, 1, 2, 3])
        words = {f"w{rng.randrange(300)}" for _ in range(30)} | {f"bad{rng.randrange(12)}" for _ in range(3 * g)}
        docs.append(words)
        grades.append(g)
    flat = [np.unique(np.array([f for w in d for f in t.features(w)], np.uint32)) for d in docs]
    model = t.fit_ordinal(flat, np.array(grades), np.ones(600))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 3
    mean = [np.mean([sum(model.at_least(d)) for d, g in zip(docs, grades) if g == k]) for k in range(4)]
    assert mean == sorted(mean) and mean[0] < 0.2 and mean[3] > 2
    assert all(a >= b for d in docs for a, b in zip(model.at_least(d), model.at_least(d)[1:]))


def test_toxicity_on_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = t.fit(docs, labels.where("doc_id % 4 <> 0"))
    got = t.score(docs.where("doc_id % 4 = 0"), model).join(labels, "doc_id").select("toxic", "p_toxic").collect()
    yes, no = [x.p_toxic for x in got if x.toxic], [x.p_toxic for x in got if not x.toxic]
    assert np.mean(np.array(yes) >= 0.5) > 0.9 and np.mean(np.array(no) >= 0.5) < 0.02


def test_toxicity_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (2, "")], "doc_id long, text string").selectExpr("*", "1 as grade", "2 as label")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.fit(df, none)
    assert [x.grade for x in t.score(df, model).collect()] == [0] * 4 and t.score(df.limit(0), model).count() == 0
    assert t.fit(df, spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, toxic int")).weights == {}


def test_sample_is_bounded_and_weighted(spark):
    labels = spark.range(500).selectExpr("id doc_id", "cast(id % 5 = 0 as int) toxic").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    got = labelled_sample(labels, "toxic", "doc_id", 30).groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()
    assert {x.label: (x.n, round(x.w)) for x in got} == {0: (30, 400), 1: (30, 100)}


def test_quality_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = q.score(docs, q.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    good, bad = [x.score for x in got if x.quality], [x.score for x in got if not x.quality]
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([x.predicted == x.quality for x in got]) > 0.95


def test_quality_classifier_ignores_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{RULES_SF}/documents.parquet"), spark.read.parquet(f"{RULES_SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert q.fit(docs, labels) == q.fit(docs, turned)


def test_quality_classifier_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (2, "")], "doc_id long, text string").selectExpr("*", "1 as score", "2 as held_out")
    model = q.fit(df, spark.createDataFrame([], "doc_id long, quality int"))
    assert all(0 <= x.score <= 1 for x in q.score(df, model).collect()) and q.score(df.limit(0), model).count() == 0
    assert all(np.isfinite(q.statistics(x)).all() for x in (None, b"", b" ", b"!" * 100_000, "é|".encode() * 999))


def slow_statistics(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_statistics_against_plain_ones(spark):
    texts = [None, "", "a b\na b\n \n\n", "a " * 30, "x y z w v " * 3 + "u", "é | # <b>\x85 \x1c", *(x.text for x in spark.read.parquet(f"{RULES_SF}/documents.parquet").limit(120).collect())]
    for x in texts:
        assert r.base_statistics(None if x is None else x.encode()) == slow_statistics(x)


def test_chi_square():
    assert abs(r.chi2_below(r.chi2_quantile(0.95, 4), 4) - 0.95) < 1e-9 and abs(r.chi2_quantile(0.95, 4) - 9.4877) < 1e-3


def test_mcd_is_not_moved_by_outliers(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal([1, 2], [1, 0.5], (900, 2)), rng.normal([30, 40], 1, (200, 2))])
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in x], "grp string, a double, b double")
    p = r.mcd(df, "grp", {"a": 0.01, "b": 0.01}).first()
    assert abs(p.mu[0] - 1) < 0.2 and abs(p.mu[1] - 2) < 0.1 and 0.6 < p.prec[0] < 1.6 and 2.4 < p.prec[3] < 6


def test_quality_rules(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = r.quality_rules(d).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("not base_failed").collect()
    assert np.mean([x.kept for x in got if x.quality]) > 0.995 and np.mean([x.kept for x in got if not x.quality]) < 0.1


def test_quality_rules_edges(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, None, "en", None), (2, "", None, "s"), (None, good, "en", "s"), (4, good, "en", "s"), (4, good, "en", "s"), (5, "a b c d e f " * 9, "xx", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as grp", "2 as x_length")
    got = sorted((str(x.doc_id), x.n_words, x.base_failed, x.kept) for x in r.quality_rules(df).collect())
    assert got == [("1", 0, True, False), ("2", 0, True, False), ("4", 40, False, True), ("4", 40, False, True), ("5", 54, True, False), ("None", 40, False, True)]
    assert r.quality_rules(df.limit(0)).count() == 0


def test_every_grade_is_in_the_sample(spark):
    labels = spark.range(650).selectExpr("id doc_id", "cast(id % 65 as int) toxic")
    assert labelled_sample(labels, "toxic", "doc_id", 5).select("label").distinct().count() == 65
