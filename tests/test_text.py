"""Golden values, and native expressions against plain Python."""

import random
import re
import unicodedata

from pyspark.sql import functions as F

from tessera.functions import similarity as sim
from tessera.functions import text as t
from tessera.functions.fractions import hash_fraction, mersenne_fraction, payload
from tessera.schema import PREFIX_TOKENS, TERMINATORS
from tessera.sources.tables import read_csv, write_csv

ADDRESSES = {
    4: ("Desa Tunggalroso, Kecamatan Prembun, Kabupaten Kebumen, Jawa Tengah", "DESA TUNGGALROSO KECAMATAN PREMBUN KABUPATEN KEBUMEN JAWA TENGAH", ["DESA TUNGGALROSO", "DESA"]),
    10: ("Jl. Kerinci No. 20, Banjarsari, Kec. Banjarsari, Kota Surakarta, Jawa Tengah", "JL KERINCI NO 20 BANJARSARI KEC BANJARSARI KOTA SURAKARTA JAWA TENGAH", ["JL KERINCI", "JL", "KERINCI"]),
    15: ("Jl. Raya Sumberagung RT 1", "JL RAYA SUMBERAGUNG RT 1", ["JL RAYA SUMBERAGUNG", "JL RAYA", "RAYA SUMBERAGUNG", "JL", "RAYA", "SUMBERAGUNG"]),
    29: ("Jl. Sungai Kendal No 3", "JL SUNGAI KENDAL NO 3", ["JL SUNGAI KENDAL", "JL SUNGAI", "SUNGAI KENDAL", "JL", "SUNGAI"]),
    39: ("Jl. Tayu - Juwana RT 02/RW 06, Cebolek Kidul, Margoyoso, Pati", "JL TAYU JUWANA RT 02 RW 06 CEBOLEK KIDUL MARGOYOSO PATI", ["JL TAYU JUWANA", "JL TAYU", "TAYU JUWANA", "JL", "TAYU"]),
}


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"a {kind}").select(column(F.col("a")).alias("x")).first().x


def test_golden_addresses(spark):
    for raw, norm, phrases in ADDRESSES.values():
        assert one(spark, t.normalize_text, raw) == norm
        assert [p.phrase for p in one(spark, t.candidate_phrases, raw)] == phrases


def plain_normalize(v):
    s = "".join(c for c in unicodedata.normalize("NFKD", "" if v is None else v) if not unicodedata.combining(c)).upper()
    return re.sub(r"\s+", " ", re.sub(r"[/,;:()\-.']", " ", s.replace("&", " AND "))).strip()


def plain_phrases(v):
    found = []
    for seg in plain_normalize(v).split("|"):
        w = seg.split()
        if not w:
            continue
        vs = [w]
        if w[0] in PREFIX_TOKENS:
            vs.append(w[1:])
            if w[1:2] == ["RAYA"]:
                vs.append(w[2:])
        if w[0] == "RAYA":
            vs.append(w[1:])
        for x in vs:
            x = x[: next((i for i, y in enumerate(x) if y in TERMINATORS), len(x))]
            found += [" ".join(x[:n]) for n in range(min(len(x), 8), 0, -1)]
    return sorted(dict.fromkeys(found), key=lambda p: -len(p.split()))


def test_against_plain_python(spark):
    rng = random.Random(1)
    vocabulary = ["Jl.", "JALAN", "Raya", "raya", "NO", "12", "a", "Mäwar", "Ñandú", "|", "&", "(x)", "KM", "Gg", "ß", "é", "-", "  ", "\n", " ", "Blok", "RT", "desa", "ﬀ"]
    values = [None, "", " ", "&"] + [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 14))) for _ in range(400)]
    plain = [v for v in values if "ﬀ" not in (v or "")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(plain)], "i int, a string").select("i", t.normalize_text(F.col("a")).alias("n"), t.candidate_phrases(F.col("a")).alias("p")).collect()
    for r in rows:
        assert r.n == plain_normalize(plain[r.i])
        assert [x.phrase for x in r.p] == plain_phrases(plain[r.i]) and [x["rank"] for x in r.p] == list(range(1, len(r.p) + 1))
    exact = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a string").select("i", t.normalize_text(F.col("a"), exact=True).alias("n")).collect()
    assert all(r.n == plain_normalize(values[r.i]) for r in exact)


def test_names(spark):
    cases = [
        (t.normalize_province, "Provinsi Daerah Khusus Ibukota Jakarta", "JAKARTA"), (t.normalize_province, "D K I", "DKI"), (t.normalize_admin, "Kab. Kebumen", "KEBUMEN"), (t.normalize_admin, "KOTA KOTAMOBAGU", "KOTAMOBAGU"),
        (t.normalize_city, "Kota Adm. Jakarta Utara", "JAKARTA UTARA"), (t.normalize_city, "Kep. Seribu", "KEPULAUAN SERIBU"), (t.admin_kind, "KOTA X", "city"), (t.admin_kind, "Kab X", "regency"), (t.admin_kind, None, "unknown"),
        (t.admin_level, "level 07", 7), (t.admin_level, "x", None), (t.normalize_road, "Jl. Gang Raya Mawar", "MAWAR"), (t.normalize_road, "Raya Mawar", "RAYA MAWAR"), (t.normalize_road, "Unnamed Road", ""), (t.normalize_road, "Jalan", ""),
        (t.join_spaced_letters, "A", "A"), (lambda c: t.index_tokens(t.normalize_text(c)), "Jl Mawar no 5 ab Mawar", ["MAWAR", "5", "MAWAR"]), (lambda c: t.context_phrases(c, c), "Kota Batam", ["KOTA BATAM", "BATAM"]),
    ]
    for f, value, want in cases:
        assert one(spark, f, value) == want, (value, want)


def test_similarity(spark):
    df = spark.createDataFrame([("TOBA", "TOBASAMOSIR", 0.98), ("AABBC", "ABCBAA", 0.36363636363636365), ("ABCBAA", "AABBC", 0.5454545454545454), ("", "A", 0.0), ("A B", "AB", 1.0), ("MELATI INDAH", "INDAH MELATI", 1.0)], "q string, r string, want double")
    assert all(r.s == r.want for r in sim.scored(df, "q", "r", "s").collect())
    assert df.select(sim.sequence_ratio("q", "r").alias("s")).first().s == 0.5333333333333333
    assert df.select(sim.name_score(F.col("q"), F.col("r")).alias("s")).first().s == 0.99
    gate = spark.createDataFrame([(1, "a", 1, 0.98), (1, "b", 1, 0.93), (2, "a", 1, 1.0), (2, "b", 1, 0.95), (3, "a", 1, 0.82), (4, "a", 2, 0.81)], "k int, road_name string, overlap int, score double")
    assert {r.k: r.accepted for r in sim.best_with_margin(gate, ["k"]).collect()} == {1: False, 2: True, 3: True, 4: False}


def test_fractions(spark):
    df = spark.createDataFrame([(2, 1, "JAWA TENGAH", "KEBUMEN", "BUAYAN", "ADIWARNO", "SPPG Kebumen Buayan Rangkah")], "r long, no long, a string, b string, c string, d string, n string")
    text = payload(20260507, "kelurahan/desa", *(F.col(c) for c in df.columns))
    got = df.select(text.alias("p"), mersenne_fraction(text).alias("m"), hash_fraction(text).alias("h")).first()
    assert got.p == "20260507|kelurahan/desa|2|1|JAWA TENGAH|KEBUMEN|BUAYAN|ADIWARNO|SPPG Kebumen Buayan Rangkah"
    assert got.m == 0.7929262353044355 and 0 <= got.h < 1 and abs(got.h - 0xE8F1C2752E9A6 / 2**52) < 1e-15


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c\r\nd'), (2, None)], "No long, `Kab./Kota` string")
    write_csv(df.coalesce(1), f"{tmp_path}/x")
    assert next(tmp_path.glob("x/*.csv")).read_bytes()[:3] == b"\xef\xbb\xbf"
    back = read_csv(spark, f"{tmp_path}/x")
    assert back.columns == df.columns and back.first()[1] == 'a "b", c\r\nd'
