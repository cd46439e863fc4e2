import random

import pytest
import sentencepiece

from tessera.llm import sp_dropout as s
from tessera.llm import token_counts as t

TEXTS = ["", "a", " ", "  two  spaces ", "line\nline\r\n\ttab", "Ünïcödé ß 漢字 🙂", "<s> <0x0A> </s> <unk>", "x" * 3000, "the of and " * 50, "a\x00b", "naïve café, déjà-vu! 123 4567"]


def sample(spark, n=150):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(n).collect()]


def test_without_dropout_it_is_sentencepiece(spark):
    sp, e = sentencepiece.SentencePieceProcessor(model_file=s.MODEL), s.Encoder(dropout=0)
    for x in TEXTS + sample(spark):
        assert e.encode(x) == sp.encode(x), x[:60]


def test_dropout_is_lossless_seeded_and_varied(spark):
    one, again, other = s.Encoder(seed=1), s.Encoder(seed=1), s.Encoder(seed=2)
    longer = 0
    for x in [*TEXTS, "▁ marks ▁▁ in text▁", *sample(spark)]:
        ids = one.encode(x, 7)
        assert one.decode(ids) == x and again.encode(x, 7) == ids
        longer += len(ids) > len(s.Encoder(dropout=0).encode(x))
    assert longer > 100
    x = "segmentation of one sentence " * 30
    assert other.encode(x, 7) != one.encode(x, 7)
    assert len({one.segment_ids("▁segmentation", v) for v in range(2)}) > 1 or len({other.segment_ids("▁segmentation", v) for v in range(2)}) > 1
    assert s.merge(one.vocabulary, "▁abc", 1, 1 << 32) == tuple(one.vocabulary.ids[c] for c in "▁abc")


def test_short_and_long_agendas_agree(spark):
    v = s.pieces(s.MODEL)
    assert v.ordered
    for i, x in enumerate(" ".join(sample(spark, 40)).split()[:3000]):
        assert s.merge_short(v, "▁" + x, i, 1 << 30) == s.merge_long(v, "▁" + x, i, 1 << 30)


def test_encode_rows(spark):
    rows = [(1, None), (2, ""), (3, "text here"), (3, "text here"), (None, "z " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids")
    got = {r.doc_id: r for r in s.encode(df).collect()}
    assert all(r.lossless for r in got.values()) and got[1].n_pieces == got[2].n_pieces == 0 and s.encode(df.limit(0)).count() == 0
    assert s.Encoder().decode(got[3].ids) == "text here"


def slow(text, rule):
    enc, _ = t.encoding(t.VOCABULARY)
    data = text.encode()
    owner = []
    line = 0
    for b in data:
        owner.append(line)
        line += b == 10
    n = (owner[-1] if owner else 0) + 1
    counts, at = [0.0] * n, 0
    for piece in enc.decode_tokens_bytes(enc.encode_ordinary(text)):
        held = owner[at : at + len(piece)]
        at += len(piece)
        if rule == "split":
            for o in held:
                counts[o] += 1 / len(held)
        else:
            counts[{"start": held[0], "end": held[-1], "majority": max(sorted(set(held)), key=held.count)}[rule]] += 1
    return counts


@pytest.mark.parametrize("rule", t.RULES)
def test_counts_against_a_plain_count(spark, rule):
    rng = random.Random(3)
    texts = [*TEXTS, *sample(spark, 30), "".join(rng.choice(["\n", "\n\n", " ", "ab", "ü", "🙂", "\n  \n"]) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in t.token_counts(df, rule=rule).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start_char, r.n_chars, r.n_tokens))
    for i, x in enumerate(texts):
        own = sorted(got[i])
        assert [o[3] for o in own] == pytest.approx(slow(x, rule)), x[:50]
        assert "".join(x[o[1] : o[1] + o[2]] for o in own) == x


def test_count_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, "a\nb", 7), (2, "a\nb", 7)], "doc_id long, text string, section long")
    assert sorted((r.doc_id or 0, r.section, r.n_tokens) for r in t.token_counts(df).collect()) == [(0, 0, 0.0), (1, 0, 0.0), (2, 0, 2.0), (2, 0, 2.0), (2, 1, 1.0), (2, 1, 1.0)]
    assert t.token_counts(df.limit(0)).count() == 0
