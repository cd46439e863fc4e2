from tessera.llm import sp_dropout as s


def test_every_occurrence_draws_its_own_skips():
    e = s.Encoder(seed=3)
    text = "repetition " * 400
    segments = e.vocabulary.cut.findall((" " + text).replace(" ", s.SPACE))
    own = [e.segment_ids(x, i, 5) for i, x in enumerate(segments)]
    assert e.encode(text, 5) == [i for ids in own for i in ids]
    assert len(set(own)) > 20  # two variants gave no more than two
    assert e.encode(text, 6) != e.encode(text, 5)


def test_kept_orders_give_what_merging_gives():
    e = s.Encoder(dropout=0.4)
    text = "unbelievable characterisation of Donaudampfschiff " * 60 + "x" * 90
    own = [e.segment_ids(x, i, 9) for i, x in enumerate(e.vocabulary.cut.findall((" " + text).replace(" ", s.SPACE)))]
    assert e.encode(text, 9) == [i for ids in own for i in ids]


def test_copies_under_other_keys_differ(spark):
    df = spark.createDataFrame([(1, "some words that are cut in pieces " * 20), (2, "some words that are cut in pieces " * 20)], "doc_id long, text string")
    a, b = s.encode(df).collect()
    assert a.lossless and b.lossless and a.ids != b.ids


def test_arrays_give_what_the_plain_agenda_gives():
    odd = ["", " ", "  two   spaces    ", "x" * 200 + " y", "日本語テキスト 🙂🙂 é" * 5, "a\tb\n\n  c \x00", "Unbelievable UNBELIEVABLE unbelievable " * 40, "a ▁b▁▁ c"]
    for dropout in (0.0, 0.1, 0.6):
        e = s.Encoder(dropout=dropout, seed=3)
        flat, size = e.encode_all(odd, list(range(len(odd))))
        assert [x.tolist() for x in s.np.split(flat, s.np.cumsum(size)[:-1])] == [e.encode(t, k) for k, t in enumerate(odd)]
        for k, t in enumerate(odd):
            assert e.decode(e.encode(t, k)) == t
            if s.SPACE not in t and t:
                own = [s.merge(e.vocabulary, x, int(e.keys(k, i + 1)[i]), e.skip) for i, x in enumerate(e.vocabulary.cut.findall((" " + t).replace(" ", s.SPACE)))]
                assert e.encode(t, k) == [i for ids in own for i in ids]


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(s, "CACHE", 50)
    monkeypatch.setattr(s, "GROUP", 64)
    text = " ".join(f"word{i} of{i % 7}" for i in range(500))
    few = s.Encoder(seed=1).encode(text, 4)
    monkeypatch.undo()
    assert few == s.Encoder(seed=1).encode(text, 4)
