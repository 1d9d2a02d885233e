"""Collocations against plain counting of all phrases."""

import random

import pytest

from rtdw.llm import collocations as C
from tests.llm import brute

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def _corpus(seed, many=60):
    rng = random.Random(seed)
    words = ["the", "New", "york", "times", "a", "über", "x\x0bz", "i.e", "the end", "𝄞"]
    sets = ["New York times", "once upon a time", "a a a a a", "the The THE", "in\tthe  end"]
    out = []
    for _ in range(many):
        parts = [rng.choice(sets) if rng.random() < 0.5 else rng.choice(words) for _ in range(60)]
        out.append((rng.choice(["en", "en", "de", None]), rng.choice([" ", "  ", ", ", "\n", " . "]).join(parts)))
    return out + [("en", None), ("en", ""), ("xx", "   ,.;"), ("a language of a long name", "so be it! " * 40),
                  ("a language of a long nome", "so be it " * 40)]


def test_phrases_equal_plain_counts(spark):
    corpus = _corpus(3)
    df = spark.createDataFrame([(*r, 1) for r in corpus], "lang string, text string, n int").repartition(5)
    for top in (2000, 7):
        want = brute.collocations(corpus, top=top)
        assert len({r[0] for r in want}) >= 4 and rows(C.collocations(df, top=top)) == want
    assert C.collocations(df.limit(0)).count() == 0


def test_fixture(docs, corpus):
    want = brute.collocations([("en", t) for _, t in corpus])
    assert want and rows(C.collocations(docs)) == want


def test_blocks_merges_and_hot_segments_change_nothing(spark, monkeypatch):
    """Texts cut at breaks, stripes merged in many small steps, and hot prefixes cut
    into segments."""
    corpus = [("en", " ".join(t for _, t in _corpus(4) if t)), *_corpus(5, 10)]
    df = spark.createDataFrame(corpus, "lang string, text string").repartition(3)
    monkeypatch.setattr(C, "HELD", 300)          # reaches the tasks with their functions
    monkeypatch.setattr(C, "HOT", 10_000)
    assert rows(C.collocations(df)) == brute.collocations(corpus)
    import pyarrow as pa
    batches = [pa.RecordBatch.from_arrays([
        pa.array([k // 2], pa.int32()), pa.array([[1, 3]]), pa.array([[]], pa.list_(pa.int64())), pa.array([[]], pa.list_(pa.int64())),
        pa.array([[3, 300]], pa.list_(pa.int32())), pa.array([[7, 8, 0, *range(300)]]), pa.array([[5, 1, 2, *[1] * 300]])],
        ["bucket", *C.KEYS, "many", "next", "n"]) for k in range(4)]
    got = [tuple(x.values()) for b in C._merge(1, 4)(iter(batches)) for x in b.to_pylist()]
    # (w1, w2, w3, next, n, top) of two buckets of two tasks each
    want = [(1, 0, 0, 0, 16, 10), (3, 0, 0, 0, 600, 0), (1, 0, 0, 7, 10, 0)]
    assert sorted(got) == sorted(want * 2)


def test_rows_that_share_a_hash_are_summed_apart(monkeypatch):
    import numpy as np
    monkeypatch.setattr(C, "mixed", lambda x: x & np.uint64(3))
    rng = np.random.default_rng(3)
    columns = [rng.integers(1, 9, 500).astype(np.uint64) for _ in range(3)]
    got, n = C._summed(columns, np.ones(500, np.int64))
    want = np.unique(np.stack(columns), axis=1, return_counts=True)
    assert sorted(zip(*(c.tolist() for c in got), n.tolist())) == sorted(zip(*want[0].tolist(), want[1].tolist()))


def test_word_hashes_follow_the_bytes():
    import numpy as np
    words = ["a", "ab", "abcdefgh", "abcdefghi", "x" * 63, "x" * 64, "x" * 65, "x" * 66, "é", "a\0", "abcdefgh" * 3, "abcdefgh" * 2]
    t = C._Tokens(["en"], [" ".join(words + words[::-1]).encode()], 7)
    h = t.ids.tolist()
    assert h[:len(words)] == h[len(words):][::-1] and len(set(h)) == len(words)
    assert t.spelt(np.arange(len(words))) == words


def test_long_texts_are_cut_at_breaks(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(C, "BLOCK", 500)
    text = _corpus(4)[0][1] * 20 + " end" + "x" * 2000
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en"]), pa.array(["a. b", text, None])], ["lang", "text"])
    blocks = [x for langs, texts in C._texts(iter([batch])) for x in zip(langs, texts)]
    parts = [x for lang, x in blocks if lang == "de"]
    assert b"".join(parts) == text.encode() and len(parts) > 5
    assert all(p[-1:] in (b".", b",", b"\n", b"\x0b") for p in parts[:-1])


def test_a_hash_shared_by_two_words_is_noticed(spark, monkeypatch):
    """With two words of one id in the first seed, the next seed is taken."""
    corpus = [("en", "alpha beta gamma. " * 40), ("en", "alpha delta gamma. " * 35)]
    plain = C._Tokens.hash

    def poor(self, seed):
        import numpy as np
        h = plain(self, seed)
        return h & np.uint64(6) if seed == C._seed(0) else h

    # workers import the module afresh, so the ids are made here
    monkeypatch.setattr(C._Tokens, "hash", poor)
    t = C._Tokens(["en"], [b"alpha beta gamma delta epsilon"], C._seed(0))
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 2), pa.array([x[1] for x in corpus])], ["lang", "text"])
    found = [r for b in C._vocabulary(0)(iter([batch])) for r in b.to_pylist()]
    assert len(set(t.ids.tolist())) < 5 and sorted(r["word"] for r in found) == ["alpha", "beta", "delta", "gamma"]
    assert len({r["id"] for r in found}) < 4


def test_other_lengths(spark):
    with pytest.raises(ValueError):
        C.collocations(spark.createDataFrame([("en", "x")], "lang string, text string"), longest=5)
