"""Spelling variants against all pairs of words."""

import random

from rtdw.llm import spelling_variants as S
from tests.llm import brute

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_fixture_equals_all_pairs(docs, empty, corpus):
    want = brute.spelling_variants(corpus)
    assert want and rows(S.variants(docs)) == want
    assert S.variants(empty).count() == 0


def _noisy(seed):
    rng = random.Random(seed)
    stems = ["straße", "aaaaaa", "colour", "colours", "Éclair", "banana", "tionale", "überall", "xxabcxx"]
    docs = []
    for i in range(120):
        out = []
        for _ in range(25):
            w = list(rng.choice(stems))
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
                at, what = rng.randrange(len(w)), rng.choice("idr")
                if what == "d":
                    del w[at]
                else:
                    w[at:at + (what == "r")] = rng.choice("aeoßü×Z")
            out.append("".join(w))
        docs.append((i - 3, rng.choice((" ", ", ", "1", "\n")).join(out)))
    return docs + [(None, "colour colour coluor colour"), (5, None), (5, ""), (7, "banana " * 400 + "a" * 9000),
                   (8, "planet " * 40 + "planes " * 12 + "planas " * 4)]


def test_inserted_deleted_and_replaced_letters(spark):
    """Runs of one letter, chains of forms, ties, null ids, repeated ids, a very
    long run; a small range size carries node numbers over many ranges."""
    corpus = _noisy(1)
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    want = brute.spelling_variants(corpus)
    assert any(w != r and f != r for w, _, _, f, _, r in want if f)          # chains longer than one
    assert rows(S.variants(df)) == want
    old, S.CHUNK = S.CHUNK, 3
    try:
        assert rows(S.variants(df)) == want
    finally:
        S.CHUNK = old


def test_nodes_are_numbered_as_in_one_trie(spark):
    words = ["a", "ab", "abc", "abd", "b", "ba", "bab", "babb", "c", "cab"]
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i long")
    for chunks in (1, 2, 4, 7):
        nodes = {}
        for r in S.trie(df, "w", "i", chunks).collect():
            assert len(r["nodes"]) == len(r["key"]) + 1
            for k, x in enumerate(r["nodes"]):
                assert nodes.setdefault(r["key"][:k], x) == x
        assert len(set(nodes.values())) == len(nodes)
        ends = [nodes[w] for w in sorted(words)]
        assert ends == sorted(ends)
