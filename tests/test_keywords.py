"""Dictionary segmentation against a plain longest match."""

import random
import re

import pytest

from rtdw.functions import keywords


def longest_match(text, words, longest):
    out, at = [], 0
    while at < len(text):
        for size in range(min(longest, len(text) - at), 0, -1):
            if text[at:at + size] in words:
                out.append(text[at:at + size])
                at += size
                break
        else:
            m = re.compile("[a-z0-9]+").match(text, at)
            if m:
                out.append(m[0])
                at = m.end()
            else:
                at += 1
    return out


def test_fifty_thousand_words_equal_the_longest_match(spark):
    rng = random.Random(9)
    chars = [chr(0x4e00 + k) for k in range(60)] + list("abcde")
    words = {"".join(rng.choices(chars, k=rng.randint(1, 6))) for _ in range(70_000)}
    words = sorted(words)[:50_000]
    assert len(words) == 50_000
    texts = ["".join(rng.choices(chars + list(" ,X9é"), k=rng.randint(0, 200))) for _ in range(200)] + [None, "", "ABC 中"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["w"] for r in df.select("i", keywords.tokenize("t", dictionary=words).alias("w")).collect()}
    held, longest = set(words), max(map(len, words))
    assert got == {i: None if t is None else longest_match(t.lower(), held, longest) for i, t in enumerate(texts)}
    rows = keywords.explode_keywords(df, "t", dictionary=words).count()
    assert rows == sum(len(w) for w in got.values() if w)


def test_han_characters_and_bounds(spark):
    df = spark.createDataFrame([("我们 like 苹果手机x",)], "t string")
    one = lambda **k: df.select(keywords.tokenize("t", **k).alias("w")).first()["w"]
    assert one() == ["like", "x"] and one(han=True) == list("我们") + ["like"] + list("苹果手机") + ["x"]
    assert one(han=True, dictionary=["苹果", "苹果手", "Like"]) == list("我们") + ["like", "苹果手", "机", "x"]
    with pytest.raises(ValueError):
        keywords.segmenter(["x" * (keywords.MOST_CHARACTERS + 1)])
