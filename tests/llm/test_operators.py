"""Each operator against brute force on a fixture of nulls, blanks, long texts,
ties, repeated rows and clashing columns, and on an empty table."""

import hashlib
import re
import zlib

from pyspark.sql import functions as F

from rtdw.llm import (decontaminate, lm_scoring, minhash_dedup, mixing, personal_data, pu_quality, quality_rules,
                      secrets, sharding, substring_dedup)
from tests.llm import brute


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_near_duplicates(docs, empty, corpus):
    got = rows(minhash_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(corpus), key=repr)
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_keep_one_keeps_columns_and_one_of_each(docs, corpus):
    got = minhash_dedup.keep_one(docs)
    assert got.columns == docs.columns
    want = {i for i, _, _, kept in brute.near_duplicates(corpus) if kept and i is not None}
    ids = [r[0] for r in got.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_odd_sketch_keeps_pairs_at_the_threshold():
    import numpy as np
    rng = np.random.default_rng(5)
    lost = 0
    for _ in range(200):
        s = rng.integers(0, 1 << 63, 560, dtype=np.uint64)
        a, b = s[:490], s[70:]                     # 420 of 560 shared: 0.75
        x, y = minhash_dedup._samples(np.sort(a)), minhash_dedup._samples(np.sort(b))
        bits = []
        for m in (x, y):
            tag = minhash_dedup.mixed((np.arange(512, dtype=np.uint64) << np.uint64(32)) | m.astype(np.uint64))
            bits.append(np.bincount((tag >> np.uint64(53)).astype(int), minlength=2048) & 1)
        lost += (bits[0] ^ bits[1]).sum() > minhash_dedup.odd_limit(0.75)
    assert lost <= 1


def test_substring_dedup(docs, empty, corpus):
    got = substring_dedup.dedup(docs)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.substring_dedup(corpus), key=repr)
    for r in got.select("kept_sha256", "kept_text").collect():
        assert hashlib.sha256(r[1].encode()).hexdigest() == r[0]
    assert substring_dedup.dedup(empty).count() == 0


def test_mixing_targets_and_copies(docs, empty, corpus):
    got = mixing.taken(docs).collect()
    assert len(got) == len(corpus)
    assert sorted(r["size"] for r in got) == sorted(len(brute.words(t)) for _, t in corpus)
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] + 1e-6 for r in got)
    assert rows(mixing.taken(docs), "doc_id", "taken") == rows(mixing.taken(docs.repartition(7)), "doc_id", "taken")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["taken"] // r["size"] for r in got if r["size"])
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_targets_reshare_what_is_above_the_cap(spark):
    words = {"a": 10, "b": 1000, "c": 50, "d": 3000, None: 40}
    df = spark.createDataFrame(list(words.items()), "source string, words long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    weight, total = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}, sum(words.values())
    target = {}
    while True:
        free = [s for s in words if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * words[s]]
        if not over:
            break
        target.update({s: 3.0 * words[s] for s in over})
    target.update({s: level * weight[s] for s in free})
    assert all(abs(got[s] - target[s]) < 1e-6 for s in words)


def test_factor_meets_the_target(spark):
    sizes = [(1, 40), (3, 20), (10, 10), (100, 3), (4000, 1)]
    for target in (100.0, 2500.0, 9000.0, 3.0 * sum(s * n for s, n in sizes)):
        df = spark.createDataFrame([("s", s, n, target) for s, n in sizes], "source string, size long, docs long, target double")
        k = mixing.factors(df).first()["k"]
        got = sum(n * s * (3.0 if k is None else min(3.0, k * s ** 0.5)) for s, n in sizes)
        assert abs(got - target) < 1e-6 * target


def test_personal_data(docs, empty, corpus):
    found = personal_data.find(docs).collect()
    name = lambda x: f"{personal_data.KINDS[x['rank']]}:{x['start']}:{x['end']}"
    got = sorted((r["doc_id"], [name(x) for x in r["base"]]) for r in found if r["doc_id"] is not None)
    assert got == sorted((i, brute.base_spans(t, brute.PERSONAL)[1]) for i, t in corpus if i is not None)
    for r in found:
        assert {name(x) for x in r["base"]} <= {name(x) for x in r["spans"]}
    assert personal_data.find(empty).count() == 0


def test_cards_spelt_digit_by_digit(spark):
    number = "4111111111111111"
    texts = [f"card {sign.join(number)} thanks" for sign in (" ", "-", "")] + ["a 4 b 1 c", "card 4 1"]
    found = personal_data.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: [f"{personal_data.KINDS[x['rank']]}:{x['start']}:{x['end']}" for x in r["base"]] for r in found}
    assert got == {i: brute.base_spans(t, brute.PERSONAL)[1] for i, t in enumerate(texts)}
    assert got[0] == got[1] == ["card:5:36"]
    for kind in personal_data.KINDS:
        for t in texts + [f"card {sign.join(number)} thanks" for sign in "./"]:
            if re.search(personal_data.WIDE[kind].replace(r"|\G", ""), t):
                assert re.search(personal_data.NEEDED[kind], t), (kind, t)


def test_boosted_trees_add_variants_of_what_they_learnt(spark):
    rows_ = [(i, f"write to user{i}.x@mail{i % 9}.example.com or pay 4111 1111 1111 1111 now {i} end") for i in range(60)]
    rows_ += [(1000 + i, f"serial 1234 5678 9012 34{i:02d} of the part") for i in range(60)]
    rows_ += [(2000, "write to some.body[at]mail3.example.com or pay later"),
              (2001, "or pay 4111.1111.1111.1111 now 7 end"),
              (2002, "serial 1234.5678.9012.3412 of the part")]
    spans = {r["doc_id"]: r["spans"] for r in personal_data.find(
        spark.createDataFrame(rows_, "doc_id long, text string")).collect()}
    assert len(spans[2000]) == 1 and len(spans[2001]) == 1 and not spans[2002] and not spans[1005]


def test_personal_patterns_are_linear(spark):
    import time
    text = "a" * 300_000 + " @ " + "1" * 300_000 + " " + "1." * 8_000
    t = time.time()
    assert personal_data.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).count() == 1
    assert time.time() - t < 60


def test_secrets(docs, empty, corpus):
    base = [r.kind for r in secrets.RULES if r.base]
    got = []
    for r in secrets.scan(docs).collect():
        spans = [f"{k}:{s}:{e}" for s, e, k in zip(r["starts"], r["ends"], r["kinds"]) if k in base]
        got.append((r["doc_id"], spans))
    want = [(i, brute.base_spans(t, brute.SECRETS)[1]) for i, t in corpus]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert secrets.scan(empty).count() == 0


def test_trigram_queries_only_skip_what_cannot_match():
    q = {r.kind: secrets.trigram_query(r.regex) for r in secrets.RULES}
    assert q["hex"] is True and q["access"] == ("and", b"aki", b"kia")
    assert secrets.trigram_query(r"abc?d") is not True and secrets.trigram_query(r"(ab|x)[0-9]+") is True
    texts = ["x PASSWORD: abcdefg", "api_key=1234567", "nothing", "tok en=123456", "", "apikey='zzzzzzz'"]
    found = secrets.spans_of(texts)
    assert [bool(f) for f in found] == [True, True, False, False, False, True]


def test_decontamination(docs, empty, benchmark, corpus, items):
    found = decontaminate.contaminated(docs, benchmark)
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()}
    want = brute.decontaminate(corpus, items)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    clean = decontaminate.clean(docs, benchmark)
    bad = {i for i, _ in want}
    assert clean.columns == docs.columns and clean.count() == sum(i not in bad for i, _ in corpus)
    assert decontaminate.contaminated(empty, benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(corpus)


def test_windows_between_the_diagonals(spark):
    import random
    item = [f"item{i}" for i in range(48)]
    other = [f"again{i % 9}" for i in range(30)]

    def around(w):
        return " ".join([f"lead{i}" for i in range(60)] + w + [f"tail{i}" for i in range(60)])

    # the best window (38 of 50) starts between the diagonals of the item's two halves
    moved = ["x"] + item[1:23] + ["y", "z"] + item[23:47] + ["x"]
    texts = [around(moved), " ".join(moved), around(item[24:] + item[:24]), around(item), around(other), around(other[3:])]
    rnd = random.Random(7)
    for _ in range(60):
        w = list(rnd.choice((item, item, other)))
        for _ in range(rnd.randint(1, 3)):
            at = rnd.randrange(len(w))
            w[at:at + rnd.randint(0, 2)] = [f"new{rnd.randrange(99)}" for _ in range(rnd.randint(0, 2))]
        texts.append(rnd.choice((around, " ".join))(w))
    corpus, items = list(enumerate(texts)), [(1, " ".join(item)), (2, " ".join(other))]
    docs, bench = spark.createDataFrame(corpus, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(docs, bench).collect()}
    want = brute.decontaminate(corpus, items)
    assert abs(want[0, 1] - 38 / 50) < 1e-9 and 10 < len(want) < 60
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    left = {r[0] for r in decontaminate.clean(docs, bench).select("doc_id").collect()}
    assert left == set(range(len(corpus))) - {i for i, _ in want}


def test_items_are_told_apart(spark):
    items = [(i, " ".join(f"item{i}x{j}" for j in range(30))) for i in range(40)] + [(None, " ".join(f"none{j}" for j in range(30)))]
    corpus = [(i, f"lead words {t} tail words") for i, (_, t) in enumerate(items)]
    docs, bench = spark.createDataFrame(corpus, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, bench)
    assert rows(found, "doc_id", "item_id") == sorted(((d, i) for (d, _), (i, _) in zip(corpus, items)), key=repr)


def test_the_hamming_index_finds_every_pair_within_the_radius_once(spark):
    import random
    rnd = random.Random(11)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    prints = [rnd.getrandbits(64) for _ in range(12)]
    windows = []
    for k in range(400):
        x = prints[k % 12] if k % 3 else rnd.getrandbits(64)
        for b in rnd.sample(range(64), rnd.choice((0, 5, 15, 22, 23, 24, 30))):
            x ^= 1 << b
        windows.append(x)
    left = spark.createDataFrame([(k, 0, 10 + k % 2, k, signed(x)) for k, x in enumerate(windows)],
                                 "doc_id long, text_key long, m int, start int, print long")
    right = spark.createDataFrame([(i, 10 + i % 2, signed(x)) for i, x in enumerate(prints)], "item_id long, m int, item_print long")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate._meetings(left, right, decontaminate.RADIUS).collect())
    want = sorted((k, i) for k, x in enumerate(windows) for i, y in enumerate(prints)
                  if k % 2 == i % 2 and (x ^ y).bit_count() <= decontaminate.RADIUS)
    assert got == want and len(want) > 150


def test_pu_quality(spark, docs, empty):
    import numpy as np
    rng = np.random.default_rng(1)
    vocab = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(400)]
    texts, truth = [], []
    for i in range(600):
        good = i % 3 > 0
        w = list(rng.choice(vocab, 80))
        texts.append((i, " ".join(w) + "." if good else " ".join(x + "###" for x in w)))
        truth.append(good)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(truth[i])) for i in range(0, 600, 2)], "doc_id long, quality int")
    got = pu_quality.score(df, labels).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["predicted"] == int(truth[r["doc_id"]]) for r in held) > 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    edge = pu_quality.score(docs, labels.limit(0)).collect()
    assert len(edge) == docs.count() and {r["score"] for r in edge} == {0.5}
    assert pu_quality.score(empty, labels).count() == 0


def test_sharding(docs, empty, corpus):
    got = sharding.shard_plan(docs).collect()
    want = sorted(((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in corpus), key=repr)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=repr) == want
    for s in range(24):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 24) for r in got)
    assert sharding.shard_plan(empty).count() == 0
    assert set(docs.columns) <= set(sharding.shard_plan(docs, keep=True).columns)


def test_weights_move_rows_only_where_they_change(spark):
    ids = spark.range(6000).withColumnRenamed("id", "doc_id")
    old = sharding.Tree((((1.0, 1.0), (2.0, 1.0)), ((1.0, 3.0),)))
    new = sharding.Tree((((1.0, 1.0), (2.0, 4.0)), ((1.0, 3.0),)))     # shard 3 grows
    both = sharding.assign(sharding.assign(ids, old, into="a"), new, into="b")
    moved = {tuple(r) for r in both.where("a <> b").select("a", "b").distinct().collect()}
    # nothing moves into or inside the region whose weights stay
    assert moved and all(b not in (4, 5) for _, b in moved) and all(not {a, b} <= {0, 1} for a, b in moved)
    share = {r["a"]: r["count"] for r in both.groupBy("a").count().collect()}
    assert all(abs(share[s] / 6000 - w / 9) < 0.03 for s, w in enumerate((1, 1, 2, 1, 1, 3)))


def test_corpus_scores(docs, empty, corpus):
    out = lm_scoring.score(docs).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in out), key=repr)
    want = brute.base_scores(corpus)
    assert got == sorted((w[:5] for w in want), key=repr)
    base = {w[0]: w[5] for w in want}
    assert all(abs(r["base_score"] - base[r["doc_id"]]) < 1e-6 * abs(base[r["doc_id"]]) for r in out)
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in out)
    same = {r["score"] for r in out if r["doc_id"] == 25}
    assert len(same) == 1
    assert lm_scoring.score(empty).count() == 0


def test_rare_tokens_take_the_join(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(lm_scoring, "FREQUENT", 5)
    out = lm_scoring.score(docs)
    want = {w[0]: w for w in brute.base_scores(corpus)}
    for r in out.collect():
        w = want[r["doc_id"]]
        assert r["n_known"] == w[3] and abs(r["base_score"] - w[5]) < 1e-6 * abs(w[5])


def test_bit_model_is_a_distribution():
    import numpy as np
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, (64, 256))
    nodes = lm_scoring._nodes(counts)
    table = np.zeros((lm_scoring.SLOTS, 256), np.int8)
    table[:64] = nodes
    context = np.int64(0x61626364) << 8
    grams = context + np.arange(256)
    logs = lm_scoring.gram_log10(grams, table, lm_scoring.start_weights(), np.full(256 * 33, 0.5, np.float32))
    assert abs((10.0 ** logs).sum() - 1) < 1e-3


def test_quality_rules(docs, empty, corpus):
    out = quality_rules.judge(docs, into="verdict")
    got = rows(out, "doc_id", *(F.col("verdict")[c] for c in quality_rules.BASE))
    assert got == sorted(((i, *brute.rules(t)) for i, t in corpus), key=repr)
    failed = {r[0]: r[1] for r in out.select("doc_id", "verdict.base_failed").collect()}
    for i, t in corpus:
        n, _, _, _, rep = brute.rules(t)
        assert failed[i] == (n < 10 or 100 * rep > 20 * n)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == out.where("verdict.kept").count()
    assert quality_rules.judge(empty).count() == 0


def _words(tag, n, changed=()):
    return " ".join(f"{tag}x{i}" if i in changed else f"{tag}{i}" for i in range(n))


REPEATED = [(1, _words("a", 60)), (1, _words("b", 60)), (5, _words("a", 60, {50})), (6, _words("b", 60, {3})),
            (2, _words("c", 40)), (7, _words("c", 40)), (7, ""), (7, None), (8, ""), (None, _words("d", 30)),
            (None, _words("d", 30) + " " + _words("r", 30)), (None, _words("r", 30)), ((1 << 63) - 1, _words("e", 40)),
            (9, _words("e", 40)), (11, _words("p", 30) + " " + _words("q", 30)), (12, _words("q", 30)),
            (12, _words("s", 30)), (12, _words("p", 30))]


def test_near_duplicates_of_repeated_ids(spark):
    """Rows of one id with different texts are one document: what is near either
    is linked; the largest id is an id."""
    df = spark.createDataFrame(REPEATED, "doc_id long, text string").repartition(4)
    got = rows(minhash_dedup.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near_duplicates(REPEATED), key=repr)
    assert {(r[0], r[2]) for r in got if r[0] in (1, 5, 6, 7)} == {(1, 1), (5, 1), (6, 1), (7, 2)}


def test_substring_dedup_of_repeated_and_null_ids(spark):
    """Positions found in one row are not applied to another row of its id."""
    df = spark.createDataFrame(REPEATED, "doc_id long, text string").repartition(4)
    got = rows(substring_dedup.dedup(df), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.substring_dedup(REPEATED), key=repr)


def test_empty_and_clashing_columns_in_all(docs, empty):
    assert sharding.shard_plan(docs, keep=True).count() == docs.count()
    assert sharding.shard_plan(empty, keep=True).count() == 0


def test_secret_patterns_are_linear():
    import time
    for text in ("http://x " + "n" * 1_000_000, "eyJ" * 300_000, "a.b+c-1" * 150_000, "x://" * 200_000, "authorization:" * 80_000,
                 "-----BEGIN " * 90_000, "password " * 100_000):
        t = time.time()
        secrets.spans_of([text])
        assert time.time() - t < 2.5, text[:12]
    names = [r.kind for r in secrets.RULES]
    at = names.index("url_login")
    text = "see 1ftp://me:pw@host and x-a+b.c://u:p@h é https://a@b"
    assert [(text[s:e]) for s, k, e in secrets.spans_of([text])[0] if k == at] == ["ftp://me:pw@", "x-a+b.c://u:p@"]


def test_postings_across_blocks(monkeypatch):
    texts = [b"xxghp_", b"", b"akia", b"ab", b"pakiaghp_" * 9]
    want = {k: v.tolist() for k, v in secrets.postings(texts, [b"ghp", b"aki", b"zzz"]).items()}
    assert want == {b"ghp": [0, 4], b"aki": [2, 4], b"zzz": []}
    for block in (1, 2, 5, 7):
        monkeypatch.setattr(secrets, "BLOCK", block)
        assert {k: v.tolist() for k, v in secrets.postings(texts, [b"ghp", b"aki", b"zzz"]).items()} == want


def test_pu_fit_reaches_the_least_risk():
    """The fitted weights against a grid search of the non-negative risk (one feature of two
    bins and the constant), and its slope where the risk is not clipped."""
    import itertools

    import numpy as np
    p, u = np.array([[0]] * 9 + [[1]]), np.array([[0]] * 30 + [[1]] * 70)
    log = lambda z: np.log1p(np.exp(-z))

    def risk(w, prior):
        zp, zu = w[p].sum(1) + w[-1], w[u].sum(1) + w[-1]
        rest = log(-zu).mean() - prior * log(-zp).mean()
        return prior * log(zp).mean() + max(0.0, rest) + pu_quality.DECAY / 2 * (w[:-1] ** 2).sum()

    for prior in (0.1, 0.3):
        got = risk(pu_quality._fit(p, u, 2, prior), prior)
        grid = np.arange(-4, 4.01, 0.25)
        best = min(risk(np.array(w), prior) for w in itertools.product(grid, grid, grid))
        assert got <= best + 0.02


def test_pu_cut_is_calibrated_on_labels():
    import numpy as np
    rng = np.random.default_rng(4)
    for _ in range(50):
        z, q = np.round(rng.normal(size=30), 1), rng.integers(0, 2, 30)
        cut = pu_quality.best_cut(z, q)
        most = max(int(((z >= c) == q).sum()) for c in [*(np.unique(z)), z.max() + 1, z.min() - 1])
        assert int(((z >= cut) == q).sum()) == most


def test_drawn_hubs_join_before_pairs_are_formed(spark, monkeypatch):
    """A group around the threshold: the same classes, from fewer pairs of bucket mates."""
    import random
    draw = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = [" ".join(f"x{n}" if draw.random() < 0.025 else w for n, w in enumerate(base, 1000 * k)) for k in range(150)]
    group = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    formed, stored = [], minhash_dedup.stored

    def counted(df, name):
        out = stored(df, name)
        if name == "minhash-across":
            formed.append(out.count())
        return out

    monkeypatch.setattr(minhash_dedup, "stored", counted)
    found = lambda: sorted(tuple(r) for r in minhash_dedup.near_duplicates(group).collect())
    few = found()
    monkeypatch.setattr(minhash_dedup, "TURNS", 0)
    assert few == found() and 1.5 * formed[0] < formed[1]


def test_components_of_repeated_edges_in_two_exchanges_a_round(spark):
    import random

    from rtdw.llm import components as module
    draw = random.Random(3)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(210)]
    pairs += pairs[:60] + [(b, a) for a, b in pairs[60:90]] + [(i, i + 1) for i in range(400, 440)] + [(500, 500)]
    least = {}
    for _ in range(310):
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least.get(a, a), least.get(b, b))
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    assert dict(map(tuple, module.components(edges, "a", "b").collect())) == least
    assert module.components(edges.where("a = b"), "a", "b").count() == 0
    plan = module._small_star(module._large_star(edges.toDF("u", "v")))._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("Window [") == 2
