"""Keyed tables in buckets: replays, untouched buckets, expiry."""

from rtdw.sinks.keyed import KeyedTable, list_names, newest, replaced

SCHEMA = "id string, seq bigint, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_batches_replays_and_versions(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), ["id"], SCHEMA, buckets=4)
    make = lambda x: spark.createDataFrame(x, SCHEMA)
    assert rows(t.read()) == [] and t.versions() == []
    one = make([(f"k{i}", 1, "a") for i in range(40)])
    two = make([("k3", 2, "b"), ("k3", 1, "stale"), ("new", 1, "c")])
    t.commit(0, one, newest(["id"], "seq"))
    before = t._manifest(1)
    changed = t.commit(1, two, newest(["id"], "seq"))
    want = sorted([(f"k{i}", 1, "a") for i in range(40) if i != 3] + [("k3", 2, "b"), ("new", 1, "c")])
    assert rows(t.read()) == want
    # only the touched buckets have files of the second version
    assert 0 < len(changed) < 4
    assert {b: v for b, v in t._manifest(2).items() if b not in changed} == {b: v for b, v in before.items() if b not in changed}
    assert {int(n.split("=")[1]) for n in list_names(spark, f"{tmp_path}/data/version=2") if "=" in n} == set(changed)
    t.commit(1, two, newest(["id"], "seq"))          # the batch runs again
    assert rows(t.read()) == want and rows(t.read(1)) == rows(one)
    t.commit(2, make([("k3", 1, "older")]), newest(["id"], "seq"))
    assert rows(t.read()) == want
    t.commit(3, make([]), newest(["id"], "seq"))     # an empty batch
    assert rows(t.read()) == want


def test_emptied_buckets_and_expiry(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path), ["id"], SCHEMA, buckets=2, keep=2)
    make = lambda x: spark.createDataFrame(x, SCHEMA)
    gone = lambda stored, changes: stored.join(changes.select("id"), "id", "left_anti")
    t.commit(0, make([("a", 1, "x"), (None, 1, "y")]), newest(["id"], "seq"))
    t.commit(1, make([(None, 2, "z")]), replaced(["id"]))
    assert rows(t.read().fillna("")) == [("", 2, "z"), ("a", 1, "x")]
    t.commit(2, make([("a", 0, "")]), gone)
    assert [r["v"] for r in t.read().collect()] == ["z"]
    for n in range(3, 7):
        t.commit(n, make([(f"b{n}", n, "w")]), newest(["id"], "seq"))
    assert t.versions() == [6, 7]
    assert len(rows(t.read().where("id IS NOT NULL"))) == 4 and len(rows(t.read(6).where("id IS NOT NULL"))) == 3
    used = {v for k in t.versions() for v in t._manifest(k).values()}
    assert {int(n.split("=")[1]) for n in list_names(spark, f"{tmp_path}/data")} == used


def test_buckets_are_merged_share_by_share(spark, tmp_path):
    """Each share sees its own buckets only; the outcome, also of a batch that runs again, is that of one pass."""
    make = lambda x: spark.createDataFrame(x, SCHEMA)
    one, two = KeyedTable(spark, f"{tmp_path}/1", ["id"], SCHEMA, 8), KeyedTable(spark, f"{tmp_path}/2", ["id"], SCHEMA, 8)
    shares = []

    def merge(stored, changes):
        shares.append({r[0] for df in (stored, changes) for r in df.select(two.bucket()).collect()})
        return replaced(["id"], changes.select("id"))(stored, changes)

    first = make([(f"k{k}", 1, "a") for k in range(40)] + [(None, 1, "a")])
    second = make([(f"k{k}", 2, "b") for k in range(0, 60, 2)] + [(None, 2, "b")])
    for n, changes in ((0, first), (1, second), (1, second)):
        a = one.commit(n, changes, replaced(["id"]))
        shares.clear()
        assert two.commit(n, changes, merge, passes=3) == a
        assert len(shares) == 3 and sum(map(len, shares)) == len(set.union(*shares)) == len(a)
        assert rows(one.read().fillna("")) == rows(two.read().fillna(""))
