"""MinHash near-dedup with odd sketches.

Signature: a text's set of 5-word shingles (64-bit hashes) gives ``SAMPLES``
MinHash samples. The first 128 are cut into ``BANDS`` bands for candidates, and all are
folded into an odd sketch: every (sample number, sample) toggles one of ``ODD_BITS`` bits. The
XOR of two sketches keeps only the samples in which they differ, so its population
count estimates the similarity, precisely where that is high. Candidates
whose estimate stays below the threshold by more than 3.5 deviations are dropped,
the others are confirmed on full shingle sets.

Texts of equal sets are one class from the start, known by a number of its own, so
copies cost nothing further. Rows of one doc_id whose sets differ link their classes.
Links between classes:

1. every class meets, in its bands, the least class of the bucket (the hub); the
   hub with the nearest sketch is confirmed. That is one pair per class,
   however large the bucket, and joins almost all members of a group.
2. ``TURNS`` times, the classes of buckets that still hold several components meet a class drawn anew for
   each bucket, if it is of another component; again the nearest is confirmed. This joins most
   of what the least classes left apart, before pairs are formed.
3. Classes that still stand in different components meet all bucket mates of other
   components. Pairs inside a component are never formed: they cannot change it.

So no link between components is lost that shares a band (at similarity 0.75 a
pair misses all 32 bands with probability 5e-6).

Sets are built only for classes that stand in a candidate pair; which ones is told
to the scan by a bit array sized by their number (32 MB at most). Nothing per document reaches the driver.

Defined results: a null or blank text has an empty set, is linked with nothing and
is its own component; fewer than five words are one shingle; rows that share a
doc_id are one document, whatever their texts (what is near any of them is linked with
it; each row gets its component); rows without an id stand
for themselves (component null, kept); an empty table gives an empty table;
clashing extra columns are harmless (only the id and the text are read).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm import sketch
from rtdw.llm.common import columns_of, fresh, pieces, stored, text_of
from rtdw.llm.components import components
from rtdw.llm.wordhash import SEEDS, U, Words, mixed

SHINGLE = 5
SAMPLES = 512
BANDS, BAND_ROWS = 32, 4          # of the first 128 samples
ODD_BITS = 2048
TURNS = 2                         # hubs drawn anew after the first

_A = (mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * U(SEEDS[0])) >> U(32)).astype(np.uint32) | np.uint32(1)
_B = (mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * U(SEEDS[1])) >> U(32)).astype(np.uint32)


def odd_limit(similarity: float = 0.75, deviations: float = 3.5) -> int:
    """Largest XOR population count still taken for a link. At similarity s the
    samples differ in K(1-s) places, each toggling two bits; the bound adds the
    deviations of the sampling and of the folding."""
    differ, spread = 2 * SAMPLES * (1 - similarity), 2 * (SAMPLES * similarity * (1 - similarity)) ** 0.5
    shrink = (1 - 2 / ODD_BITS) ** differ
    mean = ODD_BITS / 2 * (1 - shrink)
    folding = ODD_BITS / 4 * (1 - shrink ** 2) - differ * shrink ** 2
    return int(np.ceil(mean + deviations * ((spread * shrink) ** 2 + folding) ** 0.5))


def _texts(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "replace") if t else b"" for t in column.to_pylist()]


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = Words(texts, lower=True)
    h = w.hashes(SEEDS[0])
    runs = w.runs(h, SHINGLE, SEEDS[0])
    short = w.whole(h, SEEDS[0])
    out = []
    for d, n in enumerate(w.counts):
        a = w.first[d]
        if n >= SHINGLE:
            out.append(np.unique(runs[a:a + n - SHINGLE + 1]))
        else:
            out.append(short[d:d + 1] if n else np.empty(0, np.uint64))
    return out


def _samples(s: np.ndarray) -> np.ndarray:
    low = (s >> U(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        np.minimum(out, (low[i:i + 1024, None] * _A + _B).min(axis=0), out=out)
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k),
                                    pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shift = U(64 - (ODD_BITS - 1).bit_length())
    for b in pieces(batches, 1):
        sets = _sets(_texts(b.column(1)))
        n = len(sets)
        m = np.array([_samples(s) for s in sets], np.uint32).reshape(n, SAMPLES)
        tagged = mixed((np.arange(SAMPLES, dtype=np.uint64) << U(32)) | m.astype(np.uint64))
        place = (tagged >> shift).astype(np.int64) + np.arange(n)[:, None] * ODD_BITS
        parity = np.bincount(place.reshape(-1), minlength=n * ODD_BITS).astype(np.uint8).reshape(n, ODD_BITS)
        odd = np.packbits(parity & 1, axis=1).view(np.uint64).reshape(n, ODD_BITS // 64)
        bands = tagged[:, :BANDS * BAND_ROWS].reshape(n, BANDS, BAND_ROWS)
        key = bands[:, :, 0]
        for r in range(1, BAND_ROWS):
            key = mixed(key * U(SEEDS[0]) + bands[:, :, r])
        yield pa.RecordBatch.from_arrays([
            b.column(0), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
            pa.array(np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
            pa.array(np.array([mixed(s ^ U(SEEDS[1])).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
            _lists(key), _lists(odd)], ["id", "digest", "n_shingles", "k1", "k2", "bands", "odd"])


def _row_keys(ids: pa.Array, digests: pa.Array) -> np.ndarray:
    read = lambda x: x.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return mixed(mixed(read(ids)) ^ read(digests))


def _wanted_keys(b: pa.RecordBatch) -> np.ndarray:
    return _row_keys(b.column(0), b.column(1))


def _set_rows(wanted, bits: int):
    """(id, digest, set) for rows that may stand for a class of a candidate pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            some = b.filter(pa.array(sketch.test(wanted.value, _row_keys(b.column(0), b.column(2)), bits=bits)))
            sets = _sets(_texts(some.column(1)))
            yield pa.RecordBatch.from_arrays([
                some.column(0), some.column(2), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["id", "digest", "shingles"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _difference(p: str, q: str) -> Column:
    total = F.lit(0)
    for i in range(ODD_BITS // 64):
        total = total + F.bit_count(F.col(p)[i].bitwiseXOR(F.col(q)[i]))
    return total


def _sizes_fit(p: str, q: str, percent: int) -> Column:
    """Sets of very different sizes cannot reach the similarity."""
    return 100 * F.least(p, q) >= percent * F.greatest(p, q)


def _first_common(p: str, q: str) -> Column:
    """The first band in which two classes agree (in 31 bits of the keys; a
    chance agreement there is as likely as 2**-31): a pair is formed in that one."""
    out = F.lit(BANDS)
    for i in range(BANDS - 1, -1, -1):
        out = F.when(F.col(p)[i] == F.col(q)[i], F.lit(i)).otherwise(out)
    return out


def confirmed(slim: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets reach ``percent``."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    rows = stored(classes.select("rep", "row.id", "row.digest").join(ids, "rep", "left_semi"), "minhash-wanted")
    bits = sketch.bits_for(rows.count())
    wanted = slim.sparkSession.sparkContext.broadcast(
        sketch.bit_array(sketch.build(rows.select("id", "digest"), _wanted_keys, bits=bits), 1, bits=bits))
    sets = stored(slim.where("id IS NOT NULL").mapInArrow(_set_rows(wanted, bits), "id long, digest long, shingles binary")
                  .join(rows, ["id", "digest"]).dropDuplicates(["id", "digest"]).select("rep", "shingles"), "minhash-sets")
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
    return stored(joined.mapInArrow(_confirm(percent), "a long, b long"), "minhash-links")


def _same_document(members: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one doc_id; ``members``: (id, rep)."""
    ends = members.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    return members.join(ends.select("id", "a"), "id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def _shared(keys: DataFrame) -> DataFrame:
    """The classes of every bucket that holds several, with the bucket's least class (hub)."""
    ordered = Window.partitionBy("key").orderBy("rep")
    return keys.select("band", "key", "rep", F.first("rep").over(ordered).alias("hub"), F.lead("rep").over(ordered).alias("next")).where(
        "rep <> hub OR next IS NOT NULL").drop("next")


def _open(shared: DataFrame, label: DataFrame, turn: int | None = None) -> DataFrame:
    """The classes in the buckets that hold several components, with their components;
    with ``turn`` also the class drawn as the bucket's hub in that turn."""
    bucket = Window.partitionBy("key")
    marked = shared.join(label, F.col("rep") == F.col("node"), "left").select(
        "band", "key", "rep", F.coalesce("component", "rep").alias("component"))
    drawn = [] if turn is None else [
        F.min(F.struct(F.xxhash64("rep", "key", F.lit(turn)).alias("h"), "rep", "component")).over(bucket).alias("hub")]
    return marked.select("*", F.min("component").over(bucket).alias("lo"), F.max("component").over(bucket).alias("hi"), *drawn).where(
        "lo <> hi").drop("lo", "hi")


def _nearest(met: DataFrame, odd: DataFrame, percent: int) -> DataFrame:
    """(rep, hub): of the hubs that a class met, the one of the nearest sketch, if near enough."""
    hubs = odd.select(F.col("rep").alias("hub"), F.col("odd").alias("hub_odd"), F.col("size").alias("hub_size"))
    near = (met.repartition("rep").distinct().join(odd.drop("low"), "rep").join(hubs, "hub")
            .where(_sizes_fit("size", "hub_size", percent))
            .withColumn("differ", _difference("odd", "hub_odd")).where(F.col("differ") <= odd_limit(percent / 100)))
    return near.groupBy("rep").agg(F.min(F.struct("differ", "hub")).alias("m")).select("rep", F.col("m.hub").alias("hub"))


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components when ``links`` come to those of ``label``: the old ones enter as stars."""
    stars = label.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stars.unionByName(links.select("a", "b")), "a", "b")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    text = docs["text"].cast("string")
    slim = docs.select(docs["doc_id"].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    signed = stored(slim.mapInArrow(
        _signatures, "id long, digest long, n_shingles long, k1 long, k2 long, bands array<long>, odd array<long>"),
        "minhash-signed")
    full = signed.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    # numbered as they are written; the row of least id stands for the class
    classes = stored(full.groupBy("n_shingles", "k1", "k2").agg(
        F.min(F.struct("id", "digest")).alias("row"), F.first("bands").alias("bands"), F.first("odd").alias("odd"))
        .withColumn("rep", F.monotonically_increasing_id()), "minhash-classes")

    limit = odd_limit(percent / 100)
    keys = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = stored(_shared(keys), "minhash-shared")
    low = F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"))
    odd = classes.select("rep", "odd", F.col("n_shingles").alias("size"), low.alias("low"))
    first = stored(_nearest(shared.where("rep <> hub").select("rep", "hub"), odd, percent).select(
        F.col("hub").alias("a"), F.col("rep").alias("b")), "minhash-hubs")
    number = ["n_shingles", "k1", "k2"]
    several = full.groupBy("id").agg(F.min(F.struct(*number)).alias("x"), F.max(F.struct(*number)).alias("y")).where("x <> y")
    members = full.select("id", *number).join(several.select("id"), "id", "left_semi").join(
        classes.select("rep", *number), number).select("id", "rep")
    label = components(confirmed(slim, classes, first, percent).unionByName(_same_document(members)), "a", "b")

    # what the least classes leave apart: hubs drawn anew, then all bucket mates of different components
    tried = first
    for turn in range(TURNS):
        met = _open(shared, label, turn).where(F.col("component") != F.col("hub.component")).select("rep", F.col("hub.rep").alias("hub"))
        pairs = stored(_nearest(met, odd, percent).select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct(),
                       "minhash-drawn")
        label = _joined(label, confirmed(slim, classes, pairs, percent))
        tried = tried.unionByName(pairs)
    open_ = stored(_open(shared, label).join(odd, "rep"), "minhash-open")
    x = open_.select("band", "key", F.col("rep").alias("a"), F.col("low").alias("la"), F.col("component").alias("ca"), F.col("odd").alias("oa"),
                     F.col("size").alias("na"))
    y = open_.select("key", F.col("rep").alias("b"), F.col("low").alias("lb"), F.col("component").alias("cb"), F.col("odd").alias("ob"),
                     F.col("size").alias("nb"))
    across = x.join(y, "key").where(
        (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _sizes_fit("na", "nb", percent)
        & (_first_common("la", "lb") == F.col("band")) & (_difference("oa", "ob") <= limit))
    second = stored(across.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "minhash-across")
    more = confirmed(slim, classes, second, percent)

    label = _joined(label, more)
    by_class = stored(classes.select("rep", "row.id", *number).join(label, F.col("rep") == F.col("node"), "left").select(
        *number, "id", F.coalesce("component", "rep").alias("component")), "minhash-components")
    # a component is named by its least doc_id
    names = by_class.groupBy("component").agg(F.min("id").alias("least"))
    by_class = by_class.join(names, "component").select(*number, "least")
    rows = signed.select("id", *number)
    found = rows.where((F.col("n_shingles") > 0) & F.col("id").isNotNull()).join(by_class, number).select(
        "id", "n_shingles", "least")
    # a row without words goes with its document's other rows
    blank = rows.where((F.col("n_shingles") == 0) & F.col("id").isNotNull()).select("id", "n_shingles")
    others = found.join(blank.select("id").distinct(), "id", "left_semi").groupBy("id").agg(F.min("least").alias("least"))
    alone = rows.where(F.col("id").isNull()).select("id", "n_shingles", F.lit(None).cast("long").alias("least"))
    component = F.coalesce("least", "id")
    return found.unionByName(blank.join(others, "id", "left")).unionByName(alone).select(
        F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"),
        (F.col("id").isNull() | (component == F.col("id"))).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The pipeline stage: one document of each group stays, with the input's
    columns; of rows that repeat both id and text, one. Rows without an id stay."""
    key, number = fresh(docs, "_text_key"), fresh(docs, "_number")
    dropped = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias(f"{key}_dropped")).distinct().hint("merge")
    left = docs.join(dropped, docs["doc_id"] == F.col(f"{key}_dropped"), "left_anti")
    # partitioned like the join: no further exchange of the texts
    left = left.withColumn(key, F.xxhash64(text_of(left)))
    left = left.withColumn(number, F.row_number().over(Window.partitionBy("doc_id", key).orderBy(F.lit(1))))
    return left.where(F.col("doc_id").isNull() | (F.col(number) == 1)).drop(key, number).select(*columns_of(docs))
