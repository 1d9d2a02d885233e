"""Sharding by a hierarchical weighted hash tree (native).

Shards hang under racks, racks under regions. A row descends level by level:
at each node every child draws an exponential clock ``-ln(u) / weight`` with
``u`` hashed from the row's key and the child's name, and the smallest clock
wins. A child whose weight rises only wins rows it had lost, so a change
of weight moves rows only into or out of the subtrees whose weight changed;
draws below an untouched node stay as they are.

``grown`` adds a shard as a region of its own (one rack, one shard): all older
draws are the same, so every row that moves goes to the new shard.

The shard is a projection. The gapless slot inside a shard needs an order: rows
are ranked inside (shard, bucket) groups, buckets being a hash of the key, and
each group starts after the sizes of the groups before it. The group sizes are a
table of at most shards x buckets rows, so no shard is ever sorted in one task.

Defined results: a null text has 8 bytes and CRC 0; a null key hashes as the
empty text; repeated rows (and equal keys) share a shard and take slots of their
own, in (key, CRC, size) order; an empty table gives an empty table; the output
columns are put together from chosen inputs, so clashing extra columns are harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import columns_of, fresh, unit_draw

BUCKETS = 256


@dataclass(frozen=True)
class Tree:
    """Weights by region, rack and shard: ``weights[region][rack][shard]``.

    Shards are numbered in this order, from 0; a node's name is its path, so
    that a node keeps its draws when others come or go after it.
    """

    weights: tuple[tuple[tuple[float, ...], ...], ...]

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.weights for rack in region)

    def grown(self, weight: float = 1.0) -> "Tree":
        return Tree((*self.weights, ((weight,),)))


# 24 equal shards: 2 regions of 3 racks of 4 shards.
TREE = Tree((((1.0,) * 4,) * 3,) * 2)


def _draw(key: Column, names: list[str], weights: list[float]) -> Column:
    """Index of the child with the smallest clock (the first of equal ones)."""
    if len(names) == 1:
        return F.lit(0)
    clocks = [-F.log(unit_draw(key, F.lit(n))) / F.lit(float(w)) for n, w in zip(names, weights)]
    return F.array_min(F.array(*(F.struct(c.alias("c"), F.lit(i).alias("i")) for i, c in enumerate(clocks))))["i"]


def _among(index: Column, choices: list[Column]) -> Column:
    out = choices[-1]
    for i in range(len(choices) - 2, -1, -1):
        out = F.when(index == i, choices[i]).otherwise(out)
    return out


def assign(docs: DataFrame, tree: Tree = TREE, key: str = "doc_id", into: str = "shard") -> DataFrame:
    """Add ``into``: the shard a row's key descends to. Three small projections."""
    k = docs[key]
    region, rack = fresh(docs, "_region"), fresh(docs, "_rack")
    w = tree.weights
    region_names = [f"r{i}" for i in range(len(w))]
    out = docs.withColumn(region, _draw(k, region_names, [sum(map(sum, x)) for x in w]))
    out = out.withColumn(rack, _among(F.col(region), [
        _draw(k, [f"r{i}.k{j}" for j in range(len(x))], [sum(y) for y in x]) for i, x in enumerate(w)]))
    first = 0
    by_region = []
    for i, x in enumerate(w):
        by_rack = []
        for j, y in enumerate(x):
            by_rack.append(F.lit(first) + _draw(k, [f"r{i}.k{j}.s{m}" for m in range(len(y))], list(y)))
            first += len(y)
        by_region.append(_among(F.col(rack), by_rack))
    return out.withColumn(into, _among(F.col(region), by_region).cast("int")).drop(region, rack)


def with_slots(rows: DataFrame, shard: str, order: list[str], into: str = "slot",
               buckets: int = BUCKETS) -> DataFrame:
    """Add ``into``: 0, 1, 2, ... inside each shard, by bucket and then ``order``."""
    bucket, many, s, b, start = (fresh(rows, x) for x in ("_bucket", "_many", "_s", "_b", "_start"))
    rows = rows.withColumn(bucket, F.floor(unit_draw(F.col(order[0]), F.lit("slot")) * buckets).cast("int"))
    sizes = rows.groupBy(shard, bucket).agg(F.count(F.lit(1)).alias(many))
    before = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(shard).alias(s), F.col(bucket).alias(b),
                          F.coalesce(F.sum(many).over(before), F.lit(0)).alias(start))
    inside = Window.partitionBy(shard, bucket).orderBy(*order)
    ranked = rows.withColumn(into, F.row_number().over(inside))
    # at most shards x buckets rows: a bounded side
    joined = ranked.join(F.broadcast(starts), (F.col(shard) == F.col(s)) & (F.col(bucket) == F.col(b)), "left")
    return joined.withColumn(into, (F.col(start) + F.col(into) - 1).cast("long")).drop(s, b, start, bucket)


def shard_plan(docs: DataFrame, tree: Tree = TREE, key: str = "doc_id", text: str = "text",
               keep: bool = False) -> DataFrame:
    """Size, CRC, shard, slot and the shard after one more joins, per row.
    With ``keep`` the input's other columns follow (they lose a name clash)."""
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    extra = [c for c, n in zip(columns_of(docs), docs.columns)
             if keep and n.lower() not in {key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"}]
    rows = docs.select(docs[key], (F.octet_length(t) + 8).cast("long").alias("size"),
                       F.crc32(t.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), *extra)
    rows = assign(assign(rows, tree, key, "shard"), tree.grown(), key, "grown_shard")
    rows = with_slots(rows, "shard", [key, "text_crc32", "size"])
    first = [key, "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return rows.select(*first, *(c for c, n in zip(columns_of(rows), rows.columns) if n not in first))
