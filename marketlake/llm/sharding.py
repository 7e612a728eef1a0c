"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight``, with ``u`` from a hash of the key and the child's place in
the tree, and the smallest draw wins: a child is chosen in proportion to its
weight, and raising one child's weight moves rows only into that child's
subtree, lowering it only out of it. A node's weight is the sum of its leaves.

Growth adds a region with one rack and one shard: no existing subtree changes
its weight, so at the top level rows move only into the new region, which is
the new shard alone. That is the ``key`` law: the key and the shard count decide,
and one more shard takes rows only into itself.

All expressions are Spark's own. Slots are numbered without moving a shard into
one task: rows are numbered inside (input partition, shard), and the counts of
earlier partitions, forty rows a partition, give the offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, materialise

#: tree: region -> rack -> shard -> weight
Tree = dict[int, dict[int, dict[int, float]]]


#: Shards that a tree is founded with; more come by ``grow``.
FOUNDED = 40


def grid(n_shards: int, racks: int = 4, per_rack: int = 5, founded: int = FOUNDED) -> Tree:
    """``n_shards`` of weight 1: full regions up to ``founded`` shards, the rest by ``grow``.

    From ``founded`` shards on, the tree of one more is ``grow`` of this one, whatever the count.
    """
    size = racks * per_rack
    tree: Tree = {}
    for r in range(min(n_shards, founded) // size):
        tree[r] = {k: {r * size + k * per_rack + s: 1.0 for s in range(per_rack)} for k in range(racks)}
    for _ in range(n_shards - len(tree) * size):
        tree = grow(tree)
    return tree


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """``tree`` and one more shard, alone in a region of its own; the rest keeps its places and weights."""
    shard = sum(len(shards) for racks in tree.values() for shards in racks.values())
    return {**tree, max(tree, default=-1) + 1: {0: {shard: weight}}}


def _draw(key: Column, level: str, place: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(place), key), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(weight)


def _winner(key: Column, level: str, weights: dict[int, float]) -> Column:
    """The child with the smallest draw (ties: the smaller number)."""
    alive = {c: w for c, w in weights.items() if w > 0}
    draws = [F.struct(_draw(key, f"{level}/{c}", c, w).alias("d"), F.lit(c).alias("c")) for c, w in sorted(alive.items())]
    if len(draws) == 1:
        return F.lit(next(iter(alive)))
    return F.array_min(F.array(*draws)).getField("c")


def _sum(node) -> float:
    return float(node) if not isinstance(node, dict) else sum(_sum(x) for x in node.values())


def place(df: DataFrame, key: Column, tree: Tree, out: str) -> DataFrame:
    """Adds column ``out``: the shard reached by descending ``tree`` with ``key``."""
    def choose(cases: list[tuple[Column, Column]]) -> Column:
        if len(cases) == 1:
            return cases[0][1]
        c = F.when(*cases[0])
        for cond, value in cases[1:]:
            c = c.when(cond, value)
        return c

    live = {r: racks for r, racks in tree.items() if _sum(racks) > 0}
    a, b = f"__{out}_region", f"__{out}_rack"
    df = df.withColumn(a, _winner(key, "region", {r: _sum(x) for r, x in live.items()}))
    df = df.withColumn(b, choose([(col(a) == r, _winner(key, f"rack/{r}", {k: _sum(x) for k, x in racks.items()}))
                                  for r, racks in live.items()]))
    df = df.withColumn(out, choose([((col(a) == r) & (col(b) == k), _winner(key, f"shard/{r}/{k}", shards))
                                    for r, racks in live.items() for k, shards in racks.items() if _sum(shards) > 0]))
    return df.drop(a, b)


def shard_rows(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", n_shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    A null text is empty (size 16, checksum 0). A null key draws as one key of
    its own. Repeated rows share a shard, with a slot each. An empty table gives
    none. Other columns are not read.
    """
    raw = F.coalesce(col(text_col).cast("binary"), F.lit(b""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        col(key_col).alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"))
    rows = place(rows, key, grid(n_shards), "shard")
    rows = place(rows, key, grow(grid(n_shards)), "grown_shard")
    rows = materialise(rows.withColumn("n", F.monotonically_increasing_id()), "shard-rows")
    rows = rows.withColumn("part", F.shiftright("n", 33))
    # counts of the earlier partitions: one row for each shard and partition
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy("n")
    numbered = rows.withColumn("i", F.row_number().over(inside))
    return numbered.join(offsets, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("i") - 1).cast("long").alias("slot"), "grown_shard")
