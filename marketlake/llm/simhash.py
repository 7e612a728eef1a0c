"""SimHash near-duplicates with deletion-variant signatures.

Fingerprint: XXH64 (seed 42) of every 3-word shingle, repeats included; a bit
is set where over half of the hashes have it. Two fingerprints link at 3 or
fewer differing bits. Cut into two segments of 32 bits, one segment of such a
pair differs by one bit at most. So each distinct fingerprint is indexed, per
segment, by the segment itself and by its 32 variants with one bit left out.
Equality joins find the pairs: equal segments by the first key, segments that
differ in just the bit left out by the second (the side with a 0 there meets
the side with a 1, so no pair of equal segments meets 32 times). Candidates are
verified by the Hamming distance.

A bucket of many members (copies with small edits share a segment) is not
expanded into all pairs: beyond ``MAX_BUCKET`` members its rows are indexed
again by the other segment, cut in two halves of 16 bits, one of which again
differs by one bit at most.

Components: fingerprints are nodes; small-star and large-star rounds, each
written to the shared folder, until nothing changes. Only fingerprints that
have a link take part. Copies of a text share a fingerprint and never meet.
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import col, map_texts, materialise

MAX_DISTANCE = 3
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FP = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: bytes | None, n_words: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; zero for a text without words."""
    import xxhash

    w = (text or b"").translate(_LOWER).split()
    if not w:
        return 0
    if len(w) < n_words:
        shingles = iter((b" ".join(w),))
        n = 1
    else:
        shingles = map(b" ".join, zip(*(islice(w, i, None) for i in range(n_words))))
        n = len(w) - n_words + 1
    digest = partial(xxhash.xxh64_digest, seed=42)
    counts = np.zeros(64, np.int64)
    while True:  # blocks: a very long text never holds 64 bytes a shingle at once
        block = b"".join(map(digest, islice(shingles, 1 << 16)))
        if not block:
            break
        counts += np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _batch(texts: list[bytes | None]) -> list[pa.Array]:
    out = np.fromiter((fingerprint(t) for t in texts), np.uint64, len(texts))
    return [pa.array(out.view(np.int64))]


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Struct ``row`` of the kept columns and ``fp``, the fingerprint as a signed long."""
    return map_texts(docs, text_col, keep, lambda: _batch, FP).select("row", F.col("res.fp").alias("fp"))


def _cut(value: str, bits: int, place: int) -> str:
    return f"(shiftrightunsigned({value}, {place}) & {(1 << bits) - 1}L)"


def _keys(value: str, bits: int, place: int, tag: int) -> str:
    """SQL: array of (tag, position, rest, bit); position -1 is the segment itself."""
    seg = _cut(value, bits, place)
    own = f"struct({tag} as tag, -1 as pos, {seg} as rest, -1 as bit)"
    wild = (f"transform(sequence(0, {bits - 1}), i -> struct({tag} as tag, i as pos, "
            f"{seg} & ~shiftleft(1L, i) as rest, cast(shiftrightunsigned({seg}, i) & 1L as int) as bit))")
    return f"concat(array({own}), {wild})"


#: Members from which a bucket is indexed again by the other segment.
MAX_BUCKET = 64


def _pairs(idx: DataFrame, key: list[str]) -> DataFrame:
    """Candidates of equal key: those of the whole segment, and those that differ in the bit left out."""
    a, b = idx.alias("a"), idx.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]

    def on(cond):
        for s in same:
            cond = cond & s
        return cond

    distance = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_DISTANCE
    # bit -1 stands for the segment itself: ordered by fingerprint; else 0 meets 1
    whole = a.where("bit = -1").join(b.where("bit = -1"), on((F.col("a.fp") < F.col("b.fp")) & distance))
    wild = a.where("bit = 0").join(b.where("bit = 1"), on(distance))
    sel = [F.least("a.fp", "b.fp").alias("x"), F.greatest("a.fp", "b.fp").alias("y")]
    return whole.select(*sel).union(wild.select(*sel))


def links(nodes: DataFrame) -> DataFrame:
    """Pairs (x, y) of distinct fingerprints, at most 3 bits apart."""
    # each row becomes 66: spread them by a number of tasks, not by the bytes of the few columns before
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    idx = nodes.repartition(parts, "fp").select("fp", F.expr(
        f"explode(concat({_keys('fp', 32, 32, 0)}, {_keys('fp', 32, 0, 1)})) as k")).select("fp", "k.*")
    key = ["tag", "pos", "rest"]
    sizes = idx.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # merged: Spark sizes rows behind an explode as if there were one of 66, and would broadcast gigabytes
    idx = materialise(idx.hint("merge").join(sizes.hint("merge"), key), "simhash-index")
    small = _pairs(idx.where(F.col("n") <= MAX_BUCKET), key)
    big = idx.where(F.col("n") > MAX_BUCKET).select("fp", F.col("tag").alias("t1"), F.col("pos").alias("p1"),
                                                    F.col("rest").alias("r1"), F.col("bit").alias("b1"))
    # the other segment, cut in halves; the bit of the first cut stays part of the pairing
    def halves(hi, lo):
        return f"concat({_keys('fp', 16, hi, 0)}, {_keys('fp', 16, lo, 1)})"
    big = big.withColumn("k", F.expr(f"explode(if(t1 = 0, {halves(16, 0)}, {halves(48, 32)}))")).select("*", "k.*").drop("k")
    return materialise(small.union(_refined(big)).distinct(), "simhash-links")


def _refined(big: DataFrame) -> DataFrame:
    key = ["t1", "p1", "r1", "tag", "pos", "rest"]
    a, b = big.alias("a"), big.alias("b")
    cond = None
    for k in key:
        c = F.col(f"a.{k}") == F.col(f"b.{k}")
        cond = c if cond is None else cond & c
    distance = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= MAX_DISTANCE
    outer = ((F.col("a.b1") == -1) & (F.col("b.b1") == -1)) | ((F.col("a.b1") == 0) & (F.col("b.b1") == 1))
    inner = ((F.col("a.bit") == -1) & (F.col("b.bit") == -1)) | (F.col("a.bit") + F.col("b.bit") == 1)
    differ = (F.col("a.b1") != -1) | (F.col("a.fp") < F.col("b.fp"))
    pairs = a.hint("merge").join(b.hint("merge"), cond & outer & inner & differ & distance)  # exploded: sized too low
    return pairs.select(F.least("a.fp", "b.fp").alias("x"), F.greatest("a.fp", "b.fp").alias("y"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (x, y); the root is the smallest node reachable.

    Large-star and small-star in turn; the star of a node is folded by ``min``
    and a join, so no neighbour list is gathered into one row.
    """
    e = edges.select(F.col("x").alias("u"), F.col("y").alias("v"))
    last = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: every larger neighbour of u links to u's minimum
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: u and its smaller neighbours link to the smallest of them
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low2, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").union(
            low2.select(F.col("u").alias("a"), F.col("m").alias("b")))
        e = materialise(small.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "stars")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")).union(
        e.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_duplicates(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Struct ``row`` of the kept columns, ``fp``, ``component_id`` and ``root`` for every document.

    Null and empty texts, and those of white space only, have the fingerprint
    zero and link like any other. Repeated rows stay, in one component. A null
    id takes no part in the minimum; a component of null ids only has a null id.
    ``root`` is the smallest fingerprint of the component: never null, and unlike
    ``component_id`` never shared by two components that hold rows of one id.
    """
    cols = list(dict.fromkeys([*keep, id_col]))
    marked = materialise(fingerprints(docs, cols, text_col), "simhash-fp")
    nodes = materialise(marked.groupBy("fp").agg(F.min(F.col("row").getField(id_col)).alias("least")), "simhash-nodes")
    roots = components(links(nodes.select("fp")))
    member = nodes.join(roots, nodes["fp"] == roots["node"])
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "component_id", "root")
    # written first: with plain exchanges on both sides AQE splits the rows of a fingerprint of many copies
    ids = materialise(nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")), "simhash-ids")
    return marked.join(ids, "fp").select(
        F.struct(*[F.col("row").getField(c).alias(c) for c in keep]).alias("row"), "fp", "component_id", "root")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component_id").cast("long").alias("component_id"))
