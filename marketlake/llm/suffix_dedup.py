"""Exact substring dedup: suffix arrays by a difference cover, over content-keyed parts.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else
too. A window is such a string. The window's anchor is its ``GRAM``-byte gram of
the smallest hash (the leftmost of equals), so equal windows have equal anchors
at equal places, and the windows of one anchor are a run of starts. A run's
context, the bytes its windows cover, is what has to be compared, and only with
contexts of the same anchor gram. That makes the suffix sort distributed:

1. Each text is cut into runs (anchor hash, context hash, place): no bytes move.
2. Runs are counted by anchor. An anchor met once has no repeated window; one
   with a single context, met often, has only repeated windows.
3. The distinct contexts of the other anchors fetch their bytes and go to
   partitions by anchor. Each partition sorts the suffixes of blocks of contexts
   by the difference cover modulo 3: sampled triples are sorted and named, the
   names sorted by recursion until they tell ``LENGTH`` bytes apart, the other
   suffixes merged in. Adjacent prefixes of ``LENGTH`` bytes are compared byte
   by byte (in words of eight); equal ones are repeated windows. A window whose
   hash no other window has is unlike all of them: only the rest is sorted.
4. The repeated windows of a text are joined and its bytes cut.

Copies count once: texts are first grouped by their digest, and a context of
many texts is one row from there on. An anchor whose distinct contexts exceed a
block is not gathered: its windows are counted by their hashes, and what is left
of its contexts is a string for each stretch of windows that may be repeated, equal
strings once. If these exceed a block still, their suffixes are sorted by the same
difference cover over Spark's range sorts (``suffix_sort``): no anchor has to fit a task.
Context hashes are 64 bits within one anchor gram, text digests MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import BATCH_ROWS, col, map_texts, materialise, small_batches
from .suffix_sort import repeated_windows

LENGTH = 400
GRAM = 32
#: Starts that are anchored at a time (their numbers take the low bits of a key).
PART = 1 << 19
#: Bytes of contexts that one suffix array holds.
BLOCK = 1 << 21

RUN = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("ctx", T.LongType()),
    T.StructField("lo", T.LongType()), T.StructField("n", T.IntegerType())])
RUNS = T.StructType([T.StructField("runs", T.ArrayType(RUN))])
_LOW = np.uint64((1 << 20) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _grams(buf: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place."""
    h = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)[buf]
    m = 1
    while m < GRAM:
        h = _mix(h[:-m] * np.uint64(0x9E3779B97F4A7C15) + h[m:])
        m *= 2
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each ``width`` in a row."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    up = np.minimum.accumulate(rows, axis=1).reshape(-1)
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64, and their inverses."""
    odd = 0x9E3779B97F4A7C15
    power, back = (np.full(n, x, np.uint64) for x in (odd, pow(odd, -1, 1 << 64)))
    for powers in (power, back):
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
    return power, back


def _window_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each place; equal bytes have equal ones."""
    out = np.empty(max(0, len(text) - length + 1), np.uint64)
    power, back = _powers(min(len(text), PART) + length)
    span = length - GRAM + 1
    for at in range(0, len(out), PART):
        grams = _grams(text[at : at + PART + length - 1])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * power[: len(grams)], dtype=np.uint64)])
        n = len(grams) - span + 1
        out[at : at + n] = _mix((sums[span : span + n] - sums[:n]) * back[:n])
    return out


def _window_places(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the first ``starts`` windows of each of the strings of these sizes, one behind the other."""
    begins = np.cumsum(sizes) - sizes
    return np.repeat(begins, starts) + np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)


class Cutter:
    """Runs of texts: (anchor, context hash, first start, number of starts)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.power, self.back = _powers(PART + 2 * length)

    def __call__(self, text: bytes) -> tuple[np.ndarray, ...]:
        found = [self._part(text[a : a + PART + self.length - 1], a) for a in range(0, max(0, len(text) - self.length + 1), PART)]
        if not found:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int32))
        return tuple(np.concatenate(c) for c in zip(*found))

    def _part(self, part: bytes, at: int):
        grams = _grams(np.frombuffer(part, np.uint8))
        keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        place = (_least(keys, self.length - GRAM + 1) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        n = np.diff(np.concatenate([first, [len(place)]]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(grams * self.power[: len(grams)], dtype=np.uint64)])
        end = first + n - 1 + self.length - GRAM + 1
        ctx = _mix((sums[end] - sums[first]) * self.back[first])
        return grams[place[first]].view(np.int64), ctx.view(np.int64), first + at, n.astype(np.int32)


def _runs(length: int):
    cut = Cutter(length)
    kind = pa.struct([("anchor", pa.int64()), ("ctx", pa.int64()), ("lo", pa.int64()), ("n", pa.int32())])

    def batch(texts: list[bytes | None]) -> list[pa.Array]:
        parts = [cut(t or b"") for t in texts]
        ends = np.cumsum([0, *[len(p[0]) for p in parts]])
        cols = [np.concatenate(c) if parts else [] for c in zip(*parts)]
        flat = pa.StructArray.from_arrays([pa.array(c) for c in cols], fields=list(kind))
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]

    return batch


def _names(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of numbers, from 1; by a table where that is less work than a sort."""
    most = int(keys.max(initial=0)) + 1
    if most > 8 * len(keys) + 256:
        return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1
    met = np.zeros(most, bool)
    met[keys] = True
    return np.cumsum(met)[keys]


def suffix_array(s: np.ndarray, depth: int, told: int = 1, want: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of ``s`` (numbers above 0) in order of their first ``depth`` symbols at least.

    Difference cover modulo 3. ``told`` is how many of the first symbols one name
    of this level stands for: names that stand for ``depth`` need no more sorting.
    ``want`` marks the suffixes that are asked for (none given: all); only these
    and the ones two places on, which they are compared by, take part in merges.
    """
    n = len(s)
    want = np.ones(n, bool) if want is None else want
    if n < 3:
        return np.array(sorted(np.flatnonzero(want).tolist(), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    size = int(t.max()) + 1
    width = n + 3
    pair = t[:-1] * size + t[1:]
    if size * size * max(size, width) >= 1 << 63:  # no room for a third number beside
        pair = _names(pair)
    names = _names(pair[sample] * size + t[sample + 2])
    need = np.zeros(n + 2, bool)
    for k in range(3):
        need[k : k + n] |= want
    need = need[sample]
    if names.max() == len(sample) or told * 3 >= depth:
        order = np.flatnonzero(need)
        order = order[np.argsort(names[order], kind="stable")]
    else:
        order = suffix_array(names, depth, told * 3, need)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    sorted12 = sample[order]
    sorted12 = sorted12[sorted12 < n]
    sorted12 = sorted12[want[sorted12]]
    zero = np.arange(0, n, 3)
    zero = zero[want[zero]]
    key0 = t[zero] * width + rank[zero + 1]
    o = np.argsort(key0, kind="stable")
    zero, key0 = zero[o], key0[o]
    # merge: how many suffixes of either other class come before each of class 0
    is1 = sorted12 % 3 == 1
    c1, c2 = sorted12[is1], sorted12[~is1]
    before = np.searchsorted(t[c1] * width + rank[c1 + 1], key0)
    before += np.searchsorted(pair[c2] * width + rank[c2 + 2], pair[zero] * width + rank[zero + 2])
    # suffixes equal to the full depth may compare either way; their places must still rise
    before = np.maximum.accumulate(before)
    out = np.empty(len(zero) + len(sorted12), np.int64)
    at = before + np.arange(len(zero))
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[at] = zero
    out[rest] = sorted12
    return out


def _met_again(hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes stand there twice or more."""
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeated(contexts: list[bytes], starts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its first ``starts`` windows occur elsewhere among all these windows.

    Sorted are the stretches of contexts whose windows have a hash that occurs elsewhere."""
    sizes, starts = np.array([len(c) for c in contexts]), np.array(starts)
    if length < GRAM:
        maybe = np.ones(starts.sum(), bool)
    else:
        maybe = _met_again(_window_hashes(np.frombuffer(b"".join(contexts), np.uint8), length)[_window_places(sizes, starts)])
    owner, begin = np.repeat(np.arange(len(starts)), starts), np.cumsum(starts) - starts
    beside = maybe[1:] & maybe[:-1] & (owner[1:] == owner[:-1])
    lo = np.flatnonzero(maybe & ~np.concatenate([[False], beside]))
    hi = np.flatnonzero(maybe & ~np.concatenate([beside, [False]])) + 1
    if len(lo):
        of = owner[lo]
        cuts = zip(of.tolist(), (lo - begin[of]).tolist(), (hi - begin[of] - 1 + length).tolist())
        found = _sorted_repeats([contexts[i][a:b] for i, a, b in cuts], hi - lo, length)
        maybe[maybe] = found
    return np.split(maybe, np.cumsum(starts)[:-1])


def _sorted_repeats(contexts: list[bytes], starts: np.ndarray, length: int) -> np.ndarray:
    """Which of all these windows, in order, occur elsewhere among them: by the suffix array."""
    text = np.frombuffer(b"".join(contexts) + bytes(8), np.uint8)
    n = len(text) - 8
    own = np.zeros(n, bool)
    place = _window_places(np.array([len(c) for c in contexts]), starts)
    own[place] = True
    sa = suffix_array(_names(text[:n]), length, want=own)
    a, b = sa[:-1], sa[1:]
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words |= text[k : k + n + 1].astype(np.uint64) << np.uint64(8 * k)
    alive = np.arange(len(a))
    for off in dict.fromkeys([length - 8, *range(0, length - 7, 8)]):
        alive = alive[words[a[alive] + off] == words[b[alive] + off]]
    again = np.zeros(n, bool)
    again[a[alive]] = True
    again[b[alive]] = True
    return again[place]


def _ranges(mask: np.ndarray) -> list[list[int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge.reshape(-1, 2).tolist()


SOLVED = "anchor long, ctx long, ranges array<array<int>>"


def _sorter(length: int, key: pa.DataType = pa.int64()):
    """Rows (anchor, ctx or another key, copies, n, bytes) in order of anchor and key -> ranges of repeated windows."""
    schema = pa.schema([("anchor", pa.int64()), ("ctx", key), ("ranges", pa.list_(pa.list_(pa.int32())))])

    def solve(rows) -> pa.RecordBatch:
        masks = repeated([r[4] for r in rows], [r[3] for r in rows], length)
        out = [(r[0], r[1], [[0, r[3]]] if r[2] > 1 else _ranges(m) if m.any() else []) for r, m in zip(rows, masks)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            for r in zip(*[b.column(k).to_pylist() for k in range(5)]):
                if last is not None and r[:2] == last[:2]:
                    continue  # fetched twice: a repeated row of the table
                if size >= BLOCK and r[0] != last[0]:  # only between anchors, each of a block at most
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
                last = r
        if held:
            yield solve(held)

    return run


def _hashes(length: int):
    """Rows (cid, n, b) -> (cid, k, h): the hash of each of the n windows of a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(at, BATCH_ROWS)
                starts, texts = part.column(1).to_numpy(), part.column(2).to_pylist()
                place = _window_places(np.array([len(t) for t in texts]), starts)
                h = _window_hashes(np.frombuffer(b"".join(texts), np.uint8), length)[place].view(np.int64)
                cid = np.repeat(part.column(0).to_numpy(), starts)
                k = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts)
                yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(k.astype(np.int32)), pa.array(h)], names=["cid", "k", "h"])

    return run


def _stretches(strings: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, off, n, key, b): the stretches of windows whose hash occurs at two places or more, ``key`` their digest.

    ``strings`` (cid, anchor, ctx, n, b) is a written table. No row of a hash's windows is gathered: they are counted."""
    hashes = strings.select("cid", "n", "b").mapInArrow(_hashes(length), "cid long, k int, h long")
    # written first: with plain exchanges on both sides AQE splits the windows of a hot hash
    again = materialise(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "suffix-hashes")
    # a string has few windows, those of one anchor at one place
    left = hashes.join(again, "h", "left_semi").groupBy("cid").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    first = F.expr("filter(ks, (k, i) -> i = 0 or ks[i - 1] < k - 1)")
    last = F.expr("filter(ks, (k, i) -> i = size(ks) - 1 or ks[i + 1] > k + 1)")
    runs = left.select("cid", F.explode(F.arrays_zip(first.alias("off"), last.alias("end"))).alias("r")).select("cid", "r.*")
    cut = strings.join(runs, "cid").select("anchor", "ctx", "off", (F.col("end") - F.col("off") + 1).alias("n"), F.expr(
        f"substring(b, off + 1, end - off + {length})").alias("b"))
    return materialise(cut.select("anchor", "ctx", "off", "n", F.md5("b").alias("key"), "b"), "suffix-stretches")


def _large_ranges(strings: DataFrame, length: int) -> DataFrame:
    """(anchor, ctx, ranges) of repeated windows, of anchors whose contexts exceed a block."""
    members = _stretches(strings, length)
    parts = materialise(members.groupBy("anchor", "key").agg(
        F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("b").alias("b")), "suffix-parts")
    large = materialise(parts.groupBy("anchor").agg(F.sum(F.col("n") + length).alias("bytes")).where(F.col("bytes") > BLOCK)
                        .select("anchor"), "suffix-large")
    small_batches(strings.sparkSession)
    keyed = parts.join(large, "anchor", "left_anti").select("anchor", "key", "copies", "n", "b")
    solved = keyed.repartition("anchor").sortWithinPartitions("anchor", "key").mapInArrow(
        _sorter(length, pa.string()), "anchor long, key string, ranges array<array<int>>")
    wide = materialise(parts.join(large, "anchor", "left_semi").select(F.monotonically_increasing_id().alias("cid"), "*"), "suffix-wide")
    late = repeated_windows(wide.select("cid", "n", "b"), length).join(wide.select("cid", "anchor", "key"), "cid").groupBy(
        "anchor", "key").agg(F.transform(F.collect_list("k"), lambda k: F.array(k, k + 1)).alias("ranges"))
    many = wide.where("copies > 1").select("anchor", "key", F.array(F.array(F.lit(0), F.col("n"))).alias("ranges"))
    ranges = materialise(solved.where(F.size("ranges") > 0).unionByName(late).unionByName(many), "suffix-part-ranges")
    return members.select("anchor", "ctx", "off", "key").join(ranges, ["anchor", "key"]).select(
        "anchor", "ctx", F.expr("transform(ranges, r -> array(r[0] + off, r[1] + off))").alias("ranges"))


def _cut():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                text, merged = text or b"", []
                for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                kept, at = hashlib.sha256(), 0
                for s, e in merged:
                    kept.update(text[at:s])
                    at = e
                kept.update(text[at:])
                gone = sum(e - s for s, e in merged)
                for c, v in zip(cols, (len(text), gone, len(merged), kept.hexdigest(), merged)):
                    c.append(v)
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))))]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return run


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(key, spans): byte ranges (s, e) that hold repeated windows, for each text's digest."""
    texts = docs.where(F.octet_length(col(text_col)) >= length).select(
        F.md5(col(text_col).cast("binary")).alias("key"), col(id_col).alias("id"), col(text_col).cast("binary").alias("b"))
    cut = map_texts(texts, "b", ["key", "id"], lambda: _runs(length), RUNS).select("row.*", "res.runs")
    distinct = materialise(cut.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("runs").alias("runs")), "suffix-runs")
    runs = distinct.select("key", "copies", "id", F.explode("runs").alias("r")).select("key", "copies", "id", "r.*")
    met = runs.groupBy("anchor").agg(F.sum("copies").alias("m"), F.min("ctx").alias("c1"), F.max("ctx").alias("c2"))
    # written first: with plain exchanges on both sides AQE splits the runs of a hot anchor
    met = materialise(met.where("m > 1"), "suffix-anchors")
    again = materialise(runs.join(met, "anchor").withColumn("mixed", F.expr("c1 != c2")).drop("m", "c1", "c2"),
                        "suffix-candidates")
    plain = again.where(~F.col("mixed")).select("key", F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + length).alias("e"))

    mixed = again.where("mixed")
    ctx = materialise(mixed.groupBy("anchor", "ctx").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("id", "key", "lo")).alias("ref"), F.first("n").alias("n")), "suffix-contexts")
    large = materialise(ctx.groupBy("anchor").agg(F.sum(F.col("n") + length).alias("bytes")).where(F.col("bytes") > BLOCK)
                        .select("anchor", F.lit(True).alias("large")), "suffix-large")
    small_batches(docs.sparkSession)
    wanted = ctx.join(large, "anchor", "left").select(
        "anchor", "ctx", "copies", "n", F.col("large").isNotNull().alias("large"), F.col("ref.id").alias("rid"),
        F.col("ref.key").alias("rkey"), F.col("ref.lo").alias("lo"))
    fetched = wanted.join(texts, (F.col("rkey") == F.col("key")) & F.col("rid").eqNullSafe(F.col("id")))
    bytes_ = materialise(fetched.select(
        "large", "anchor", "ctx", "copies", "n", F.expr(f"substring(b, cast(lo as int) + 1, n - 1 + {length})").alias("bytes")), "suffix-bytes")
    cols = ["anchor", "ctx", "copies", "n", "bytes"]
    keyed = bytes_.where("not large").select(*cols).repartition("anchor").sortWithinPartitions("anchor", "ctx")
    solved = materialise(keyed.mapInArrow(_sorter(length), SOLVED), "suffix-solved")

    # anchors of more than a block: what may be repeated, of which no anchor has to fit a task
    wide = bytes_.where("large").dropDuplicates(["anchor", "ctx"])
    strings = materialise(wide.select(F.monotonically_increasing_id().alias("cid"), "anchor", "ctx", "n", F.col("bytes").alias("b")), "suffix-strings")
    late = _large_ranges(strings, length)
    many = ctx.join(large, "anchor").where("copies > 1").select("anchor", "ctx", F.array(F.array(F.lit(0), F.col("n"))).alias("ranges"))
    ranges = solved.where(F.size("ranges") > 0).unionByName(late).unionByName(many)
    found = mixed.join(ranges, ["anchor", "ctx"]).select("key", "lo", F.explode("ranges").alias("r")).select(
        "key", (F.col("lo") + F.col("r")[0]).alias("s"), (F.col("lo") + F.col("r")[1] - 1 + length).alias("e"))
    return plain.union(found).groupBy("key").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def dedup(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Struct ``row`` of the kept columns; n_bytes, n_removed, n_spans, kept_sha256 and the removed byte ranges.

    A null text is empty; texts under ``length`` bytes lose nothing. Repeated rows
    are copies of each other, so all their windows are repeated. Ids may be null
    or equal; a text is told by its digest.
    """
    row = F.struct(*[col(c) for c in keep]).alias("row")
    spans = repeated_spans(docs, id_col, text_col, length)
    texts = docs.select(row, col(text_col).cast("binary").alias("b"), F.md5(F.coalesce(col(text_col), F.lit("")).cast("binary")).alias("key"))
    joined = texts.join(spans, "key", "left").select("row", "b", "spans")
    small_batches(docs.sparkSession)
    out = T.StructType([
        joined.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
        T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType())))])
    return joined.mapInArrow(_cut(), out)


def digest(found: DataFrame) -> DataFrame:
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
