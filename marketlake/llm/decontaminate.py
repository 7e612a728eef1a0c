"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

Normal form: A-Z lower-cased, words are runs of digits, letters a-z and bytes
of non-ASCII characters, joined by one space. It is made on UTF-8 bytes with
one translation table. A pattern is a window of ``n_words`` words of an item
with a space on both sides, so a match begins and ends at word boundaries. An
item of fewer words is one window; an item of none has no window.

Each text is scanned once. A match is a byte range of the normal form; the
number of spaces before it is the index of its first word, and the word's
place in the original text comes from the same word pattern there.

Scale: the pass over documents is narrow. The automaton goes to the tasks in
shards of at most ``max_shard_bytes`` of window text (about eleven times the
items' own), so what is collected, broadcast and built has a fixed bound; more
test items mean more shards. One shard at a time is collected and sent, its hits
are written, and it is dropped before the next; the hits are merged by row.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import col, map_texts, materialise

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

#: Window text of a shard. Its automaton takes some dozens of bytes a byte in each Python worker.
MAX_SHARD_BYTES = 8 << 20

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("word_runs", T.ArrayType(T.ArrayType(T.LongType()))),
])


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def item_windows(items: list[tuple[str | None, bytes | None]], n_words: int) -> dict[str, list[str]]:
    """Pattern (bytes as Latin-1 characters, a space on both sides) -> items that have it; a null id gives no name."""
    found: dict[str, set[str]] = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - n_words + 1) if w else 0):
            names = found[(b" " + b" ".join(w[i : i + n_words]) + b" ").decode("latin-1")]
            if item is not None:
                names.add(item)
    return {k: sorted(v) for k, v in found.items()}


def _merged(runs: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scanner(patterns: dict[str, list[str]]):
    """A function from a batch of texts to the columns of ``HITS``."""
    auto = ahocorasick.Automaton()
    for p, items in patterns.items():
        auto.add_word(p, (len(p), items))
    if patterns:
        auto.make_automaton()

    def scan(texts: list[bytes | None]) -> list[pa.Array]:
        cols: list[list] = [[], [], [], [], []]
        for text in texts:
            w = words_of(text)
            runs, items, spans = [], set(), []
            if w and patterns:
                norm = (b" " + b" ".join(w) + b" ").decode("latin-1")
                seen, at = 0, 0  # spaces before position `at`
                for end, (size, names) in auto.iter(norm):
                    begin = end + 1 - size
                    if begin >= at:
                        seen, at = seen + norm.count(" ", at, begin), begin
                        first = seen
                    else:  # a longer pattern with the same end began earlier
                        first = seen - norm.count(" ", begin, at)
                    runs.append((first, first + norm.count(" ", begin, end)))
                    items.update(names)
                runs = _merged(runs)
                if runs:
                    places = [m.span() for m in _WORD.finditer(text.decode())]
                    spans = [[places[a][0], places[b - 1][1]] for a, b in runs]
            for c, v in zip(cols, (len(w), sum(b - a for a, b in runs), sorted(items), spans, runs)):
                c.append(v)
        return [pa.array(c, t) for c, t in zip(
            cols, (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.list_(pa.int64())), pa.list_(pa.list_(pa.int64()))))]

    return scan


def _shards(benchmark: DataFrame, item_col: str, text_col: str, n_words: int, max_bytes: int) -> list[DataFrame]:
    """Items (i, b) in shards of at most ``max_bytes`` of window text.

    An item of over half of that is not cut: its shard is at most half of it more
    than the item. Only the numbers of the shards reach the driver.
    """
    # every word begins one window at most, and a byte with its space is in n_words windows and one space before each
    window_bytes = ((F.octet_length("b") + 1) * F.lit(n_words + 1)).cast("long")
    items = benchmark.where(col(text_col).isNotNull()).select(
        col(item_col).cast("string").alias("i"), col(text_col).cast("binary").alias("b")).dropDuplicates()
    total = items.agg(F.sum(window_bytes)).first()[0] or 0
    if total <= max_bytes:
        return [items]
    half = max(1, max_bytes // 2)
    # a hash deals the items, the running sum inside a part cuts it where the hash dealt unevenly
    part = F.pmod(F.xxhash64("i", "b"), F.lit(-(-total // half)))
    before = Window.partitionBy("part").orderBy("i", "b").rowsBetween(Window.unboundedPreceding, 0)
    items = items.withColumn("part", part).withColumn("size", window_bytes)
    items = materialise(items.withColumn("cut", F.floor((F.sum("size").over(before) - 1) / F.lit(half))), "decontaminate-items")
    numbers = items.select("part", "cut").distinct().orderBy("part", "cut").collect()
    return [items.where((F.col("part") == r.part) & (F.col("cut") == r.cut)).select("i", "b") for r in numbers]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n_words: int = 10,
    max_shard_bytes: int = MAX_SHARD_BYTES,
) -> DataFrame:
    """Struct ``row`` of the kept columns and struct ``res`` (``HITS``) for every document.

    ``spans`` are code-point ranges of the original text, ``word_runs`` ranges
    of word indexes; both are merged. Null and empty texts have no words and no
    hits; repeated rows come out repeated; an empty benchmark hits nothing;
    items with a null text take no part, repeated items count once. The windows of
    an item with a null id count as hits, but it has no name in ``items``.
    """
    def send(shard: DataFrame):
        return docs.sparkSession.sparkContext.broadcast(item_windows([(r.i, bytes(r.b)) for r in shard.collect()], n_words))

    shards = _shards(benchmark, item_col, item_text_col, n_words, max_shard_bytes)
    if len(shards) == 1:
        sent = send(shards[0])
        return map_texts(docs, text_col, keep, lambda: scanner(sent.value), HITS)
    # Beyond one shard: number the rows once, scan them per shard, merge the hits of a row.
    base = materialise(docs.select(
        F.struct(*[col(c) for c in keep]).alias("row"), col(text_col).cast("binary").alias("b"),
        F.monotonically_increasing_id().alias("n")), "decontaminate-rows")
    hits = None
    for shard in shards:
        sent = send(shard)
        one = map_texts(base, "b", ["n"], lambda sent=sent: scanner(sent.value), HITS).select("row.n", "res")
        # written: the shard is needed no more; the first one's rows give the word counts of all documents
        one = materialise(one if hits is None else one.where("res.n_hit > 0"), "decontaminate-hits")
        sent.destroy()
        hits = one if hits is None else hits.unionByName(one)
    runs = F.array_sort(F.flatten(F.collect_list("res.word_runs")))
    merged = hits.groupBy("n").agg(
        F.max("res.n_words").alias("n_words"), runs.alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("res.items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("res.spans"))).alias("spans"))
    fold = """aggregate({0}, cast(array() as array<array<bigint>>), (acc, x) ->
        if(size(acc) > 0 and x[0] <= acc[size(acc) - 1][1],
           concat(slice(acc, 1, size(acc) - 1), array(array(acc[size(acc) - 1][0], greatest(acc[size(acc) - 1][1], x[1])))),
           concat(acc, array(x))))"""
    merged = merged.withColumn("word_runs", F.expr(fold.format("runs"))).withColumn("spans", F.expr(fold.format("spans")))
    merged = merged.withColumn("n_hit", F.expr("aggregate(word_runs, 0L, (a, x) -> a + x[1] - x[0])"))
    return base.select("row", "n").join(merged, "n").select(
        "row", F.struct(*[F.col(f.name) for f in HITS]).alias("res"))


def digest(hits: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the items, verdict."""
    return hits.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("res.n_words").alias("n_words"),
        F.col("res.n_hit").alias("n_hit"),
        F.size("res.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("res.items", ","), 256).alias("items_sha256"),
        (F.col("res.n_hit") > 0).alias("contaminated"),
    )


def brute_force(texts: dict, items: dict, n_words: int = 10) -> dict:
    """doc -> (n_words, n_hit, n_items, sha256) by direct comparison; for tests."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = {c: c + 32 for c in range(65, 91)}
    wanted = []
    for i, t in items.items():
        w = word.findall((t or "").translate(low))
        if w:
            wanted += [(str(i), w[k : k + n_words]) for k in range(max(1, len(w) - n_words + 1))]
    out = {}
    for d, t in texts.items():
        w = word.findall((t or "").translate(low))
        hit, found = set(), set()
        for i, p in wanted:
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    hit.update(range(k, k + len(p)))
                    found.add(i)
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out
