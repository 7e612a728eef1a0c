"""What must not grow with the rows: broadcasts of the near-duplicate index, bytes that suffix sorts are given."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marketlake.llm import simhash, suffix_dedup


def test_exploded_index_is_never_broadcast(spark, tmp_dir, monkeypatch):
    """Spark sizes exploded rows as those before: any static threshold would broadcast 66 times as much."""
    near = F.when(F.col("id") < 80, F.expr("shiftleft(1L, cast(id % 32 as int))")).otherwise(F.xxhash64("id"))
    spark.range(500).select(near.alias("fp")).distinct().write.parquet(f"{tmp_dir}/nodes")
    plans = {}
    written = simhash.materialise

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return written(df, name)

    monkeypatch.setattr(simhash, "materialise", seen)
    monkeypatch.setattr(simhash, "MAX_BUCKET", 4)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "10MB")
        found = {tuple(r) for r in simhash.links(spark.read.parquet(f"{tmp_dir}/nodes")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "Broadcast" not in plans["simhash-index"]
    assert plans["simhash-links"].count("SortMergeJoin") == 1  # of the refined index; the written one has its own size
    fps = [r.fp for r in spark.read.parquet(f"{tmp_dir}/nodes").collect()]
    assert found == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def _windows(contexts, starts, length):
    met = Counter(c[k : k + length] for c, n in zip(contexts, starts) for k in range(n))
    return [[met[c[k : k + length]] > 1 for k in range(n)] for c, n in zip(contexts, starts)]


def test_only_windows_of_a_hash_met_again_are_sorted(monkeypatch):
    rng = random.Random(4)
    text = lambda n: bytes(rng.choice(b"abcd") for _ in range(n))
    shared = text(90)
    contexts = [text(20) + shared[rng.randint(0, 30) : rng.randint(60, 90)] + text(60) for _ in range(60)] + [shared, shared[:50]]
    starts = [len(c) - 39 for c in contexts]
    sorted_ = []
    array = suffix_dedup.suffix_array

    def seen(s, depth, told=1, want=None):
        if told == 1:
            sorted_.append(len(s))
        return array(s, depth, told, want)

    monkeypatch.setattr(suffix_dedup, "suffix_array", seen)
    expected = _windows(contexts, starts, 40)
    assert [m.tolist() for m in suffix_dedup.repeated(contexts, starts, 40)] == expected
    met = sum(map(sum, expected))
    assert 0 < met and sum(sorted_) <= 40 * met < sum(map(len, contexts)) * 40
    # equal hashes only propose: the bytes decide
    monkeypatch.setattr(suffix_dedup, "_window_hashes", lambda t, length: np.zeros(max(0, len(t) - length + 1), np.uint64))
    assert [m.tolist() for m in suffix_dedup.repeated(contexts, starts, 40)] == expected


def test_large_anchor_sends_what_may_be_repeated(spark, monkeypatch):
    """Of contexts with unlike surroundings only the shared stretches are sorted over the cluster, equal ones once."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    short, shared = text(300), text(440)
    rows = [(i, text(300) + short + text(300)) for i in range(40)] + [(100 + i, text(200) + chr(256 + i) + shared + chr(256 + i) + text(200)) for i in range(40)]
    sizes = []
    whole = suffix_dedup.repeated_windows

    def seen(strings, depth):
        sizes.append(strings.agg(F.sum(F.length("b"))).first()[0] or 0)
        return whole(strings, depth)

    monkeypatch.setattr(suffix_dedup, "repeated_windows", seen)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.row.doc_id: r.n_removed for r in suffix_dedup.dedup(df, ["doc_id"]).collect()}
    rows = [(i, t.encode()) for i, t in rows]
    met = Counter(t[k : k + 400] for _, t in rows for k in range(len(t) - 399))
    for i, t in rows:
        gone = {k + j for k in range(len(t) - 399) if met[t[k : k + 400]] > 1 for j in range(400)}
        assert found[i] == len(gone)
    assert max(found.values()) == 441 and sum(sizes) < 3000
