"""The distributed suffix sort against every window of every string."""

import random
from collections import Counter

import pytest

from marketlake.llm import suffix_sort

FIELDS = "cid long, n int, b binary"


def brute(rows, depth):
    met = Counter(b[k:k + depth] for _, n, b in rows for k in range(n))
    return {(i, k) for i, n, b in rows for k in range(n) if met[b[k:k + depth]] > 1}


def strings(rng, count, depth, letters, most):
    pool = bytes(rng.choice(letters) for _ in range(4 * depth))
    out = []
    for i in range(count):
        n, at = rng.randint(1, most), rng.randint(0, 2 * depth)
        b = bytearray(pool[at:at + n - 1 + depth])
        for _ in range(rng.randint(0, 2)):
            b[rng.randrange(len(b))] = rng.choice(letters)
        out.append((7 * i + 3, n, bytes(b)))
    return out


@pytest.mark.parametrize("depth,letters,rows_each", [(40, b"ab", 300), (30, b"\x00\xff", 1 << 20), (25, bytes(range(256)), 200)])
def test_repeated_windows(spark, monkeypatch, depth, letters, rows_each):
    monkeypatch.setattr(suffix_sort, "RANGE_ROWS", rows_each)
    rows = strings(random.Random(depth), 60, depth, letters, depth)
    got = Counter(tuple(r) for r in suffix_sort.repeated_windows(spark.createDataFrame(rows, FIELDS), depth).distinct().collect())
    assert set(got) == brute(rows, depth) and 0 < len(got) < sum(n for _, n, _ in rows)


def test_one_symbol_and_edges(spark, monkeypatch):
    monkeypatch.setattr(suffix_sort, "RANGE_ROWS", 50)
    depth = 20
    rows = [(i, 12, b"a" * 31) for i in range(30)] + [(90, 1, bytes(range(20))), (91, 3, bytes(range(100, 122)))]
    got = {tuple(r) for r in suffix_sort.repeated_windows(spark.createDataFrame(rows, FIELDS), depth).collect()}
    assert got == brute(rows, depth)
    assert suffix_sort.repeated_windows(spark.createDataFrame([], FIELDS), depth).count() == 0
