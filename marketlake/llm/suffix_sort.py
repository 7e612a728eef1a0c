"""Distributed suffix sort of many strings by the difference cover modulo 3.

The strings of level 0 are the texts. A string of a level leaves two to the next:
its places 1, 4, 7 and on, and its places 2, 5, 8 and on, each with the name of
the three symbols from there as its symbol. So a symbol of level j stands for
3**j bytes, and the places of level j stand 3**j apart in a text.

Down: sampled triples are sorted over ranges and named by their dense rank. Names
of level 1 are the triples' own numbers. The last level's names stand for
``depth`` bytes or more: they are the order of its suffixes.

Up: the others, places 0, 3, 6 and on, are merged into the order of the sampled.
Against the places 1 they compare by (symbol, rank of the next), against the
places 2 by (symbol, next symbol, rank of the one after): one range sort holds
both comparisons. A sampled suffix with rank R and c others before it gets R + c;
an other that is the i-th (from 0) and has sampled ones up to rank m before it
gets m + i + 1. That rises strictly, and suffixes with ``depth`` equal bytes stay
side by side, in any order. Only places whose rank a later level asks for go up.

Range sorts order by the key, then the place, so a key met often fills as many
partitions as it needs. Over partitions counts, maxima and edge rows go on: that
is all the driver sees, at most ``RANGES`` times a few numbers or windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialise, scale_partitions

#: Rows of one sorted range, up to ``RANGES`` ranges (larger ones spill).
RANGE_ROWS, RANGES = 1 << 20, 10_000


def _places():
    """(level, size) -> the level's places in a text of that size, and the class modulo 3 of each in its string."""
    known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def places(level: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        if (level, size) not in known:
            starts, step = [0], 1
            for _ in range(level):
                starts = [s + k * step for s in starts for k in (1, 2)]
                step *= 3
            parts = [np.arange(s, size, step) for s in starts]
            place = np.concatenate(parts)
            order = np.argsort(place)
            known[level, size] = place[order], np.concatenate([np.arange(len(x)) % 3 for x in parts])[order]
        return known[level, size]

    return places


def _bytes(text: bytes, pad: int, level: int) -> np.ndarray:
    """Symbols of level 0 or 1 at every place; 0 from the text's end on."""
    s = np.concatenate([np.frombuffer(text, np.uint8).astype(np.int64) + 1, np.zeros(pad + 2, np.int64)])
    return s if level == 0 else s[:-2] << 18 | s[1:-1] << 9 | s[2:]


def _filled(size: int, pad: int, p: np.ndarray, v: np.ndarray) -> np.ndarray:
    full = np.zeros(size + pad, np.int64)
    np.maximum.at(full, p, v)
    return full


def _each(df: DataFrame, make, fields: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """Rows of cid and of the lists that the function of ``make()`` returns for each (cid, size, n, ...)."""
    spec = ", ".join(f"{name}:{sql}" for name, sql, _ in fields)
    names, kinds = [f[0] for f in fields], [f[2] for f in fields]
    at = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for b in batches:
            lists = {}
            if "rows" in at:
                rows = b.column(at.index("rows"))
                ends, flat = rows.offsets.to_numpy(), rows.values
                lists = {k.name: flat.field(i).to_numpy(zero_copy_only=False) for i, k in enumerate(flat.type)}
            sizes, counts = b.column(1).to_pylist(), b.column(2).to_pylist()
            texts = b.column(at.index("b")).to_pylist() if "b" in at else [None] * b.num_rows
            parts = []
            for i in range(b.num_rows):
                own = {k: v[ends[i] : ends[i + 1]] for k, v in lists.items()}
                parts.append(f(sizes[i], counts[i], texts[i], own))
            if not parts:
                continue
            stops = np.cumsum([0, *[len(p[0]) for p in parts]])
            cols = [[x for part in c for x in part] if pa.types.is_binary(t) else np.concatenate(c) for c, t in zip(zip(*parts), kinds)]
            flat = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(stops, pa.int32()), flat)], names=["cid", "out"])

    mapped = df.mapInArrow(run, f"cid long, out array<struct<{spec}>>")
    return mapped.select("cid", F.explode("out").alias("o")).select("cid", "o.*")


LONG, INT = pa.int64(), pa.int32()
TRIPLE = [("q", "int", INT), ("x", "long", LONG), ("y", "long", LONG), ("z", "long", LONG)]


def _triples(level: int):
    """Triples of the symbols of ``level``, at the places p of the next one.

    q is 2 p, and 1 more where the way up asks for the triple's name."""

    def make():
        places, step = _places(), 3 ** level

        def f(size, n, text, own):
            s = _bytes(text, 2 * step, 1) if text is not None else _filled(size, 2 * step, own["p"], own["m"])
            p = places(level + 1, size)[0]
            return 2 * p + (p < n + 6 * step), s[p], s[p + step], s[p + 2 * step]

        return f

    return make


def _compared(level: int):
    """Keys (w, x, y, z) of the two comparisons; r is the rank of a sampled place, -1 for the others."""

    def make():
        places, step = _places(), 3 ** level

        def f(size, n, text, own):
            ranked = own["kind"] == 1
            q = own["p"][ranked]
            rank = _filled(size, 2 * step, q, own["c"][ranked]) + _filled(size, 2 * step, q, own["m"][ranked])
            s = _bytes(text, 2 * step, level) if text is not None else _filled(size, 2 * step, own["p"][~ranked], own["m"][~ranked])
            p, kind = places(level, size)
            wanted = p < n + step - 1
            p, kind = p[wanted], kind[wanted]
            a, b = p[kind != 2], p[kind != 1]
            r = np.where(kind == 0, -1, rank[p])
            return (np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), np.concatenate([s[a], s[b]]),
                    np.concatenate([rank[a + step], s[b + step]]), np.concatenate([np.zeros(len(a), np.int64), rank[b + 2 * step]]),
                    np.concatenate([r[kind != 2], r[kind != 1]]))

        return f

    return make


def _ranges(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    parts = min(RANGES, scale_partitions(rows, RANGE_ROWS))
    return df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)


def _named(df: DataFrame, rows: int, label: str) -> DataFrame:
    """Rows (cid, q, m): m is the dense rank of the triple among all."""
    schema = pa.schema([("cid", LONG), ("q", INT), ("part", INT), ("d", LONG), ("first", pa.list_(LONG)), ("last", pa.list_(LONG))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, first, last = TaskContext.get().partitionId(), 0, None, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(k).to_numpy() for k in (2, 3, 4)])
            new = np.ones(b.num_rows, bool)
            new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            new[0] = last is None or keys[:, 0].tolist() != last
            d = count + np.cumsum(new)
            first, last, count = first or keys[:, 0].tolist(), keys[:, -1].tolist(), int(d[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.full(len(d), part), INT), pa.array(d), *[pa.nulls(len(d), pa.list_(LONG))] * 2],
                schema=schema)
        if last is not None:  # what the next range has to know
            yield pa.RecordBatch.from_pylist([{"part": part, "d": count, "first": first, "last": last}], schema=schema)

    sort = _ranges(df.select("cid", "q", "x", "y", "z"), rows, "x", "y", "z", "cid", "q")
    done = materialise(sort.mapInArrow(run, "cid long, q int, part int, d long, first array<long>, last array<long>"), label)
    offsets, total, before = [], 0, None
    for part, d, first, last in sorted(tuple(r) for r in done.where("cid is null").select("part", "d", "first", "last").collect()):
        total -= first == before
        offsets.append((part, total))
        total, before = total + d, last
    small = df.sparkSession.createDataFrame(offsets, "part int, off long")
    return done.where("cid is not null").join(F.broadcast(small), "part").select("cid", "q", (F.col("d") + F.col("off")).alias("m"))


def _merged(df: DataFrame, rows: int, label: str) -> DataFrame:
    """Rows (cid, p, c, m): a place's rank is its largest c plus its largest m."""
    schema = pa.schema([("cid", LONG), ("p", INT), ("part", INT), ("w", INT), ("other", pa.bool_()), ("c", LONG), ("m", LONG)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), {}
        for b in batches:
            for w in (0, 1):  # sorted by w first
                rows = b.filter(pc.equal(b.column(2), w))
                if not rows.num_rows:
                    continue
                r = rows.column(3).to_numpy()
                count, top = state.get(w, (0, 0))
                c = count + np.cumsum(r < 0)
                m = np.maximum(np.maximum.accumulate(r), top)
                state[w] = int(c[-1]), int(m[-1])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(np.full(len(r), part), INT), rows.column(2), pa.array(r < 0), pa.array(c),
                     pa.array(np.where(r < 0, m, r))], schema=schema)
        if state:
            yield pa.RecordBatch.from_pylist([{"part": part, "w": w, "c": c, "m": m} for w, (c, m) in state.items()], schema=schema)

    sort = _ranges(df, rows, "w", "x", "y", "z", "cid", "p").select("cid", "p", "w", "r")
    done = materialise(sort.mapInArrow(run, "cid long, p int, part int, w int, other boolean, c long, m long"), label)
    offsets, state = [], {}
    for part, w, c, m in sorted(tuple(r) for r in done.where("cid is null").select("part", "w", "c", "m").collect()):
        count, top = state.get(w, (0, 0))
        offsets.append((part, w, count, top))
        state[w] = count + c, max(top, m)
    small = df.sparkSession.createDataFrame(offsets, "part int, w int, off long, top long")
    c = F.when(F.col("other") & (F.col("w") == 1), 0).otherwise(F.col("c") + F.col("off"))
    m = F.when(F.col("other"), F.greatest("m", "top")).otherwise(F.col("m"))
    return done.where("cid is not null").join(F.broadcast(small), ["part", "w"]).select("cid", "p", c.alias("c"), m.alias("m"))


def _listed(rows: DataFrame, texts: DataFrame, *fields: str) -> DataFrame:
    """One row a text, those without a place included: its places are few (a text is of bounded length)."""
    none = F.lit(None).cast("int")
    zero = texts.select("cid", "size", "n", *[F.lit(0).cast(rows.schema[f].dataType).alias(f) for f in fields])
    return rows.select("cid", none.alias("size"), none.alias("n"), *fields).unionByName(zero).groupBy("cid").agg(
        F.max("size").alias("size"), F.max("n").alias("n"), F.collect_list(F.struct(*fields)).alias("rows"))


def _adjacent(df: DataFrame, rows: int, depth: int) -> DataFrame:
    """(cid, k) of the windows equal to one beside them in the order of suffixes."""
    schema = pa.schema([("cid", LONG), ("k", INT), ("part", INT), ("edge", INT), ("win", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, again, first = TaskContext.get().partitionId(), None, False, None
        for b in batches:
            if not b.num_rows:
                continue
            first = first or b.slice(0, 1).to_pylist()[0]
            t = pa.Table.from_batches([held, b] if held else [b]).combine_chunks().to_batches()[0]
            same = pc.equal(t.column(2).slice(1), t.column(2).slice(0, t.num_rows - 1)).to_numpy(zero_copy_only=False)
            hit = np.concatenate([[again], same]) | np.concatenate([same, [False]])
            at = np.flatnonzero(hit[:-1])
            yield pa.RecordBatch.from_arrays(
                [t.column(0).take(pa.array(at)), t.column(1).take(pa.array(at)), pa.array(np.full(len(at), part), INT),
                 pa.array(np.zeros(len(at)), INT), pa.nulls(len(at), pa.binary())], schema=schema)
            held, again = t.slice(t.num_rows - 1), bool(hit[-1])
        if held:
            last = held.to_pylist()[0]
            out = [{**first, "part": part, "edge": 1}, {**last, "part": part, "edge": 2}]
            if again:
                out.append({"cid": last["cid"], "k": last["k"], "part": part, "edge": 0})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    sort = _ranges(df, rows, "r", "cid", "k").select("cid", "k", "win")
    done = materialise(sort.mapInArrow(run, "cid long, k int, part int, edge int, win binary"), "suffix-windows")
    edges = done.where("edge > 0").select("part", "edge", "win", "cid", "k").collect()
    edges = sorted(edges, key=lambda r: r[:2])
    extra = [(r.cid, r.k) for a, b in zip(edges[1::2], edges[2::2]) if a.win == b.win for r in (a, b)]
    more = df.sparkSession.createDataFrame(extra, "cid long, k int")
    return done.where("edge = 0").select("cid", "k").unionByName(more)


def repeated_windows(strings: DataFrame, depth: int) -> DataFrame:
    """(cid, k): the windows of ``depth`` bytes from places k < n that occur at two such places or more.

    ``strings`` has cid (long, unique), n (int) and b (binary, n - 1 + ``depth`` bytes); it is read
    several times, so it should be a written table. No rows give none.
    """
    s = strings.select("cid", F.length("b").alias("size"), "n", "b")
    found = s.agg(F.sum("size"), F.sum("n")).first()
    if found[0] is None:
        return s.select("cid", F.col("n").alias("k"))
    top = 2
    while 3 ** top < depth:
        top += 1
    size = lambda level: int(found[0] * (2 / 3) ** level)
    place = F.shiftright("q", 1).alias("p")
    names = {}
    for level in range(2, top + 1):
        src = s if level == 2 else _listed(names[level - 1].select("cid", place, "m"), s, "p", "m")
        names[level] = _named(_each(src, _triples(level - 1), TRIPLE), size(level), f"suffix-names-{level}")
    zero = F.lit(0).cast("long").alias("c")
    ranks = names[top].select("cid", place, zero, "m")
    keyed = [("p", "int", INT), ("w", "int", INT), *TRIPLE[1:], ("r", "long", LONG)]
    for level in range(top - 1, -1, -1):
        rows = ranks.withColumn("kind", F.lit(1))
        if level >= 2:
            symbols = names[level].where(F.col("q") % 2 == 1).select("cid", place, zero, "m")
            rows = rows.unionByName(symbols.withColumn("kind", F.lit(0)))
        listed = _listed(rows, s, "kind", "p", "c", "m")
        if level < 2:
            listed = listed.join(s.select("cid", "b"), "cid")
        ranks = _merged(_each(listed, _compared(level), keyed), min(size(level), found[1] * 3 ** level) * 4 // 3, f"suffix-ranks-{level}")

    def windows():
        def f(size, n, text, own):
            r = _filled(size, 0, own["p"], own["c"]) + _filled(size, 0, own["p"], own["m"])
            return np.arange(n), r[:n], [text[k : k + depth] for k in range(n)]

        return f

    own = _listed(ranks, s, "p", "c", "m").join(s.select("cid", "b"), "cid")
    fields = [("k", "int", INT), ("r", "long", LONG), ("win", "binary", pa.binary())]
    return _adjacent(_each(own, windows, fields), found[1], depth)
