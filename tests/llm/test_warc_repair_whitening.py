"""WARC archives, conversation repair and whitening against brute force, on edge rows and whole small tables."""

import base64
import gzip
import hashlib
import heapq
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import conversations, queries, warc, whitening

SF = "/root/testdata/sf0.001"


# ---- WARC

PAGES = "page_id long, url string, html string, digest string, n int, file string"
PAGE_ROWS = [
    (1, "http://a.example/x", "same"), (2, "http://b.example/", "same"), (3, None, "same"), (3, None, "same"), (3, "http://c.example/", "same"),
    (4, "http://d.example/\r\nX: y z", ""), (5, "", None), (None, "http://e.example/", None), (None, None, "alone"),
    (None, "u", "both null"), (None, "v", "both null"), (6, "http://f.example/é", "é\r\n\r\nWARC/1.1\r\n" * 3), (7, "g", "long " * 50_000),
    (-2, "h", "negative"), (-1, "h", "negative"),
]


def brute_pages(rows):
    groups = defaultdict(list)
    for i, u, h in rows:
        groups[(h or "").encode()].append((i, u))
    out = Counter()
    for payload, members in groups.items():
        best = max(members, key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or ""))
        told = (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        members.remove(best)
        out[(best[0], *told, "response", None)] += 1
        for m in members:
            out[(m[0], *told, "revisit", best[0])] += 1
    return out


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(*r, "d", 1, "f") for r in PAGE_ROWS], PAGES).repartition(3)


def test_warc_edges(spark, pages):
    index = warc.write(pages, file_bytes=300)
    got = Counter(map(tuple, warc.digest(warc.read(index, span=512, gap=16), pages.schema["page_id"].dataType).collect()))
    assert got == brute_pages(PAGE_ROWS)
    assert warc.digest(warc.read(warc.write(pages.limit(0))), pages.schema["page_id"].dataType).count() == 0


def test_warc_reads_what_is_selected(spark, pages):
    index = warc.write(pages)
    some = index.where("key in ('6', '7', '3')").unionByName(index.where("key = '6'"))
    got = warc.read(some, with_payload=True).collect()
    assert Counter(r.key for r in got) == Counter(r.key for r in some.select("key").collect())
    texts = {str(i): (h or "").encode() for i, _, h in PAGE_ROWS}
    assert all(bytes(r.payload) == texts[r.key] for r in got if r.record_type == "response")
    assert all(r.payload is None and r.payload_bytes == 4 and r.refers_to == "3" for r in got if r.record_type == "revisit")
    assert {r.url for r in got if r.key == "6"} == {"http://f.example/é"}


def test_warc_files_are_plain_archives(spark, pages):
    """Every archive is gzip members of whole WARC records; the index names each but the first of a file."""
    index = warc.write(pages).collect()
    seen = []
    for file in {r.file for r in index}:
        fs, path = warc.filesystem(file)
        data = fs.open_input_file(path).read()
        at = 0
        while at < len(data):
            z = zlib.decompressobj(31)
            headers, block = warc.parse(z.decompress(data[at:]))
            size = len(data) - at - len(z.unused_data)
            if headers["warc-type"] != "warcinfo":
                seen.append((file, at, size, headers["warc-type"], headers["warc-payload-digest"]))
                assert block.startswith(b"HTTP/1.1 200 OK\r\n") and "\n" not in "".join(headers.values())
            at += size
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert Counter(seen) == Counter((r.file, r.offset, r.length, r.record_type, f"sha1:{r.digest}") for r in index)


def test_warc_ranges_are_coalesced(spark, pages, monkeypatch):
    index = warc.write(pages.repartition(1)).orderBy("file", "offset").collect()
    rows = [tuple(r) for r in index if r.record_type == "response"]
    reads = []

    class File:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read_at(self, n, at):
            reads.append((at, n))
            return self.f.read_at(n, at)

    class Fs:
        def __init__(self, fs):
            self.fs = fs

        def open_input_file(self, p):
            return File(self.fs.open_input_file(p))

    real = warc.filesystem
    monkeypatch.setattr(warc, "filesystem", lambda uri: (Fs(real(uri)[0]), real(uri)[1]))
    import pyarrow as pa

    def run(span, gap, chosen):
        reads.clear()
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*chosen), warc.INDEX)], schema=warc.INDEX)
        out = list(warc._reader(span, gap, False)(iter([batch])))
        assert sum(b.num_rows for b in out) == len(chosen)
        return len(reads)

    one = [r for r in rows if r[0] == rows[0][0]]
    assert run(1 << 20, 1 << 16, one) == 1
    assert run(1 << 20, 0, one) == 1  # records lie next to each other
    assert run(1, 1 << 16, one) == len(one)
    assert run(1 << 20, 0, one[::2]) == len(one[::2])


def test_warc_refuses_a_wrong_index(spark, pages):
    index = warc.write(pages)
    with pytest.raises(Exception, match="index row|WARC record|incorrect|decompress"):
        warc.read(index.withColumn("digest", F.lit("A" * 32))).collect()


def test_warc_table(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert Counter(map(tuple, queries.QUERIES["op11_warc"](spark, SF).collect())) == brute_pages(rows)


# ---- conversation repair

def brute_audit(codes):
    """One-directional search over (cost, audit)."""
    heap, seen = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(codes) and q in (0, 3):
            return cost, audit
        want, to = ("a", 3) if q == 2 else ("u", 2)
        nxt = [(3, "I", i, to)]
        if i < len(codes):
            c = codes[i]
            nxt.append((4, "D", i + 1, q))
            if c not in "bd":
                x = 3 if c.isupper() else 0
                nxt.append((3 + x, "R", i + 1, to))
                if c.lower() == want:
                    nxt.append((x, "K", i + 1, to))
                if c.lower() == "s" and q == 0:
                    nxt.append((x, "K", i + 1, 1))
        for c, letter, j, p in nxt:
            heapq.heappush(heap, (cost + c, audit + letter, j, p))


def brute_conversations(rows, damaged=True):
    """(conv, turn, role, text) -> the contract's result a conversation."""
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        groups[conv] += {0: [], 1: [(turn, role, "")], 2: [(turn, role, text.translate(str.maketrans("", "", ".!?")))],
                         3: [(turn, role, text)] * 2, 4: [(turn, "user", text)]}.get(h, [(turn, role, text)])
    out = {}
    for conv, members in groups.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode()))
        seen, codes = set(), ""
        for _, role, text in members:
            body = text.strip(" \t\n\x0b\x0c\r")
            kind = role[0] if role[:1] in ("s", "u", "a") else "o"
            codes += "b" if not body else "d" if (role, text) in seen else kind if body[-1] in ".!?" else kind.upper()
            seen.add((role, text))
        cost, audit = brute_audit(codes)
        turns = [m[0] for m in members if m[0] is not None]
        lines, i, state = [], 0, ""
        for letter in audit:
            want = "assistant" if state == "u" else "user"
            if letter == "I":
                lines.append(f"{want}:")
                state = want[0]
                continue
            _, role, text = members[i]
            i += 1
            if letter != "D":
                role = role if letter == "K" else want
                lines.append(f"{role}:{text}")
                state = role[0]
        initials = [m[1][:1] for m in members]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, codes.count("b"), codes.count("d"),
                     sum(c.isupper() for c in codes), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_lattice_against_one_direction():
    for length in range(5):
        for t in itertools.product("suaobUA", repeat=length):
            codes = "".join(t)
            assert conversations.solve(codes, 0, conversations.ENDS, True)[:2] == brute_audit(codes), codes
    rng = random.Random(12)
    for _ in range(500):
        codes = "".join(rng.choice("suaobdUASO" if rng.random() < 0.5 else "uuaa") for _ in range(rng.randint(5, 40)))
        assert conversations.solve(codes, 0, conversations.ENDS, True)[:2] == brute_audit(codes), codes


CONV = "conv_id long, turn long, role string, text string, seq int, messages string, present boolean"


def conversation_rows():
    rng = random.Random(5)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), rng.choice(["user", "assistant", "system", "tool", "", None, "ua"]),
                         rng.choice(["Yes.", "No?", "cut", "", None, "  \t", "Yes. ", "a" * 5000 + "!"])))
    rows += [(100, t, "user" if t % 2 else "assistant", f"line {t}.") for t in range(150)]  # longer than a block
    rows += [(101, 7, "user", "the same.")] * 60  # one row over and over
    rows += [(102, t, rng.choice(["user", "assistant"]), "again and again!") for t in range(120)]
    return rows


@pytest.mark.parametrize("block", [4, 16, 512])
def test_repair_against_brute_force(spark, block):
    rows = conversation_rows()
    df = spark.createDataFrame([(*r, 1, "m", False) for r in rows], CONV).repartition(7)
    for damaged in (True, False):
        src = conversations.damage(df) if damaged else df.select("conv_id", "turn", "role", "text")
        got = conversations.digest(conversations.repair(src, present_col="present" if damaged else None, block=block)).collect()
        assert len(got) == len({r[0] for r in rows})
        assert {r[0]: tuple(r)[1:] for r in got} == brute_conversations(rows, damaged)


def test_repair_gives_the_messages(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = defaultdict(list)
    hashes = {}
    for r in conversations.repair(df, with_messages=True, block=16).collect():
        pieces[r.conv].append((r.piece, r.messages))
        if r.done:
            hashes[r.conv] = r.done.repaired_sha256
    assert len(pieces[100]) > 1
    for conv, parts in pieces.items():
        lines = [f"{m.role}:{m.text}" for _, messages in sorted(parts) for m in messages]
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == hashes[conv]


def test_repair_empty_and_dropped(spark):
    empty = spark.createDataFrame([], CONV)
    assert conversations.digest(conversations.repair(conversations.damage(empty), present_col="present")).count() == 0
    dropped = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(9, dropped, "user", "x.", 1, "", True)], CONV)
    got = conversations.digest(conversations.repair(conversations.damage(df), present_col="present")).collect()
    assert [tuple(r) for r in got] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    got = queries.QUERIES["op12_conversation_repair"](spark, SF).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_conversations(rows) and len(got) == len({r[0] for r in rows})


# ---- whitening

def brute_whitening(rows, k=16):
    fine = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in fine}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, x in fine:
        dev = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        out[i] = (n, dev, (np.array(x) - sums / n) @ vectors / np.sqrt(values))
    return out, values / np.trace(centred.T @ centred / n)


def same_whitening(got, rows, k=16):
    want, explained = brute_whitening(rows, k)
    found = defaultdict(dict)
    for r in got:
        assert r.component not in found[r.vec_id]
        found[r.vec_id][r.component] = r
    assert set(found) == set(want)
    ids = sorted(want, key=str)
    ours = np.array([[found[i][c + 1].whitened for c in range(len(explained))] for i in ids])
    theirs = np.array([want[i][2] for i in ids])
    sign = np.sign((ours * theirs).sum(axis=0))
    assert np.allclose(ours, theirs * sign, atol=1e-7)
    for i in ids:
        assert {(r.n, r.deviation) for r in found[i].values()} == {want[i][:2]}
    assert np.allclose([found[ids[0]][c + 1].explained for c in range(len(explained))], explained, rtol=1e-10)
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same_whitening(queries.QUERIES["op13_whitening"](spark, SF).collect(), rows)


VECTORS = "vec_id long, embedding array<float>, x string, component int, n long"


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    plain = [(i, [float(c) for c in rng.standard_normal(5) * [5, 4, 3, 2, 1]]) for i in range(60)]
    same = [(1000 + i, plain[0][1]) for i in range(200)]  # copies count once in the fit
    odd = [(2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0]), (2003, [1.0, float("nan"), 1.0, 1.0, 1.0]),
           (2004, [float("inf")] * 5), (2005, [1.0, 2.0]), (None, [1.0, -2.0, 3.0, 0.5, 0.25])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in plain + same + odd], VECTORS).repartition(4)
    got = whitening.digest(whitening.whiten(df, ["vec_id"])).collect()
    same_whitening(got, [r for r in plain + same + odd if r[1] is None or len(r[1]) != 2])
    twice = spark.createDataFrame([(7, v, "x", 1, 2) for _, v in plain] * 2, VECTORS)
    assert whitening.whiten(twice, ["vec_id", "n"]).count() == 2 * 60 * 5
    for few in ([], odd[:2], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in few], VECTORS)
        assert whitening.digest(whitening.whiten(df, ["vec_id"])).collect() == []


def test_whitening_of_huge_entries(spark):
    df = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 4.0])], "vec_id long, embedding array<double>")
    got = whitening.digest(whitening.whiten(df, ["vec_id"])).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and {r.deviation for r in got if r.vec_id == 1} == {None}


def test_eigenpairs():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 8, 64):
        x = rng.standard_normal((300, n)) * rng.random(n) * 50
        spaced = np.cov(x.T, bias=True).reshape(n, n)
        tied = np.diag(np.repeat([5.0, 2.0, 1.0], [30, 20, 50])[:n])
        low = np.outer(x[0], x[0])
        close = np.eye(n) + 1e-9 * spaced
        for a, rank in ((spaced, n), (tied, n), (low, 1), (close, n)):
            values, vectors = whitening.leading_eigenpairs(a, 16)
            want = np.linalg.eigvalsh(a)[::-1][: min(16, rank)]
            assert len(values) == len(want) and np.allclose(values, want, rtol=1e-12, atol=1e-13 * want[0])
            assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-13 * want[0]
            assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13


def test_sums_are_exact(spark):
    x = [2**52 + 1, 2**52 + 3, -(2**51) - 7]
    df = spark.createDataFrame([(np.array([v], np.int64).tobytes(),) for v in x], "x binary").repartition(2)
    assert whitening._sums(df, 1, 4) == [sum(x)]
