"""Secret scan: all rules in one pass of a combined deterministic automaton.

One unanchored automaton of all rules reads each batch's bytes once and gives
the places where some rule's match ends. Such places are rare; around each, the
stretch between bytes that no rule uses is matched again by the automata of the
rules found, which gives leftmost-longest matches. Every rule repeats greedily
over one class at its end, so leftmost-longest is what its regex matches.

``assign``, ``access`` and ``hex`` are the base kinds; the others add spans.
Narrow: one pass over the texts, no shuffle; what is broadcast has the size of
the rules.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .automaton import Dfa, compile_rules, longest_matches, plain, scan_ends
from .common import map_texts


def _assigned(m: bytes) -> bool:
    """Whether the value after the sign has 8 characters."""
    at = next(i for i, c in enumerate(m) if c in b":=") + 1
    rest = m[at:].lstrip(b" ")
    return len(rest[1:] if rest[:1] in (b'"', b"'") else rest) >= 8


def _at_least(n: int) -> Callable[[bytes], bool]:
    return lambda m: len(m) >= n


#: (kind, regex, what a match must also meet). Fixed values; the first three are the base kinds.
#: ``hex`` is scanned from 12 characters on, so that words don't count: maximal runs are the same either way.
RULES = (
    ("assign", rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", _assigned),
    ("access", rb"AKIA[A-Z0-9]+", _at_least(16)),
    ("hex", rb"[0-9a-f]{12,}", _at_least(32)),
    ("forge_token", rb"gh[pousr]_[A-Za-z0-9]+", _at_least(40)),
    ("chat_token", rb"xox[abprs]-[A-Za-z0-9-]+", _at_least(15)),
    ("cloud_key", rb"AIza[A-Za-z0-9_-]+", _at_least(39)),
    ("pay_key", rb"[sr]k_(?:live|test)_[A-Za-z0-9]+", _at_least(24)),
    ("web_token", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", _at_least(40)),
    ("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", _at_least(0)),
)
BASE = 3
FOUND = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def compiled(rules=RULES) -> tuple[Dfa, list[Dfa]]:
    """The combined automaton, and one of each rule."""
    return compile_rules([r[1] for r in rules], anchored=False), [compile_rules([r[1]], anchored=True) for r in rules]


def scanner(union: Dfa, single: list[Dfa], rules=RULES):
    """A function from a batch of texts to their spans, by start, then rule, in code points."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def spans_of(text: bytes, hits: list[tuple[int, int]], free: np.ndarray) -> list[dict]:
        out = []
        pieces: dict[tuple[int, int], int] = {}
        for end, mask in hits:
            k = int(np.searchsorted(free, end))
            span = (int(free[k - 1]) + 1 if k else 0, int(free[k]) if k < len(free) else len(text))
            pieces[span] = pieces.get(span, 0) | mask
        for (a, b), mask in pieces.items():
            for r, (_, _, meets) in enumerate(rules):
                if mask >> r & 1:
                    for s, e in longest_matches(single[r], text[a:b]):
                        if meets(text[a + s : a + e]):
                            out.append((a + s, r, a + e))
        out.sort()
        if out and not text.isascii():
            # code points before a byte: bytes that don't continue a character
            before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            out = [(int(before[s]), r, int(before[e])) for s, r, e in out]
        return [{"kind": r, "start": s, "end": e} for s, r, e in out]

    def batch(texts: list[bytes | None]) -> list[pa.Array]:
        found: list[list[dict]] = [[] for _ in texts]
        # blocks of texts of some megabytes; a zero byte, which no rule uses, ends each text
        k = 0
        while k < len(texts):
            first, size = k, 0
            while k < len(texts) and (size < 4 << 20 or k == first):
                size += len(texts[k] or b"") + 1
                k += 1
            block = b"".join((t or b"") + b"\0" for t in texts[first:k])
            ends, masks, free = scan_ends(union, np.frombuffer(block, np.uint8))
            if len(ends):
                begins = np.concatenate([[0], np.cumsum([len(t or b"") + 1 for t in texts[first:k]])])
                whose = np.searchsorted(begins, ends, side="right") - 1
                for d in np.unique(whose).tolist():
                    mine = whose == d
                    a, b = int(begins[d]), int(begins[d + 1])
                    near = free[np.searchsorted(free, a) : np.searchsorted(free, b)] - a
                    found[first + d] = spans_of(texts[first + d], list(zip((ends[mine] - a).tolist(), masks[mine].tolist())), near)
        return [pa.array(found, kind)]

    return batch


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", rules=RULES) -> DataFrame:
    """Struct ``row`` of the kept columns and ``spans`` (kind number, start, end) for every document.

    Null and empty texts have no spans; repeated rows stay, each with its own.
    """
    union, single = compiled(rules)
    sent = docs.sparkSession.sparkContext.broadcast((plain(union), [plain(d) for d in single]))

    def make():
        return scanner(Dfa(*sent.value[0]), [Dfa(*d) for d in sent.value[1]], rules)

    return map_texts(docs, text_col, keep, make, FOUND).select("row", F.col("res.spans").alias("spans"))


def digest(found: DataFrame, rules=RULES, base: int = BASE) -> DataFrame:
    names = F.array(*[F.lit(r[0]) for r in rules])
    said = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k).alias(f"n_{rules[k][0]}") for k in range(base)],
        F.sha2(said(F.filter("spans", lambda x: x["kind"] < base)), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"))
