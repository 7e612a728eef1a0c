"""Best-fit packing of tokenised documents by hierarchical residual packing.

Tokens: byte-level BPE of a public vocabulary, then id 0 as the end of the document.

Packing: items are the documents and, of documents over ``length`` tokens, the
first, shorter piece; full pieces are sequences of their own. Each partition
packs its items by best fit, largest first, and emits bins within ``slack`` of
full. Underfull bins are items of the next round, over an eighth of the
partitions, and so on up a tree. A bin carries at most ``length`` items, a
packing task works on blocks of ``BLOCK`` bins, and the last round has as many
partitions as its bins need, so nothing is ever packed whole in one place.
Every round is written to the shared folder; a lost executor repeats its tasks.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_texts, materialise, tokenizer_file

LENGTH = 2048
SLACK = 2
#: Bins that one task packs at a time.
BLOCK = 200_000
#: The published pattern that splits a text before the merges. Fixed value.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PIECE = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])
PIECES = T.StructType([T.StructField("pieces", T.ArrayType(PIECE))])


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes, as ``tokenizers`` gives them.

    The same vocabulary lies beside it as ranks, which tiktoken reads five times
    as fast. It serves texts of characters that both libraries class alike (tab,
    line ends, printable ASCII and Latin letters); any other text, or one that
    spells a special token, goes to ``tokenizers`` itself.
    """

    def __init__(self, path: str, ranks_path: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self._slow = Tokenizer.from_file(path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        special = [re.escape(t.content) for t in self._slow.get_added_tokens_decoder().values()]
        self._other = re.compile("|".join([r"[^\t\n\r\x20-\x7e\xa1-\u024f]", *special]))

    def encode(self, text: str) -> bytes:
        if self._other.search(text):
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.asarray(self._fast.encode_to_numpy(text, disallowed_special=()), "<u4").tobytes()


def pieces_of(ids: bytes, length: int) -> list[dict]:
    n = len(ids) // 4
    first = n if n <= length else n % length or length
    ends = [first, *range(first + length, n + 1, length)]
    out, start = [], 0
    for k, end in enumerate(ends):
        out.append({"piece": k, "start": start, "length": end - start, "ids_crc32": zlib.crc32(ids[4 * start : 4 * end])})
        start = end
    return out


def _tokenise(path: str, ranks_path: str, length: int):
    enc = Encoder(path, ranks_path)
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
    end = (0).to_bytes(4, "little")

    def batch(texts: list[bytes | None]) -> list[pa.Array]:
        return [pa.array([pieces_of(enc.encode((t or b"").decode()) + end, length) for t in texts], kind)]

    return batch


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Groups of item numbers; largest first, each into the bin with the least room that holds it."""
    groups: list[list[int]] = []
    rooms: dict[int, list[int]] = {}  # room -> bins
    keys: list[int] = []  # rooms that have bins, sorted
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = bisect_left(keys, size)
        if at < len(keys):
            room = keys[at]
            bins = rooms[room]
            g = bins.pop()
            if not bins:
                del rooms[room], keys[at]
            groups[g].append(i)
        else:
            room, g = length, len(groups)
            groups.append([i])
        left = room - size
        if left:
            if left not in rooms:
                rooms[left] = []
                keys.insert(bisect_left(keys, left), left)
            rooms[left].append(g)
    return groups


def _merge(block: pa.Table, length: int) -> pa.RecordBatch:
    """Best-fit merge of a block of bins: fill, items with their offset moved."""
    fills = block.column("fill").to_numpy()
    items = block.column("items").combine_chunks()
    groups = best_fit(fills, length)
    order = np.fromiter((i for g in groups for i in g), np.int64)
    per = np.array([len(g) for g in groups])
    moved = items.take(pa.array(order))
    sizes = moved.value_lengths().to_numpy(zero_copy_only=False)
    before = np.cumsum(fills[order]) - fills[order]
    first = np.repeat(before[np.cumsum(per) - per], per)
    flat = moved.flatten()
    cols = {f.name: flat.field(k) for k, f in enumerate(flat.type)}
    cols["offset"] = pa.array(cols["offset"].to_numpy() + np.repeat(before - first, sizes))
    flat = pa.StructArray.from_arrays([cols[f.name] for f in flat.type], fields=list(flat.type))
    ends = np.cumsum(np.add.reduceat(sizes, np.cumsum(per) - per))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), flat)
    fill = np.add.reduceat(fills[order], np.cumsum(per) - per)
    return pa.RecordBatch.from_arrays([pa.array(fill), lists], names=["fill", "items"])


def _round(bins: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= BLOCK:
                yield _merge(pa.Table.from_batches(held), length)
                held, n = [], 0
        if n:
            yield _merge(pa.Table.from_batches(held), length)

    return bins.mapInArrow(run, bins.schema)


def tokenised(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, ranks: str, length: int) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32."""
    # the files are looked up in the task: an executor has its own copy of the vocabularies
    rows = map_texts(docs, text_col, [id_col], lambda: _tokenise(tokenizer_file(vocabulary), tokenizer_file(ranks), length), PIECES)
    return rows.select(F.col("row").getField(id_col).alias("doc_id"), F.explode("res.pieces").alias("p")).select("doc_id", "p.*")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
    length: int = LENGTH,
    slack: int = SLACK,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece.

    A null or empty text is one piece, the closing id 0. Repeated rows and null
    ids are packed like any other. An empty table gives none.
    """
    pieces = materialise(tokenised(docs, id_col, text_col, vocabulary, ranks, length), "packing-pieces")
    item = F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset"))
    bins = pieces.select(F.col("length").alias("fill"), F.array(item).alias("items"))
    done = bins.where(F.col("fill") >= length - slack)
    todo = bins.where(F.col("fill") < length - slack)
    parts = None
    while True:
        packed = materialise(_round(todo, length), "packing-round")
        n, files = packed.where(F.col("fill") < length - slack).count(), max(1, packed.rdd.getNumPartitions())
        least = max(1, -(-n // BLOCK))
        if n == 0 or parts == least or parts is None and files == 1:
            break
        done = done.unionByName(packed.where(F.col("fill") >= length - slack))
        parts = max(least, (parts or files) // 8)
        todo = packed.where(F.col("fill") < length - slack).repartition(parts)
    bins = done.unionByName(packed)
    bins = bins.withColumn("sequence_id", F.monotonically_increasing_id())  # of bins: before they are exploded
    out = bins.select("sequence_id", F.explode("items").alias("i"))
    return out.select("i.doc_id", "i.piece", "i.start", "i.length", "i.ids_crc32", "sequence_id", "i.offset")
