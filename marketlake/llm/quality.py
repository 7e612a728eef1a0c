"""Quality classifier: supervised subword embeddings.

A text's features are its words, the 3- and 4-byte n-grams of each word between
``<`` and ``>``, and a mark for each word that repeats the one before it; all
hashed into ``BUCKETS`` rows of a learned matrix. A document is the mean of its
rows, a linear layer and a softmax give the two classes. Numpy stochastic
gradient descent, one document a step, with a falling rate.

Training takes at most ``MAX_TRAIN`` labelled documents, those with the smallest
hash of their id, one row of each: a bounded, documented sample, fitted on the
driver. Their texts hold at most ``MAX_TRAIN_BYTES``: in the order of the hash, a
text that would exceed the sum is passed over, and later ones may fit. Scoring
covers every row in one narrow pass: the matrix and the layer fold into one
number a bucket (the difference of the class scores), a megabyte to broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import col, map_texts, materialise

BUCKETS = 1 << 17
DIM = 8
EPOCHS = 6
RATE = 0.8
MAX_TRAIN = 2000
MAX_TRAIN_BYTES = 32 << 20
THRESHOLD = 0.7
#: Bytes that are hashed at a time; longer texts are cut at white space near this size.
CHUNK = 1 << 20

SCORE = T.StructType([T.StructField("score", T.DoubleType())])
_SPACES = bytes(32 if c in (9, 10, 11, 12, 13) else c for c in range(256))
_SAME = 0  # the bucket of the mark for a repeated word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return rng.integers(0, 1 << 32, (4, 256), dtype=np.uint32), rng.integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the text) of every feature, for texts of white space and words.

    A space stands for both ends of a word, so n-grams may begin and end with one
    but hold none inside. Tabulation hashes of all bytes at once.
    """
    grams, mult = _tables()
    buf = np.frombuffer(b" " + b" ".join(t.translate(_SPACES) for t in texts) + b"    ", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    n = len(owner)
    solid = buf != 32
    mask = np.uint32(BUCKETS - 1)
    h3 = grams[0][buf[:n]] ^ grams[1][buf[1 : n + 1]] ^ grams[2][buf[2 : n + 2]]
    h4 = h3 ^ grams[3][buf[3 : n + 3]]
    in3 = solid[1 : n + 1]
    in4 = in3 & solid[2 : n + 2]
    first = np.flatnonzero(solid[1 : n + 1] & ~solid[:n]) + 1
    if not len(first):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # words: a sum of odd multiples by byte, each turned by its place in the word
    at = np.arange(n + 1)
    place = at - np.maximum.accumulate(np.where(np.concatenate([[False], solid[1 : n + 1] & ~solid[:n]]), at, 0))
    power = (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    part = np.where(solid[: n + 1], mult[buf[: n + 1]] * (power ^ (power >> np.uint64(31))), np.uint64(0))
    word = np.add.reduceat(part, first)
    word ^= word >> np.uint64(32)
    whose = owner[first - 1]
    same = whose[1:][(word[1:] == word[:-1]) & (whose[1:] == whose[:-1])]
    ids = np.concatenate([
        (word & np.uint64(BUCKETS - 1)).astype(np.int64), (h3[in3] & mask).astype(np.int64),
        (h4[in4] & mask).astype(np.int64), np.full(len(same), _SAME, np.int64)])
    return ids, np.concatenate([whose, owner[in3], owner[in4], same])


def _chunks(texts: list[bytes | None]):
    """(numbers of the texts, parts) with about ``CHUNK`` bytes in each."""
    nums, parts, size = [], [], 0
    for k, t in enumerate(texts):
        t = t or b""
        while t:
            cut = len(t)
            if cut > CHUNK:
                cut = t.rfind(b" ", 0, CHUNK) + 1 or CHUNK
            nums.append(k)
            parts.append(t[:cut])
            size += cut
            t = t[cut:]
            if size >= CHUNK:
                yield nums, parts
                nums, parts, size = [], [], 0
    if nums:
        yield nums, parts


def text_features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    found = [features(parts)[0] for _, parts in _chunks([text])]
    ids = np.concatenate(found) if found else np.empty(0, np.int64)
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.float64)
    at, n = np.unique(ids, return_counts=True)
    return at, n / n.sum()


def train(texts: list[bytes | None], labels: list[int], seed: int = 7) -> tuple[np.ndarray, float]:
    """(difference of class scores for each bucket, bias)."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    layer, bias = np.zeros((2, DIM)), np.zeros(2)
    feats = [text_features(t) for t in texts]
    steps, total = 0, max(1, EPOCHS * len(texts))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)).tolist():
            rate = RATE * (1 - steps / total)
            steps += 1
            at, share = feats[i]
            hidden = share @ emb[at] if len(at) else np.zeros(DIM)
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1  # gradient of the softmax loss
            back = layer.T @ p
            layer -= rate * np.outer(p, hidden)
            bias -= rate * 0.1 * p
            if len(at):
                # a mean over thousands of rows moves each by little: the step is scaled by their number
                emb[at] -= rate * np.minimum(share * 40, 1.0)[:, None] * back
    return emb @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def _scorer(diff: np.ndarray, bias: float):
    def batch(texts: list[bytes | None]) -> list[pa.Array]:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for nums, parts in _chunks(texts):
            ids, whose = features(parts)
            nums = np.array(nums)
            np.add.at(total, nums, np.bincount(whose, diff[ids], len(nums)))
            np.add.at(count, nums, np.bincount(whose, minlength=len(nums)))
        z = bias + total / np.maximum(count, 1)
        return [pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())]

    return batch


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_train: int = MAX_TRAIN, max_bytes: int = MAX_TRAIN_BYTES) -> tuple[np.ndarray, float]:
    """Model from labelled documents that are not held out: at most ``max_train``, with ``max_bytes`` of text.

    Of the rows of a repeated id the smallest text that is not null counts.
    """
    known = labels.where(col(label_col).isin(0, 1) & col(id_col).isNotNull() & ~held_out(col(id_col)))
    known = known.groupBy(col(id_col).alias("id")).agg(F.min(col(label_col)).alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(max_train)
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("binary").alias("b"))
    one = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("b").alias("b"), F.min("y").alias("y"))
    one = materialise(one, "quality-sample")
    order = F.xxhash64("id"), F.col("id")
    fit_in, total, over = [], 0, False
    for r in one.orderBy(*order).select("id", F.coalesce(F.octet_length("b"), F.lit(0)).alias("n")).collect():
        if total + r.n <= max_bytes:
            total += r.n
            fit_in.append(r.id)
        else:
            over = True
    got = (one.where(F.col("id").isin(fit_in)) if over else one).orderBy(*order).collect()
    return train([r.b if r.b is None else bytes(r.b) for r in got], [int(r.y) for r in got])


def score(docs: DataFrame, labels: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_train: int = MAX_TRAIN) -> DataFrame:
    """Struct ``row`` of the kept columns and ``score`` (0 to 1) for every document.

    Null and empty texts have no features: their score is the bias's. Labels that
    are null or neither 0 nor 1 teach nothing; of several labels of a document the
    smallest counts. Without any label every score is 0.5. Repeated rows stay.
    """
    diff, bias = fit(docs, labels, id_col, text_col, label_col, max_train)
    sent = docs.sparkSession.sparkContext.broadcast((diff, bias))
    return map_texts(docs, text_col, keep, lambda: _scorer(*sent.value), SCORE).select("row", F.col("res.score").alias("score"))


def digest(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
