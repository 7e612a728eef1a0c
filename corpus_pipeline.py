"""Corpus pipeline: the training-data operators applied one after another to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake.llm import decontaminate as decontaminate_op, packing, pii, quality, simhash as simhash_op
from marketlake.llm.common import col, materialise, table


def _rows(df: DataFrame, columns: list[str], **replaced) -> DataFrame:
    """The columns of the documents again, out of the struct ``row``."""
    return df.select(*[replaced.get(c, F.col("row").getField(c)).alias(c) for c in columns])


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on this table's labels, doesn't predict to be bad."""
    scored = quality.score(docs, table(spark, sf_dir, "labels"), docs.columns)
    return _rows(scored.where(F.col("score") >= quality.THRESHOLD), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the smallest doc_id, of equal ones the first row.

    Groups are those of the rows' texts, whatever their ids: rows of one doc_id
    with unlike texts each count in their own group. A null doc_id comes after all
    others, so it stays only where its group has no id.
    """
    rows = materialise(docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"),
                                   F.monotonically_increasing_id().alias("n")), "near-dedup-rows")
    marked = simhash_op.near_duplicates(rows.select("row.doc_id", "row.text", "n"), ["doc_id", "n"])
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), F.col("row.n").alias("n"))
    first = marked.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.n").alias("n"))
    return _rows(rows.join(first, "n", "left_semi"), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    found = decontaminate_op.decontaminate(docs, table(spark, sf_dir, "benchmark"), docs.columns)
    return _rows(found.where("res.n_hit = 0"), docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    found = pii.find(docs, docs.columns)
    text = pii.redacted(found)
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length(text).cast("long")).otherwise(F.col("row.n_chars"))
    return _rows(found, docs.columns, **changed)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, each with its sequence and place there."""
    return packing.pack(docs)


#: (name, function) in order.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact),
    ("best_fit_packing", pack),
]

#: SQL can express neither the trained models nor the tokenizer; tests/llm compares with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
