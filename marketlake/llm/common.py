"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketlake.session import scratch_path

#: Rows in one Arrow batch: with texts of some hundred kilobytes a batch stays under 100 MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and back ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    The written table cuts the lineage: a lost executor costs only its own
    tasks, and values such as row numbers are fixed from here on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows, where the session has Spark's default only."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def map_texts(
    docs: DataFrame,
    text_col: str,
    keep: list[str],
    make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    schema: T.StructType,
) -> DataFrame:
    """Columns ``keep`` of every row, plus a struct ``res`` that a function makes of the text.

    ``make`` runs once in each task and returns a function from a batch of
    UTF-8 texts (None: null) to one Arrow array for each field of ``schema``.
    The kept columns travel as one struct, so their names can't clash with
    those of the result. Narrow: no shuffle.
    """
    small_batches(docs.sparkSession)
    inside = text_col in keep
    parts = [F.struct(*[col(c) for c in keep]).alias("row")]
    if not inside:
        parts.append(col(text_col).cast("binary").alias("b"))
    src = docs.select(*parts)
    out = T.StructType([src.schema["row"], T.StructField("res", schema)])
    at = keep.index(text_col) if inside else -1
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for batch in batches:
            f = f or make()
            row = batch.column(0)
            texts = (row.flatten()[at].cast(pa.binary()) if inside else batch.column(1)).to_pylist()
            res = pa.StructArray.from_arrays(f(texts), names=names)
            yield pa.RecordBatch.from_arrays([row, res], names=["row", "res"])

    return src.mapInArrow(run, out)


def scale_partitions(n_rows: int, rows_each: int, least: int = 1) -> int:
    return max(least, -(-n_rows // rows_each))


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; MARKETLAKE_TOKENIZERS names another folder."""
    folder = os.environ.get("MARKETLAKE_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
