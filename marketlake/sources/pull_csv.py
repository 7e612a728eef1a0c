"""Pull report CSV scan (S4) with header mapping (P3), dim normalisation (P4) and
lenient numbers (P5).

Files are grouped by their header line (read once per file); each group is cut into
records over as many tasks as it has splits (``quoted_text``: quotes may hold line
ends), the records are read by ``from_csv``, and their columns renamed by a plan
computed on the driver from the header names (metadata, not data).
"""

from __future__ import annotations

import csv
import datetime as _dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.functions import dim_normalize, lenient_float_pull, parse_date, py_strip
from marketlake.sources.quoted_text import ends_inside, file_records

PULL_FIELDS = ("fact_date", "media_source", "campaign", "adset", "ad", *K.PULL_METRICS)


def field_for_header(header: str | None) -> str | None:
    """The field a header feeds, or None.

    A header is compared without case and outer white space, once in full and once
    without its parenthesised tail; the full form has precedence.
    """
    full = (header or "").strip().lower()
    short, _, _ = full.partition("(")
    known = (K.PULL_HEADER_ALIASES.get(form) for form in (full, short.rstrip()))
    return next((field for field in known if field), None)


def header_field(header: Column) -> Column:
    """P3 as a column expression."""
    known = F.create_map(*[F.lit(x) for kv in K.PULL_HEADER_ALIASES.items() for x in kv])
    full = F.lower(py_strip(header))
    return F.coalesce(known[full], known[py_strip(F.substring_index(full, "(", 1))])


def header_plan(headers: Sequence[str]) -> dict[str, int]:
    """field -> position of the column that feeds it; with several matching headers
    the last one wins (even if its value is empty)."""
    plan: dict[str, int] = {}
    for i, h in enumerate(headers):
        f = field_for_header(h)
        if f:
            plan[f] = i
    return plan


def header_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First line of every non-empty file by its path, one job for any number of files.

    Ids increase in read order within a task, so the smallest id of a file's first
    block is its first line. What reaches the driver is metadata: a path and a header
    for each file. Spark reports paths URI-encoded; readers want them plain.
    """
    lines = (spark.read.option("lineSep", "\n").text(list(paths))
             .select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                     F.col("value"), F.monotonically_increasing_id().alias("i"))
             .filter(F.col("b") == 0))
    first = lines.groupBy("f").agg(F.min_by("value", "i").alias("header"))
    return {unquote(r.f): r.header.removeprefix("\ufeff").removesuffix("\r") for r in first.collect()}


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The header record of every file: its first line, or more if a name holds a line end."""
    lines = header_lines(spark, paths)
    open_ = [p for p, line in lines.items() if ends_inside(line, False)]
    if open_:
        rows = file_records(spark, open_).where("first").select("file", "record").collect()
        lines |= {unquote(r.file): r.record.removeprefix("\ufeff") for r in rows}
    return lines


def _csv_rows(spark: SparkSession, paths: Sequence[str], n: int) -> DataFrame:
    """The records below the header, as ``n`` text columns."""
    ddl = ", ".join(f"_c{i} string" for i in range(n))
    records = file_records(spark, paths).where(~F.col("first"))
    return records.select(F.from_csv("record", ddl, {"escape": '"', "mode": "PERMISSIVE"}).alias("r")).select("r.*")


def normalize_pull_rows(df: DataFrame, headers: Sequence[str], report_segment: str,
                        tz: str, fetched_at: str, conversion_type: bool = False) -> DataFrame:
    """Positional columns of one header group -> canonical Pull rows."""
    cols = df.columns
    plan = header_plan(headers)

    def src(field: str) -> Column:
        return F.col(f"`{cols[plan[field]]}`") if field in plan else F.lit(None).cast("string")

    out = [
        F.nullif(py_strip(src("fact_date")), F.lit("")).alias("fact_date_text"),
        *[dim_normalize(src(d)).alias(d) for d in ("media_source", "campaign", "adset", "ad")],
        *[lenient_float_pull(src(m)).alias(m) for m in K.PULL_METRICS],
        F.lit(tz).alias("timezone"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(report_segment).alias("report_segment"),
        F.lit(fetched_at).alias("fetched_at"),
        F.to_json(F.struct(*[F.col(f"`{c}`").alias(h) for c, h in zip(cols, headers)])).alias("source_payload"),
    ]
    if conversion_type:
        ct = [i for i, h in enumerate(headers) if h.strip().lower() == "conversion type"]
        out.append((F.col(f"`{cols[ct[0]]}`") if ct else F.lit(None).cast("string")).alias("conversion_type"))
    rows = df.select(*out).withColumn("fact_date", parse_date("fact_date_text")).drop("fact_date_text")
    # no date, or one that can't be read: the row has no day to count for
    return rows.filter(F.col("fact_date").isNotNull()).select("fact_date", *[c for c in rows.columns if c != "fact_date"])


def pull_csv_scan(spark: SparkSession, paths: Sequence[str], report_segment: str = K.DEFAULT_REPORT_SEGMENT,
                  tz: str = K.DEFAULT_BUSINESS_TZ, fetched_at: str | None = None,
                  conversion_type: bool = False) -> DataFrame:
    """Header CSV files -> canonical Pull rows; rows without a readable date are dropped.

    Quoted fields may hold commas, doubled quotes and line ends. A file is read by as
    many tasks as it has splits. Files whose lines end in a lone carriage return are
    left to Spark's reader, one task each.
    """
    fetched_at = fetched_at or _dt.datetime.now(_dt.timezone.utc).isoformat()
    groups: dict[tuple[bool, tuple[str, ...]], list[str]] = {}
    for p, line in _headers(spark, paths).items():
        if not line.strip():
            continue
        names = list(csv.reader([line] if "\n" in line else line.split("\r")))
        groups.setdefault((len(names) > 1, tuple(names[0])), []).append(p)
    out: DataFrame | None = None
    for (old_lines, headers), ps in groups.items():
        if old_lines:
            df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE")
                  .option("enforceSchema", False).csv(ps))
        else:
            df = _csv_rows(spark, ps, len(headers))
        part = normalize_pull_rows(df, headers, report_segment, tz, fetched_at, conversion_type)
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = ("fact_date date, media_source string, campaign string, adset string, ad string, "
                  + ", ".join(f"{m} double" for m in K.PULL_METRICS)
                  + ", timezone string, currency string, report_segment string, fetched_at string, source_payload string")
        if conversion_type:
            schema += ", conversion_type string"
        out = spark.createDataFrame([], schema)
    return out
