"""Data-quality checks and validation queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.constants import PARITY_KEYS, PARITY_VALUES
from marketlake.functions import nullify_blank


def validate_volume(daily_acq: DataFrame) -> DataFrame:
    """Q1: mart totals per day, newest first."""
    return (daily_acq.groupBy("report_date")
            .agg(F.sum("cost").alias("cost"), F.sum("installs").alias("installs"),
                 F.sum("af_start_trial").alias("af_start_trial"))
            .orderBy(F.col("report_date").desc()))


DUP_KEYS = ("report_date", "app_key", "platform", "media_source", "campaign_id", "adset_id", "ad_id", "country")


def validate_duplicate_keys(daily_acq: DataFrame, keys: Sequence[str] = DUP_KEYS) -> DataFrame:
    """Q2: natural keys (ids not coalesced) present more than once."""
    return (daily_acq.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1).orderBy(F.col("row_count").desc()))


def validate_null_rates(df: DataFrame, date_col: str = "report_date",
                        cols: Sequence[str] = ("campaign", "media_source", "country")) -> DataFrame:
    """Q3: per-day NULL rate of the given columns ("null spikes")."""
    return df.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}_null_rate") for c in cols],
    )


def null_rate_spikes(rates: DataFrame, date_col: str = "report_date", cols: Sequence[str] = ("campaign", "media_source", "country"),
                     days: int = 28, least_days: int = 7, width: float = 3.0, floor: float = 0.05) -> DataFrame:
    """Q3 decision: is a day's NULL rate a spike against the ``days`` calendar days before it?

    ``rates`` has a row a day (``validate_null_rates``). Usual is the median of the earlier
    days' rates, spread their median absolute deviation (times 1.4826: a standard deviation
    where rates are normal). A spike lies above usual by more than ``width`` spreads and more
    than ``floor``. Earlier spikes don't move the median, so a second bad day is still found.
    With fewer than ``least_days`` earlier days nothing is decided (NULL). A row for each
    day and column; days without a date drop out.
    """
    long = rates.where(F.col(date_col).isNotNull()).select(
        date_col, "row_count", F.explode(F.array(*[
            F.struct(F.lit(c).alias("field"), F.col(f"{c}_null_rate").alias("null_rate")) for c in cols])).alias("f")).select(
        date_col, "row_count", "f.*")
    # one window a column over a row a day
    before = Window.partitionBy("field").orderBy(F.unix_date(date_col)).rangeBetween(-days, -1)
    seen = long.withColumn("_past", F.collect_list("null_rate").over(before))
    usual = _median(F.col("_past"))
    told = seen.withColumn("days_before", F.size("_past")).withColumn("usual", usual)
    told = told.withColumn("spread", _median(F.transform("_past", lambda x: F.abs(x - F.col("usual")))))
    bound = F.col("usual") + F.greatest(F.lit(width * 1.4826) * F.col("spread"), F.lit(floor))
    return told.select(date_col, "field", "row_count", "null_rate", "days_before", "usual", "spread",
                       F.when(F.col("days_before") >= least_days, F.col("null_rate") > bound).alias("spike"))


def _median(values: Column) -> Column:
    """Median of an array without NULLs; NULL if it is empty."""
    n = F.size(values)
    ordered = F.array_sort(values)

    def at(k: Column) -> Column:
        return F.get(ordered, k.cast("int"))

    return F.when(n % 2 == 1, at((n - 1) / 2)).otherwise((at(n / 2 - 1) + at(n / 2)) / 2)


def validate_reconcile(a: DataFrame, b: DataFrame, tolerance: float = 1.0,
                       metrics: Sequence[str] = ("spend", "af_start_trial")) -> DataFrame:
    """Q4: per-date totals of ``a`` against ``b`` (both one row per fact_date); a metric is
    within tolerance when both sides exist and |a - b| <= tolerance."""
    la = a.select("fact_date", *[F.col(m).alias("a_" + m) for m in metrics])
    lb = b.select("fact_date", *[F.col(m).alias("b_" + m) for m in metrics])
    j = la.join(lb, "fact_date", "full_outer")
    ok = [F.coalesce(F.abs(F.col("a_" + m) - F.col("b_" + m)) <= F.lit(tolerance), F.lit(False)).alias(m + "_ok")
          for m in metrics]
    return j.select("fact_date", *[F.col(p + m) for m in metrics for p in ("a_", "b_")], *ok)


def validate_top_campaigns(daily_acq: DataFrame, n: int = 50) -> DataFrame:
    """Top campaigns per day by spend (ties broken by date, media source, campaign)."""
    g = daily_acq.groupBy("report_date", "media_source", "campaign").agg(
        F.sum("cost").alias("spend"), F.sum("af_start_trial").alias("start_trials"))
    return g.orderBy(F.col("spend").desc(), F.col("report_date").asc_nulls_last(),
                     F.col("media_source").asc_nulls_last(), F.col("campaign").asc_nulls_last()).limit(n)


# ---------------------------------------------------------------------------
# Export parity
# ---------------------------------------------------------------------------

def _normalised(df: DataFrame, keys: Sequence[str], values: Sequence[str], left: bool) -> DataFrame:
    """Normalised keys ('' / 'None' -> NULL on keys, currency and timezone) and the values as one struct."""
    cols = [nullify_blank(F.col(k).cast("string")).alias(k) if k != "fact_date" else F.col(k) for k in keys]
    vals = [nullify_blank(F.col(v)).alias(v) if v in ("currency", "timezone") else F.col(v) for v in values]
    return df.select(*cols, F.struct(*vals).alias("_v"), F.lit(left).alias("_left"))


def parity_compare(left: DataFrame, right: DataFrame, keys: Sequence[str] = PARITY_KEYS,
                   values: Sequence[str] = PARITY_VALUES) -> DataFrame:
    """Key-level comparison: one row per normalised key with side presence and a mismatch flag.

    Both sides are one tagged union folded by one aggregate; of several rows of a key
    the largest values count (a deterministic stand-in for "the last wins").
    """
    rows = _normalised(left, keys, values, True).unionByName(_normalised(right, keys, values, False))
    lft = F.col("_left")
    g = rows.groupBy(*keys).agg(
        F.count(F.when(lft, 1)).alias("left_rows"), F.count(F.when(~lft, 1)).alias("right_rows"),
        F.max(F.when(lft, F.col("_v"))).alias("_l"), F.max(F.when(~lft, F.col("_v"))).alias("_r"))
    in_l, in_r = F.col("left_rows") > 0, F.col("right_rows") > 0
    return g.select(*keys, in_l.alias("in_left"), in_r.alias("in_right"), "left_rows", "right_rows",
                    (in_l & in_r & ~F.col("_l").eqNullSafe(F.col("_r"))).alias("mismatch"))


def export_parity(left: DataFrame, right: DataFrame, keys: Sequence[str] = PARITY_KEYS,
                  values: Sequence[str] = PARITY_VALUES) -> DataFrame:
    """J7 summary: row counts, unique keys, keys on one side only, metric mismatches, parity_ok."""
    cmp = parity_compare(left, right, keys, values)
    s = cmp.agg(
        F.sum("left_rows").cast("bigint").alias("left_row_count"),
        F.sum("right_rows").cast("bigint").alias("right_row_count"),
        F.count(F.when(F.col("in_left"), 1)).alias("left_unique_keys"),
        F.count(F.when(F.col("in_right"), 1)).alias("right_unique_keys"),
        F.count(F.when(F.col("in_left") & ~F.col("in_right"), 1)).alias("only_left"),
        F.count(F.when(F.col("in_right") & ~F.col("in_left"), 1)).alias("only_right"),
        F.count(F.when(F.col("mismatch"), 1)).alias("metric_mismatches"),
    )
    return s.withColumn("parity_ok", (F.col("only_left") == 0) & (F.col("only_right") == 0)
                        & (F.col("metric_mismatches") == 0))


def parity_samples(left: DataFrame, right: DataFrame, kind: str, n: int = 10,
                   keys: Sequence[str] = PARITY_KEYS, values: Sequence[str] = PARITY_VALUES) -> DataFrame:
    """Sample keys of one kind ('only_left', 'only_right', 'mismatch'), ordered by key."""
    cmp = parity_compare(left, right, keys, values)
    flt: Column = {
        "only_left": F.col("in_left") & ~F.col("in_right"),
        "only_right": F.col("in_right") & ~F.col("in_left"),
        "mismatch": F.col("mismatch"),
    }[kind]
    return cmp.filter(flt).select(*keys).orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)


# J7 over a tree of digests: whole tables > months > dates; rows are read of unequal dates only

def date_digests(df: DataFrame, keys: Sequence[str] = PARITY_KEYS, values: Sequence[str] = PARITY_VALUES) -> DataFrame:
    """A row for each ``fact_date``: rows, unique keys and an order-free digest of its normalised rows.

    The digest is the count, the sum and the exclusive or of 64-bit hashes; it may be stored
    with a table when that is written. Rows of one date are combined in every map task.
    """
    rows = _normalised(df, keys, values, True)
    signed = [F.col(f"_v.{f.name}") + F.lit(0.0) if f.dataType.typeName() == "double" else F.col(f"_v.{f.name}")
              for f in rows.schema["_v"].dataType.fields]  # -0.0 becomes 0.0
    h = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys], *[F.coalesce(c.cast("string"), F.lit("\0")) for c in signed])
    by_key = rows.withColumn("_h", h).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("s"), F.expr("bit_xor(_h)").alias("x"))
    return by_key.groupBy("fact_date").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("unique_keys"), F.sum("s").alias("digest_sum"), F.expr("bit_xor(x)").alias("digest_xor"))


_DIGEST = ("row_count", "unique_keys", "digest_sum", "digest_xor")


def unequal_nodes(left: DataFrame, right: DataFrame, level: str | None) -> DataFrame:
    """Nodes of one level (``year``, ``month`` or None for dates) whose digests differ, from ``date_digests`` of both sides."""
    node = F.col("fact_date") if level is None else F.trunc("fact_date", level)

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(node.alias("node")).agg(
            F.sum("row_count").alias("row_count"), F.sum("unique_keys").alias("unique_keys"), F.sum("digest_sum").alias("digest_sum"),
            F.expr("bit_xor(digest_xor)").alias("digest_xor")).select("node", F.struct(*_DIGEST).alias(tag))

    lft, rgt = side(left, "l"), side(right, "r")
    both = lft.join(rgt, lft.node.eqNullSafe(rgt.node), "full_outer").where(~F.col("l").eqNullSafe(F.col("r")))
    return both.select(F.coalesce(lft.node, rgt.node).alias("node"))


def export_parity_tree(left: DataFrame, right: DataFrame, keys: Sequence[str] = PARITY_KEYS, values: Sequence[str] = PARITY_VALUES,
                       left_digests: DataFrame | None = None, right_digests: DataFrame | None = None) -> DataFrame:
    """``export_parity`` that compares key by key only on dates whose digests differ, with ``unequal_months`` and ``unequal_dates``.

    The list of unequal dates (at most the tables' days) becomes a filter on ``fact_date``, which
    prunes partitions or row groups of stored tables. Digests that aren't given are made of the rows.
    """
    ld = date_digests(left, keys, values) if left_digests is None else left_digests
    rd = date_digests(right, keys, values) if right_digests is None else right_digests
    months = [r.node for r in unequal_nodes(ld, rd, "month").collect()]

    def lies_in(nodes: list, level: str | None) -> Column:
        at = F.col("fact_date") if level is None else F.trunc("fact_date", level)
        known = [n for n in nodes if n is not None]
        dated = F.coalesce(at.isin(known), F.lit(False)) if known else F.lit(False)
        return dated | at.isNull() if None in nodes else dated

    def within(df: DataFrame, nodes: list, level: str | None) -> DataFrame:
        return df.where(lies_in(nodes, level))

    dates = [r.node for r in unequal_nodes(within(ld, months, "month"), within(rd, months, "month"), None).collect()]
    compared = export_parity(within(left, dates, None), within(right, dates, None), keys, values).drop("parity_ok")
    same = ld.where(~lies_in(dates, None))
    # what the equal dates hold, alike on both sides
    sides = [f"{side}_{c}" for side in ("left", "right") for c in ("row_count", "unique_keys")]
    equal = same.agg(*[F.sum(c.split("_", 1)[1]).cast("bigint").alias(c) for c in sides],
                     *[F.lit(0).cast("bigint").alias(c) for c in ("only_left", "only_right", "metric_mismatches")])
    both = compared.select(*equal.columns).unionByName(equal)
    total = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in equal.columns])
    return total.withColumns({
        "unequal_months": F.lit(len(months)).cast("bigint"), "unequal_dates": F.lit(len(dates)).cast("bigint"),
        "parity_ok": (F.col("only_left") == 0) & (F.col("only_right") == 0) & (F.col("metric_mismatches") == 0)})
