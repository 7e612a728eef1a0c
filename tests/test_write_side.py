import datetime as dt

from pyspark.sql import functions as F

from marketlake import constants as K
from marketlake.operators import pull as pull_ops, quality, silver, upserts

from tests.test_silver_gold import PULL_SCHEMA, SILVER_SCHEMA, SRC_SCHEMA, pull_row, silver_row, src_row

D1 = dt.date(2026, 1, 1)


def test_pull_dedupe_keeps_latest_and_distinct_metrics(spark):
    a = pull_row(D1, 5.0)
    b = a[:17] + ("2026-01-05T00:00:00+00:00", 2)           # same row, later fetch
    c = pull_row(D1, 6.0)                                      # equal dims, different metric
    d = (D1, None, "c1", "", "", 3.0, 0.0, 0.0, 5.0, 1.0, 2.0, 1.0, 0.0, 0.0, K.DEFAULT_BUSINESS_TZ, None,
         K.DEFAULT_REPORT_SEGMENT, "2026-01-02", 3)          # NULL dim = '' of a? no: ms differs ('fb')
    df = spark.createDataFrame([a, b, c, d], PULL_SCHEMA)
    out = pull_ops.pull_dedupe(df)
    rows = sorted((r.media_source, r.cost, r.fetched_at) for r in out.collect())
    assert rows == [("", 5.0, "2026-01-02"), ("fb", 5.0, "2026-01-05T00:00:00+00:00"), ("fb", 6.0, "2026-01-01T00:00:00+00:00")]
    again = pull_ops.pull_dedupe(out)  # idempotent
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_cost_preserving_replace(spark):
    d = [D1 + dt.timedelta(days=i) for i in range(3)]
    stored = spark.createDataFrame([pull_row(d[0], 5.0), pull_row(d[1], 5.0), pull_row(d[2], 5.0)], PULL_SCHEMA)
    new = spark.createDataFrame([pull_row(d[0], 0.0)[:17] + ("n", 9), pull_row(d[1], 7.0)[:17] + ("n", 9)], PULL_SCHEMA)
    out = {r.fact_date: r for r in pull_ops.cost_preserving_replace(stored, new, d[0], d[2]).collect()}
    assert (out[d[0]].cost, out[d[0]].fetched_at) == (5.0, "2026-01-01T00:00:00+00:00")  # stored kept
    assert (out[d[1]].cost, out[d[1]].fetched_at) == (7.0, "n")                           # replaced
    assert out[d[2]].cost == 5.0                                                          # untouched


def test_cost_preserving_replace_never_zeroes_a_costed_day(spark):
    from marketlake import catalog
    inp = catalog.Inputs(spark, "/root/testdata/sf0.001")
    out = pull_ops.cost_preserving_replace(inp.pull, inp.pull_new, catalog.REPLACE_FROM, catalog.REPLACE_TO)
    scope = (F.col("report_segment") == K.DEFAULT_REPORT_SEGMENT) & (F.col("timezone") == K.DEFAULT_BUSINESS_TZ)
    before = pull_ops.dates_with_cost(inp.pull.filter(scope))
    after = pull_ops.dates_with_cost(out.filter(scope))
    assert before.join(after, "fact_date", "left_anti").count() == 0


def test_reattr_replace_noop_on_empty(spark):
    stored = spark.createDataFrame([pull_row(D1, 5.0)], PULL_SCHEMA)
    empty = stored.limit(0)
    assert pull_ops.reattr_replace(stored, empty, D1, D1) is stored


def test_retarget_rewrite(spark):
    rows = spark.createDataFrame([pull_row(D1, 5.0)[:4] + ("x",) + pull_row(D1, 5.0)[5:] + ("Re-engagement",)],
                                 PULL_SCHEMA + ", ct string")
    r = pull_ops.retarget_rewrite(rows, "ct").first()
    assert (r.ad, r.cost, r.installs, r.report_segment) == ("Re-engagement", None, 3.0, K.DEFAULT_REPORT_SEGMENT + "_reattr")
    blank = spark.createDataFrame([pull_row(D1, 5.0) + (" none ",)], PULL_SCHEMA + ", ct string")
    assert pull_ops.retarget_rewrite(blank, "ct").first().ad == "retargeting"


def test_export_parity_normalises_keys(spark):
    left = spark.createDataFrame([silver_row(D1, 5.0, ms=""), silver_row(D1, 6.0, ms="fb")], SILVER_SCHEMA)
    right = spark.createDataFrame([silver_row(D1, 5.0, ms="None"), silver_row(D1, 7.0, ms="fb")], SILVER_SCHEMA)
    r = quality.export_parity(left, right).first()
    assert (r.only_left, r.only_right, r.metric_mismatches, r.parity_ok) == (0, 0, 1, False)
    same = quality.export_parity(left, left).first()
    assert same.parity_ok and same.left_unique_keys == 2
    samples = quality.parity_samples(left, right, "mismatch").collect()
    assert [s.media_source for s in samples] == ["fb"]


def test_source_upsert_last_writer(spark):
    old = spark.createDataFrame([src_row("k", 1.0)], SRC_SCHEMA).withColumn("ingest_seq", F.lit(1))
    new = spark.createDataFrame([src_row("k", 2.0, ms=None), src_row("k", 3.0)], SRC_SCHEMA).withColumn("ingest_seq", F.lit(2))
    out = {r.media_source: r.metric_value for r in upserts.source_upsert(old, new).collect()}
    assert out == {"fb": 3.0, None: 2.0}


def test_coalesce_upsert(spark):
    def with_ad(r):
        return r[:5] + ("ad1",) + r[6:]

    old = spark.createDataFrame([with_ad(silver_row(D1, 5.0)), with_ad(silver_row(D1, 1.0, ms=None))], SILVER_SCHEMA)
    new_row = list(with_ad(silver_row(D1, 8.0)))
    new_row[13] = None  # arpu NULL -> keep old
    new_row[8] = None   # spend NULL -> keep old
    new_row[16] = "2026-03-01"
    new = spark.createDataFrame([tuple(new_row), with_ad(silver_row(D1, 2.0, ms=None))], SILVER_SCHEMA)
    out = upserts.coalesce_upsert(old, new).collect()
    fb = [r for r in out if r.media_source == "fb"]
    assert len(fb) == 1 and fb[0].spend == 5.0 and fb[0].fetched_at == "2026-03-01"
    assert len([r for r in out if r.media_source is None]) == 2  # NULL keys never match


def test_silver_window_rebuild_empties_dates(spark):
    d2 = D1 + dt.timedelta(days=1)
    stored = spark.createDataFrame([silver_row(D1, 5.0), silver_row(d2, 5.0),
                                    silver_row(D1 - dt.timedelta(days=5), 1.0)], SILVER_SCHEMA)
    rebuilt = spark.createDataFrame([silver_row(D1, 9.0)], SILVER_SCHEMA)
    out = {r.fact_date: r.spend for r in silver.silver_window_rebuild(stored, rebuilt, D1, d2).collect()}
    assert out == {D1: 9.0, D1 - dt.timedelta(days=5): 1.0}


def test_grain_fallback_picks_first_grouping(spark):
    rows = [src_row("k", 1.0), src_row("k", 2.0, adset=None)]
    df = spark.createDataFrame(rows, SRC_SCHEMA).withColumn("grain_rank", F.when(F.col("adset").isNull(), 1).otherwise(0))
    assert [r.metric_value for r in silver.grain_fallback(df).collect()] == [1.0]


def test_backfill_attribution_model(spark):
    def with_ad(r):
        return r[:5] + ("ad1",) + r[6:]

    rows = [with_ad(silver_row(D1, 5.0)), with_ad(silver_row(D1, 6.0, model="activity")), silver_row(D1, 1.0, ms=None),
            silver_row(D1, 2.0, ms=None, model="activity")]
    df = spark.createDataFrame(rows, SILVER_SCHEMA).withColumn(
        "ingest_seq", F.when(F.col("attribution_model") == "ltv", 0).otherwise(1)).drop("attribution_model")
    out = silver.backfill_attribution_model(df).collect()
    assert sorted((r.media_source or "-", r.spend, r.attribution_model) for r in out) == [
        ("-", 1.0, "ltv"), ("-", 2.0, "ltv"), ("fb", 5.0, "ltv")]
