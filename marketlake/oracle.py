"""DuckDB SQL for every registered query (the correctness oracle).

Relational forms of this library, chosen to differ from the Spark operators so
that a shared mistake shows: the preferred row of a key is ``max_by`` over a row
value, two-sided day and source comparisons are one tagged union folded by one
``GROUP BY`` with filters (no outer joins), sums per event are generated from one
list. Only names, label values and the order of floating-point steps are shared.

``sql(name)`` returns a complete statement: the views it needs, in order, then
the final SELECT.
"""

from __future__ import annotations

from marketlake import constants as K
from marketlake.sources.adapters import AD_GRAIN_FIRST, MCP_KPIS

LA = K.DEFAULT_BUSINESS_TZ
EVENTS = ("af_start_trial", "af_subscribe", "af_tutorial_completion", "rc_trial_converted_event")
REATTR = K.DEFAULT_REPORT_SEGMENT + K.REATTR_SEGMENT_SUFFIX
WINDOW = "BETWEEN DATE '1996-01-01' AND DATE '1996-03-31'"

#: view -> (views it reads, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}
#: query -> (views it reads, statement)
FINAL: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, needs: str, body: str) -> None:
    VIEWS[name] = (tuple(needs.split()), body)


def query(name: str, needs: str, body: str | None = None) -> None:
    FINAL[name] = (tuple(needs.split()), body or f"FROM {needs}")


def names() -> list[str]:
    return list(FINAL)


def sql(name: str) -> str:
    needs, body = FINAL[name]
    order: list[str] = []

    def visit(v: str) -> None:
        if v not in order:
            for d in VIEWS[v][0]:
                visit(d)
            order.append(v)

    for v in needs:
        visit(v)
    return "WITH " + ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v][1]})" for v in order) + f"\nSELECT * FROM ({body}) answer"


def each(template: str, columns, sep: str = ", ") -> str:
    """``template`` with ``@`` as each column."""
    return sep.join(template.replace("@", c) for c in columns)


def total(column: str, name: str | None = None) -> str:
    return f"coalesce(sum({column}), 0) AS {name or column}"


def per(numerator: str, denominator: str) -> str:
    """A ratio where its denominator is positive, else NULL."""
    return f"if({denominator} > 0, {numerator} / {denominator}, NULL)"


# ---- inputs (the adapters' rules as SQL) -------------------------------------------

view("pull", "", f"""
SELECT l_shipdate::DATE AS fact_date, if(l_suppkey % 5 = 0, '', 'ms_' || (l_suppkey % 5)) AS media_source,
  'cmp_' || (l_partkey % 7) AS campaign, '' AS adset, '' AS ad,
  l_quantity AS installs, l_quantity * 3 AS clicks, l_quantity * 100 AS impressions,
  if(day(l_shipdate) > 24, 0, floor(l_extendedprice))::DOUBLE AS cost,
  floor(l_extendedprice * l_discount)::DOUBLE AS revenue,
  if(l_returnflag = 'R', NULL, l_linenumber::DOUBLE) AS af_start_trial,
  (l_returnflag = 'N')::INT::DOUBLE AS af_subscribe, (l_linestatus = 'F')::INT::DOUBLE AS rc_trial_converted_event,
  (l_linenumber % 3)::DOUBLE AS af_tutorial_completion,
  if(l_linenumber = 7 OR day(l_shipdate) = 13, 'UTC', '{LA}') AS timezone, NULL::VARCHAR AS currency,
  if(l_linenumber = 6, '{REATTR}', '{K.DEFAULT_REPORT_SEGMENT}') AS report_segment,
  format('2026-01-0{{}}T00:00:00+00:00', l_linenumber) AS fetched_at, l_orderkey * 10 + l_linenumber AS ingest_seq
FROM lineitem""")

_SOURCE = "CASE o_custkey % 6 WHEN 0 THEN {0} WHEN 5 THEN 'ms_only_mcp' ELSE 'ms_' || (o_custkey % 6) END AS media_source"
view("mcp", "", f"""
SELECT o_orderdate::DATE - (o_orderkey % 3)::INT AS fetch_window_from, o_orderdate::DATE AS fetch_window_to,
  if((n = {AD_GRAIN_FIRST} AND o_orderkey % 10 = 0) OR (n > {AD_GRAIN_FIRST} AND o_orderkey % 13 = 0), NULL, o_orderdate::DATE) AS fact_date,
  {_SOURCE.format('NULL')}, 'cmp_' || (o_orderkey % 7) AS campaign,
  if(n < {AD_GRAIN_FIRST}, 'as_' || (o_orderkey % 4), NULL) AS adset, if(n < {AD_GRAIN_FIRST}, NULL, 'ad_' || (o_orderkey % 9)) AS ad,
  {list(MCP_KPIS)}[n + 1] AS kpi_name, ((o_orderkey + n) % 11)::DOUBLE AS metric_value, (o_custkey % 50)::DOUBLE AS installs,
  if(o_orderstatus = 'P', 0, floor(o_totalprice / 100))::DOUBLE AS cost, 'UTC' AS timezone, 'USD' AS currency,
  '2026-02-01T' || lpad(o_orderkey::VARCHAR, 9, '0') AS fetched_at
FROM orders, range({len(MCP_KPIS)}) AS kpis(n)""")

view("ad_map_rows", "", f"""
SELECT {_SOURCE.format("''")}, 'cmp_' || (o_orderkey % 7) AS campaign, 'as_' || (o_orderkey % 4) AS adset,
  if(o_orderkey % 9 % 2 = 0, 'ad_', 'other_') || (o_orderkey % 9) AS ad, (o_custkey % 50)::DOUBLE AS installs, o_orderkey AS ingest_seq
FROM orders""")


def _raw(only: str, country: str, fields: str) -> str:
    return f"""
SELECT l_shipdate::DATE AS _extract_date, '{{"app_id":' || if(l_orderkey % 9 = 0, 'null', '"app_1"')
  || ',"app_name":"App One","platform":"' || if(l_orderkey % 2 = 0, 'ios', 'android')
  || '","media_source":' || if(l_orderkey % 8 = 0, 'null', '"ms_' || (l_orderkey % 5) || '"')
  || format(',"campaign":"Camp {{}}","campaign_id":"{{}}"', l_orderkey % 7, l_orderkey % 7)
  || ',"adset":"as","adset_id":"1","ad":"ad","ad_id":"2","country":"' || CASE WHEN {only} THEN '{country}' WHEN l_orderkey % 3 = 0 THEN 'US' ELSE 'DE' END
  || '",' || {fields} || '}}' AS _payload
FROM lineitem"""


view("raw_perf", "", _raw("l_linenumber > 3", "FR", """format('"impressions":{},"clicks":"{}","installs":{},"cost":{}',
    l_quantity::INT * 100, if(l_linenumber = 2, 'n/a', l_linenumber::VARCHAR), l_linenumber % 3, floor(l_extendedprice)::BIGINT)"""))
view("raw_events", "", _raw("l_linenumber < 3", "IT", """format('"event_name":"{}","event_count":{},"revenue":{}',
    ['af_start_trial', 'af_subscribe', 'af_tutorial_completion', 'rc_trial_converted_event'][l_linenumber % 4 + 1],
    l_linenumber, floor(l_extendedprice * l_discount)::BIGINT)"""))

_AGAIN = "'2026-01-31T00:00:00+00:00' AS fetched_at, ingest_seq + 1000000000 AS ingest_seq"
view("pull_refetch", "pull", f"FROM pull UNION ALL SELECT * REPLACE ({_AGAIN}) FROM pull WHERE ingest_seq % 4 = 0")
view("pull_new", "pull", f"""
SELECT * REPLACE (if(day(fact_date) % 2 = 0, 0, cost + 1)::DOUBLE AS cost, {_AGAIN}) FROM pull
WHERE fact_date {WINDOW} AND day(fact_date) % 5 <> 0 AND timezone = '{LA}' AND report_segment = '{K.DEFAULT_REPORT_SEGMENT}'""")

# ---- silver --------------------------------------------------------------------------

_IS_AD, _IS_ACTIVITY = "starts_with(kpi_name, 'ad_')", "ends_with(kpi_name, '_activity')"
_MODEL = f"if({_IS_ACTIVITY}, 'activity', 'ltv') AS attribution_model"
_BASE = f"if({_IS_ACTIVITY}, left(kpi_name, -9), kpi_name)"
_KEPT = ("metric_value", "installs", "cost", "currency", "fetched_at")


def preferred(source: str, dims: str, where: str) -> str:
    """The narrowest window's latest row of each (date, dims, KPI)."""
    return f"""
SELECT * EXCLUDE (best), unnest(best) FROM (
  SELECT fact_date, {dims}, kpi_name,
    max_by({{{each("'@': @", _KEPT)}}}, row(fetch_window_from - fetch_window_to, fetched_at)) AS best
  FROM {source} WHERE fact_date IS NOT NULL AND {where} GROUP BY ALL)"""


def facts(rows: str) -> str:
    return f"""
SELECT fact_date, '{K.SRC_MCP}' AS source_system, media_source, campaign, adset, ad, {_MODEL},
  coalesce(max(installs), 0) AS installs, coalesce(max(cost), 0) AS spend,
  {each(f"coalesce(sum(metric_value) FILTER ({_BASE} = '@_unique_users'), 0) AS @", EVENTS)},
  max(metric_value) FILTER (kpi_name = 'arpu_ltv') AS arpu_ltv,
  max(currency) AS currency, '{LA}' AS timezone, max(fetched_at) AS fetched_at
FROM {rows} GROUP BY ALL"""


_ADSET_DIMS, _AD_DIMS = "media_source, campaign, adset, ad", "media_source, campaign, ad"
view("best_adset", "mcp", preferred("mcp", _ADSET_DIMS, f"NOT {_IS_AD}"))
view("best_ad", "mcp", preferred("mcp", _AD_DIMS, _IS_AD))
view("silver", "best_adset", facts("best_adset"))
view("ad_map", "ad_map_rows", f"""
SELECT media_source, campaign, max_by(adset, ingest_seq) AS adset, ad, max_by(installs, ingest_seq) AS installs
FROM ad_map_rows GROUP BY media_source, campaign, ad""")
# events and performance of an ad day in one group: lists of both, a row for each model that has events
view("ad_days", "best_ad", f"""
SELECT fact_date, {_AD_DIMS}, coalesce(max(installs) FILTER (perf), 0) AS installs, coalesce(max(cost) FILTER (perf), 0) AS spend,
  max(currency) FILTER (perf) AS currency, unnest(list(DISTINCT attribution_model) FILTER (NOT perf)) AS attribution_model,
  list({{'m': attribution_model, 'b': base, 'v': metric_value, 'f': fetched_at}}) FILTER (NOT perf) AS events
FROM (SELECT *, kpi_name = 'ad_performance' AS perf, {_MODEL}, {_BASE} AS base FROM best_ad) GROUP BY fact_date, {_AD_DIMS}""")
_EVENT_SUM = "list_sum([e.v FOR e IN events IF e.m = attribution_model AND e.b = 'ad_@_unique_users'])"
view("ad_rows", "ad_days", f"""
SELECT * EXCLUDE (events), {each(f"coalesce({_EVENT_SUM}, 0)::DOUBLE AS @", EVENTS)},
  list_max([e.f FOR e IN events IF e.m = attribution_model]) AS fetched_at
FROM ad_days""")
view("mapped", "ad_rows ad_map", f"""
SELECT r.*, coalesce((SELECT adset FROM ad_map m WHERE (m.media_source, m.campaign, m.ad) = (r.media_source, r.campaign, r.ad)), '') AS adset
FROM ad_rows r""")
view("silver_ad", "mapped", f"""
SELECT fact_date, '{K.SRC_MCP_AD}' AS source_system, media_source, campaign, adset, ad, attribution_model, installs, spend,
  {', '.join(EVENTS)}, currency, '{LA}' AS timezone, fetched_at FROM mapped""")

query("marketing_fact_daily", "silver")
query("marketing_fact_ad", "silver_ad")
query("map_upsert", "ad_map")
query("canonical_adset_rows", "best_adset")
query("canonical_ad_rows", "best_ad")
query("ad_perf_join", "ad_rows", f"SELECT fact_date, {_AD_DIMS}, attribution_model, installs, spend, currency FROM ad_rows")
query("ad_map_lookup", "mapped", f"SELECT fact_date, {_AD_DIMS}, attribution_model, adset FROM mapped")
query("adset_resolve", "silver_ad", "SELECT fact_date, media_source, campaign, adset, ad, spend, installs FROM silver_ad WHERE attribution_model = 'ltv'")

# ---- gold: day totals ------------------------------------------------------------------

_DAY = ("installs", "spend", *EVENTS)
_PULL_DAY = f"SELECT fact_date, {total('installs')}, {total('cost', 'spend')}, {', '.join(map(total, EVENTS))}, {total('revenue')}, max(fetched_at) AS fetched_at FROM pull WHERE timezone = '{LA}' GROUP BY fact_date"


def _mcp_day(model: str) -> str:
    return f"SELECT fact_date, {', '.join(map(total, _DAY))}, max(fetched_at) AS fetched_at FROM silver WHERE attribution_model = '{model}' GROUP BY fact_date"


def _sides(model: str) -> str:
    """One row a day: both sides as structs (NULL where a side has no such day), and whether Pull wins."""
    return f"""
SELECT *, coalesce(p.spend, 0) > 0 OR (p IS NOT NULL AND coalesce(m.spend, 0) = 0) AS takes_pull FROM (
  SELECT fact_date, any_value(day) FILTER (side = 'p') AS p, any_value(day) FILTER (side = 'm') AS m
  FROM (SELECT 'p' AS side, fact_date, {{{each("'@': @", (*_DAY, 'revenue', 'fetched_at'))}}} AS day FROM ({_PULL_DAY})
        UNION ALL
        SELECT 'm', fact_date, {{{each("'@': @", _DAY)}, 'revenue': NULL::DOUBLE, 'fetched_at': fetched_at}} FROM ({_mcp_day(model)}))
  GROUP BY fact_date)"""


def _totals(model: str) -> str:
    src = K.SRC_MCP + ("" if model == "ltv" else "_activity")
    revenue = "coalesce(p.revenue, 0) AS revenue," if model == "ltv" else ""
    return f"""
SELECT *, {per('spend', 'af_subscribe')} AS cac FROM (
  SELECT fact_date, '{LA}' AS timezone, '{model}' AS attribution_model,
    {each('coalesce(if(takes_pull, p, m).@, 0) AS @', _DAY)}, {revenue}
    if(takes_pull, '{K.SRC_PULL}', '{src}') AS primary_source, if(takes_pull, 'high', 'medium') AS source_confidence,
    coalesce(p.fetched_at, m.fetched_at) AS fetched_at
  FROM days_{model})"""


for _m in ("ltv", "activity"):
    view(f"days_{_m}", "pull silver", _sides(_m))
view("growth_daily_totals", "days_ltv", _totals("ltv"))
view("activity_daily_totals", "days_activity", _totals("activity"))
view("growth_weekly_totals", "growth_daily_totals", f"""
SELECT *, {per('spend', 'af_subscribe')} AS cac, {per('spend', 'af_start_trial')} AS cost_per_af_start_trial FROM (
  SELECT strftime(fact_date, '%Y-W%W') AS year_week, min(fact_date) AS week_start, max(fact_date) AS week_end,
    'ltv' AS attribution_model, {each('sum(@) AS @', ('installs', 'spend', 'af_start_trial', 'af_subscribe', 'revenue'))},
    'growth_daily_totals' AS source_layer, 'high' AS source_confidence
  FROM growth_daily_totals GROUP BY ALL)""")
view("growth_campaign_daily", "pull", f"""
SELECT *, {per('spend', 'installs')} AS cost_per_install, {per('spend', 'af_start_trial')} AS cost_per_trial,
  {per('spend', 'af_subscribe')} AS cost_per_subscriber FROM (
  SELECT fact_date, '{LA}' AS timezone, 'ltv' AS attribution_model, media_source, campaign, {total('cost', 'spend')},
    {', '.join(map(total, ('installs', 'revenue', 'clicks', 'impressions', *EVENTS)))},
    '{K.SRC_PULL}' AS primary_source, 'high' AS source_confidence, max(fetched_at) AS fetched_at
  FROM pull WHERE timezone = '{LA}' GROUP BY ALL)""")

query("source_priority_join", "days_ltv", "SELECT fact_date, p.spend AS pull_spend, m.spend AS own_spend, p IS NOT NULL AS pull_present, takes_pull FROM days_ltv")
query("pull_day", "pull", _PULL_DAY)
query("mcp_day", "silver", _mcp_day("ltv"))

# ---- gold: scaling to Pull's total of a source and day -----------------------------------

_SCALED = ("spend", "installs", "af_start_trial", "af_subscribe")


def _details(rows: str, dims: str, model: str) -> str:
    return f"""
SELECT fact_date, {dims}, {', '.join(map(total, _DAY))}, max(currency) AS currency, max(fetched_at) AS fetched_at
FROM {rows} WHERE attribution_model = '{model}' GROUP BY ALL"""


def _shares(detail: str) -> str:
    """Own and Pull totals of each (day, source), folded out of one tagged union."""
    return f"""
SELECT fact_date, media_source, {each("sum(@) FILTER (own) AS own_@, sum(@) FILTER (NOT own) AS pull_@", _SCALED)}
FROM (SELECT true AS own, fact_date, media_source, {', '.join(_SCALED)} FROM {detail}
      UNION ALL
      SELECT false, fact_date, media_source, {each('coalesce(@, 0)', ('cost', 'installs', 'af_start_trial', 'af_subscribe'))} FROM pull WHERE timezone = '{LA}')
WHERE media_source IS NOT NULL GROUP BY ALL"""


def _scaled(detail: str, dims: str, model: str, label: str) -> str:
    return f"""
SELECT *, {per('spend', 'installs')} AS cost_per_install, {per('spend', 'af_start_trial')} AS cost_per_trial,
  {per('spend', 'af_subscribe')} AS cost_per_subscriber FROM (
  SELECT fact_date, '{LA}' AS timezone, '{model}' AS attribution_model, {dims},
    {each('d.@ * coalesce(s.pull_@ / nullif(s.own_@, 0), 1) AS @', _SCALED)},
    d.rc_trial_converted_event, d.af_tutorial_completion, d.currency,
    '{label}' || if(s.pull_spend IS NULL, '_raw', '_scaled') AS primary_source,
    if(s.pull_spend IS NULL, 'medium', 'high') AS source_confidence, d.fetched_at
  FROM {detail} d LEFT JOIN shares_{detail} s USING (fact_date, media_source))"""


def _register(name: str, rows: str, dims: str, model: str, base: str) -> None:
    view(f"d_{name}", rows, _details(rows, dims, model))
    view(f"shares_d_{name}", f"d_{name} pull", _shares(f"d_{name}"))
    view(name, f"d_{name} shares_d_{name}", _scaled(f"d_{name}", dims, model, base + ("" if model == "ltv" else "_activity")))


_register("growth_adset_daily", "silver", "media_source, campaign, adset", "ltv", K.SRC_MCP)
_register("activity_adset_daily", "silver", "media_source, campaign, adset", "activity", K.SRC_MCP)
_register("activity_campaign_daily", "silver", "media_source, campaign", "activity", K.SRC_MCP)
_register("growth_ad_daily", "silver_ad", _ADSET_DIMS, "ltv", K.SRC_MCP_AD)
_register("activity_ad_daily", "silver_ad", _ADSET_DIMS, "activity", K.SRC_MCP_AD)

query("scale_join", "d_growth_adset_daily shares_d_growth_adset_daily", """
SELECT fact_date, media_source, campaign, adset, d.spend, own_spend, pull_spend, d.installs, own_installs, pull_installs
FROM d_growth_adset_daily d LEFT JOIN shares_d_growth_adset_daily USING (fact_date, media_source)""")

view("growth_fact_rows", "pull silver", f"""
SELECT fact_date, '{K.SRC_PULL}' AS source_system, 'ltv' AS attribution_model, media_source, campaign, adset, ad, installs,
  cost AS spend, {', '.join(EVENTS)}, revenue, currency, timezone, fetched_at, 'high' AS source_confidence
FROM pull WHERE timezone = '{LA}'
UNION ALL BY NAME
SELECT * EXCLUDE (arpu_ltv), 'experimental' AS source_confidence FROM silver""")
view("growth_breakdowns", "silver", f"""
SELECT * EXCLUDE (source_system), {per('coalesce(spend, 0)', 'af_subscribe')} AS cac, '{K.SRC_MCP}' AS primary_source,
  'experimental' AS source_confidence, '{K.BREAKDOWN_CAVEAT}' AS caveat FROM silver""")

GOLD = ("growth_fact_rows", "growth_daily_totals", "growth_breakdowns", "growth_weekly_totals", "growth_campaign_daily",
        "growth_adset_daily", "growth_ad_daily", "activity_daily_totals", "activity_campaign_daily", "activity_adset_daily",
        "activity_ad_daily")
for _g in GOLD:
    query(_g, _g)
query("gold_refresh", " ".join(GOLD), " UNION ALL ".join(
    f"SELECT '{g}' AS dataset, count(*) AS row_count, round(sum(spend), 2) AS spend, round(sum(installs), 2) AS installs, sum(af_tutorial_completion_) AS tutorials "
    f"FROM (SELECT *, {'0.0' if g == 'growth_weekly_totals' else 'af_tutorial_completion'} AS af_tutorial_completion_ FROM {g})" for g in GOLD))

# ---- warehouse path ------------------------------------------------------------------------

_DIMS = ("platform", "media_source", "campaign", "campaign_id", "adset", "adset_id", "ad", "ad_id", "country")
_TEXT, _NUMBER = "_payload->>'@' AS @", "try_cast(_payload->>'@' AS DOUBLE) AS @"
view("stg_perf", "raw_perf", f"""SELECT _extract_date AS report_date, {each(_TEXT, ('app_id', 'app_name', *_DIMS))},
  {each(_NUMBER, ('impressions', 'clicks', 'installs', 'cost'))} FROM raw_perf""")
view("stg_events", "raw_events", f"""SELECT _extract_date AS report_date, {each(_TEXT, ('app_id', 'app_name', *_DIMS, 'event_name'))},
  {each(_NUMBER, ('event_count', 'revenue'))} FROM raw_events""")
_APP = f"report_date, coalesce(app_id, app_name) AS app_key, {', '.join(_DIMS)}"
view("int_perf", "stg_perf", f"SELECT {_APP}, {', '.join(map(total, ('impressions', 'clicks', 'installs', 'cost')))} FROM stg_perf GROUP BY ALL")
view("int_events", "stg_events", f"SELECT {_APP}, event_name, {total('event_count')}, {total('revenue')} FROM stg_events GROUP BY ALL")
_KEYS = f"report_date, app_key, {', '.join(_DIMS)}"
view("ev_pivot", "int_events", f"""
SELECT {_KEYS}, {each("coalesce(sum(event_count) FILTER (event_name = '@'), 0) AS @", EVENTS)}, {total('revenue')}
FROM int_events GROUP BY ALL""")
# a mart row is a match key with both sides' rows; a side's dims where it has them
_MATCH = ("report_date", "app_key", "coalesce(platform, '')", "coalesce(media_source, '')", "coalesce(campaign_id, campaign, '')",
          "coalesce(adset_id, adset, '')", "coalesce(ad_id, ad, '')", "coalesce(country, '')")
_PERF_V, _EVENT_V = ("impressions", "clicks", "installs", "cost"), (*EVENTS, "revenue")
_SIDE = f"""SELECT {{{each("'@': @", ('report_date', 'app_key', *_DIMS))}}} AS k, [{each('(@)::VARCHAR', _MATCH)}] AS key"""
_COST_PER = each("if(coalesce(@, 0) = 0, NULL, cost / @) AS cost_per_@", ("installs", "af_start_trial", "af_subscribe")).replace("cost_per_installs", "cost_per_install")
view("daily_acq", "int_perf ev_pivot", f"""
SELECT {each('coalesce(p.k.@, e.k.@) AS @', ('report_date', 'app_key', *_DIMS))},
  {each('coalesce(p.v.@, 0) AS @', _PERF_V)}, {each('coalesce(e.v.@, 0) AS @', _EVENT_V)},
  {each("if(coalesce(@, 0) = 0, NULL, p.v.cost / @) AS cost_per_@", ('installs', 'af_start_trial', 'af_subscribe')).replace('cost_per_installs', 'cost_per_install')}
FROM (
  SELECT unnest(if(len(ps) = 0, [NULL], ps)) AS p, es FROM (
    SELECT coalesce(list(side) FILTER (perf), []) AS ps, coalesce(list(side) FILTER (NOT perf), []) AS es FROM (
      SELECT true AS perf, key, {{'k': k, 'v': {{{each("'@': @", _PERF_V)}, {each("'@': NULL::DOUBLE", _EVENT_V)}}}}} AS side FROM ({_SIDE}, {', '.join(_PERF_V)} FROM int_perf)
      UNION ALL
      SELECT false, key, {{'k': k, 'v': {{{each("'@': NULL::DOUBLE", _PERF_V)}, {each("'@': @", _EVENT_V)}}}}} FROM ({_SIDE}, {', '.join(_EVENT_V)} FROM ev_pivot))
    GROUP BY key, if(list_contains(key, NULL), uuid(), NULL)))
, LATERAL (SELECT unnest(if(len(es) = 0, [NULL], es)) AS e)""")
_SUMS = (*_PERF_V, *_EVENT_V)


def _rollup(unit: str, name: str) -> str:
    return f"""
SELECT *, {_COST_PER} FROM (
  SELECT date_trunc('{unit}', report_date)::DATE AS {name}, app_key, {', '.join(_DIMS)}, {each('sum(@) AS @', _SUMS)} FROM daily_acq GROUP BY ALL)"""


view("weekly_acq", "daily_acq", _rollup("week", "week_start"))
view("monthly_acq", "daily_acq", _rollup("month", "month_start"))
for _q, _v in (("stage_performance", "stg_perf"), ("stage_events", "stg_events"), ("daily_event_metrics", "int_events"),
               ("daily_performance_metrics", "int_perf"), ("event_pivot", "ev_pivot"), ("daily_acquisition", "daily_acq"),
               ("weekly_acquisition", "weekly_acq"), ("monthly_acquisition", "monthly_acq")):
    query(_q, _v)
query("mart_full_outer", "daily_acq", f"SELECT {_KEYS}, cost, af_start_trial FROM daily_acq")

query("validate_volume", "daily_acq", f"SELECT report_date, {each('sum(@) AS @', ('cost', 'installs', 'af_start_trial'))} FROM daily_acq GROUP BY ALL")
_DUP = "report_date, app_key, platform, media_source, campaign_id, adset_id, ad_id, country"
query("validate_duplicate_keys", "daily_acq", f"""
SELECT {_DUP}, count(*) AS row_count FROM (FROM daily_acq UNION ALL FROM daily_acq WHERE day(report_date) % 7 = 0)
GROUP BY ALL HAVING row_count > 1""")
query("validate_null_rates", "daily_acq", f"""
SELECT report_date, count(*) AS row_count, {each('avg((@ IS NULL)::INT) AS @_null_rate', ('campaign', 'media_source', 'country'))}
FROM daily_acq GROUP BY ALL""")
view("null_rates", "daily_acq", """
SELECT report_date, count(*) AS row_count, unnest(['campaign', 'media_source', 'country']) AS field,
  unnest([avg((campaign IS NULL OR broken)::INT), avg((media_source IS NULL)::INT), avg((country IS NULL OR broken)::INT)]) AS null_rate
FROM (SELECT *, coalesce((report_date - DATE '1970-01-01') % 45 = 0 AND length(media_source) > 0 AND app_key IS NOT NULL, false) AS broken FROM daily_acq)
WHERE report_date IS NOT NULL GROUP BY report_date""")
query("null_rate_spikes", "null_rates", """
SELECT *, if(days_before >= 7, null_rate > usual + greatest(3 * 1.4826 * spread, 0.05), NULL) AS spike FROM (
  SELECT *, count(*) OVER w::INT AS days_before, median(null_rate) OVER w AS usual, mad(null_rate) OVER w AS spread FROM null_rates
  WINDOW w AS (PARTITION BY field ORDER BY report_date RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))""")
query("validate_top_campaigns", "daily_acq", """
SELECT report_date, media_source, campaign, sum(cost) AS spend, sum(af_start_trial) AS start_trials FROM daily_acq GROUP BY ALL
ORDER BY spend DESC, report_date NULLS LAST, media_source NULLS LAST, campaign NULLS LAST LIMIT 50""")
query("validate_reconcile", "days_ltv", f"""
SELECT fact_date, {each('m.@ AS a_@, p.@ AS b_@, coalesce(abs(m.@ - p.@) <= 1, false) AS @_ok', ('spend', 'af_start_trial'))} FROM days_ltv""")

# ---- reports -------------------------------------------------------------------------------

_REPORT = f"{', '.join(map(total, ('spend', 'af_subscribe', 'af_start_trial', 'installs')))}"
_SPAN = "DATE '1990-01-01' AS date_from, DATE '2030-12-31' AS date_to"


def _report(by: str, order: str = "") -> str:
    return f"SELECT *, {per('spend', 'af_subscribe')} AS cac FROM (SELECT {by}, {_REPORT} FROM silver GROUP BY ALL) {order}"


query("report_summary", "silver", _report(_SPAN))
query("report_daily_cac", "silver", _report("fact_date"))
query("report_weekly_cac", "silver", _report("strftime(fact_date, '%Y-W%W') AS year_week, min(fact_date) AS week_start, max(fact_date) AS week_end"))
for _q, _c, _from in (("top_media", "media_source", "silver"), ("top_campaigns", "campaign", "silver"), ("top_adsets", "adset", "silver"),
                      ("top_ads", "ad", "silver_ad")):
    query(_q, _from, _report(f"coalesce({_c}, '(unknown)') AS entity", "ORDER BY af_subscribe DESC, spend DESC, entity LIMIT 10").replace("FROM silver", f"FROM {_from}"))
query("growth_totals_summary", "growth_daily_totals", f"""
SELECT *, if(af_start_trial <> 0, spend / af_start_trial, NULL) AS cost_per_trial, if(af_subscribe <> 0, spend / af_subscribe, NULL) AS cac_subscribe FROM (
  SELECT {_SPAN}, count(*) AS day_count, {', '.join(map(total, ('installs', 'spend', 'af_start_trial', 'af_subscribe', 'revenue')))},
    max(fact_date) AS max_fact_date_on_or_before_end FROM growth_daily_totals)""")
query("freshness", "growth_daily_totals", """
SELECT *, yesterday_row_count > 0 AS yesterday_present FROM (
  SELECT max(fact_date) AS max_fact_date, DATE '2001-08-01' AS yesterday,
    count_if(fact_date = DATE '2001-08-01')::BIGINT AS yesterday_row_count, count(*) AS row_count FROM growth_daily_totals)""")
query("lookback_window", "growth_daily_totals", "FROM growth_daily_totals WHERE fact_date BETWEEN DATE '2001-07-20' AND DATE '2001-08-02'")

# ---- write side ----------------------------------------------------------------------------

_METRICS = ("installs", "clicks", "impressions", "cost", "revenue", *EVENTS)
query("pull_dedupe", "pull_refetch", f"""
SELECT * EXCLUDE (best), best.fetched_at, best.ingest_seq, best.currency FROM (
  SELECT fact_date, media_source, campaign, adset, ad, {', '.join(_METRICS)}, timezone, report_segment,
    max({{'fetched_at': fetched_at, 'ingest_seq': ingest_seq, 'currency': currency}}) AS best FROM pull_refetch GROUP BY ALL)""")
query("dates_with_cost", "pull", "SELECT fact_date FROM pull GROUP BY fact_date HAVING max(cost) > 0")
# one row a day says which side has cost and whether the new fetch has the day
view("replace_days", "pull pull_new", f"""
SELECT fact_date, bool_or(is_new) AS fetched, coalesce(bool_or(cost > 0) FILTER (NOT is_new), false) AND NOT coalesce(bool_or(cost > 0) FILTER (is_new), false) AS hold
FROM (SELECT fact_date, cost, true AS is_new FROM pull_new UNION ALL
      SELECT fact_date, cost, false FROM pull WHERE fact_date {WINDOW} AND report_segment = '{K.DEFAULT_REPORT_SEGMENT}' AND timezone = '{LA}')
GROUP BY fact_date""")
query("cost_preserving_replace", "pull pull_new replace_days", f"""
SELECT * EXCLUDE (fetched, hold) FROM pull LEFT JOIN replace_days USING (fact_date)
WHERE NOT (coalesce(fetched AND NOT hold, false) AND report_segment = '{K.DEFAULT_REPORT_SEGMENT}' AND timezone = '{LA}')
UNION ALL
SELECT * EXCLUDE (fetched, hold) FROM pull_new JOIN replace_days USING (fact_date) WHERE NOT hold""")
_GONE = [m for m in _METRICS if m != "installs"]


def _retarget(ad: str) -> str:
    return f"""SELECT * REPLACE ({each('NULL::DOUBLE AS @', _GONE)}, {ad} AS ad, '{REATTR}' AS report_segment, '2026-03-01T00:00:00+00:00' AS fetched_at)
FROM pull WHERE report_segment = '{REATTR}'"""


query("retarget_rewrite", "pull", _retarget("['re-engagement', 'retargeting', 'retargeting', 'x y'][ingest_seq // 10 % 4 + 1]"))
query("reattr_replace", "pull", f"""
FROM pull WHERE NOT (fact_date {WINDOW} AND report_segment = '{REATTR}' AND timezone = '{LA}')
UNION ALL {_retarget("'retargeting'")} AND fact_date {WINDOW}""")
query("backfill_pull_dims", "pull")
query("source_upsert", "mcp", """
SELECT * REPLACE (if(day(fact_date) % 2 = 1, metric_value + 1, metric_value) AS metric_value,
    if(day(fact_date) % 2 = 1, fetched_at || '-refetch', fetched_at) AS fetched_at), if(day(fact_date) % 2 = 1, 2, 1) AS ingest_seq
FROM (SELECT * EXCLUDE (best), unnest(best) FROM (
  SELECT fetch_window_from, fetch_window_to, fact_date, media_source, campaign, adset, ad, kpi_name,
    max_by({'metric_value': metric_value, 'installs': installs, 'cost': cost, 'timezone': timezone, 'currency': currency, 'fetched_at': fetched_at}, fetched_at) AS best
  FROM mcp GROUP BY ALL))""")
_SILVER_KEYS = ("fact_date", "source_system", "media_source", "campaign", "adset", "ad", "attribution_model")
_ANY_NULL = each("@ IS NULL", _SILVER_KEYS, " OR ")
# a key with a NULL part never meets itself: the changed row comes beside the stored one
query("coalesce_upsert", "silver", f"""
WITH odd AS (SELECT * REPLACE (spend + 1 AS spend, '2026-03-01T00:00:00+00:00' AS fetched_at) FROM silver WHERE day(fact_date) % 2 = 1)
FROM odd WHERE NOT ({_ANY_NULL}) UNION ALL SELECT * REPLACE (NULL::DOUBLE AS arpu_ltv) FROM odd WHERE {_ANY_NULL}
UNION ALL FROM silver WHERE day(fact_date) % 2 = 0 OR {_ANY_NULL}""")
view("best_odd", "mcp", preferred("mcp", _ADSET_DIMS, f"NOT {_IS_AD} AND fact_date {WINDOW} AND day(fact_date) % 2 = 1"))
query("silver_window_rebuild", "silver best_odd", f"FROM silver WHERE NOT (fact_date {WINDOW}) UNION ALL BY NAME {facts('best_odd')}")
_OLD_KEYS = [k for k in _SILVER_KEYS if k != "attribution_model"]
_OLD_NULL = each("@ IS NULL", _OLD_KEYS, " OR ")
_SILVER = (*_SILVER_KEYS, "installs", "spend", *EVENTS, "arpu_ltv", "currency", "timezone", "fetched_at")
query("backfill_attribution_model", "silver", f"""
SELECT * REPLACE ('ltv' AS attribution_model) FROM (
  FROM silver WHERE {_OLD_NULL}
  UNION ALL BY NAME
  SELECT unnest(kept) FROM (SELECT min_by({{{each("'@': @", _SILVER)}}}, attribution_model = 'activity') AS kept
    FROM silver WHERE NOT ({_OLD_NULL}) GROUP BY {', '.join(_OLD_KEYS)}))""")
view("ranked", "mcp", "SELECT *, CASE WHEN ad IS NOT NULL THEN 3 WHEN adset IS NOT NULL THEN 0 WHEN campaign IS NOT NULL THEN 1 ELSE 2 END AS grain_rank FROM mcp")
query("grain_fallback", "ranked", """
SELECT * FROM ranked SEMI JOIN (SELECT kpi_name, fetch_window_from, fetch_window_to, min(grain_rank) AS grain_rank FROM ranked GROUP BY ALL)
USING (kpi_name, fetch_window_from, fetch_window_to, grain_rank)""")

# ---- parity: both sides tagged in one union, a row for each key --------------------------------

_PVALS = ("installs", "spend", *EVENTS, "arpu_ltv", "currency", "timezone")
_CLEAN = "if(@ IN ('', 'None'), NULL, @)"


def _parity(keys) -> str:
    """A row for each normalised key: rows of each side and whether their largest values differ."""
    one = f"""{each(f'{_CLEAN} AS @', [k for k in keys if k != 'fact_date'])}, fact_date, {{{each("'@': @", [v for v in _PVALS if v not in ('currency', 'timezone')])}, {each(f"'@': {_CLEAN}", ('currency', 'timezone'))}}} AS v"""
    return f"""
SELECT {', '.join(keys)}, count_if(lft)::BIGINT AS l, count_if(NOT lft)::BIGINT AS r, max(v) FILTER (lft) IS DISTINCT FROM max(v) FILTER (NOT lft) AS differs
FROM (SELECT true AS lft, {one} FROM silver UNION ALL
      SELECT false, {one} FROM (SELECT * REPLACE (if(fact_date = DATE '1996-01-10', spend + 1, spend) AS spend) FROM silver WHERE coalesce(media_source, '') <> 'ms_1'))
GROUP BY ALL"""


def _parity_summary(v: str) -> str:
    return f"""
SELECT *, only_left + only_right + metric_mismatches = 0 AS parity_ok FROM (
  SELECT sum(l)::BIGINT AS left_row_count, sum(r)::BIGINT AS right_row_count, count_if(l > 0)::BIGINT AS left_unique_keys, count_if(r > 0)::BIGINT AS right_unique_keys,
    count_if(r = 0)::BIGINT AS only_left, count_if(l = 0)::BIGINT AS only_right, count_if(l > 0 AND r > 0 AND differs)::BIGINT AS metric_mismatches FROM {v})"""


view("parity", "silver", _parity(_SILVER_KEYS))
view("parity_six", "silver", _parity(_OLD_KEYS))
query("export_parity", "parity", _parity_summary("parity"))
_UNEQUAL = "FROM parity WHERE l <> r OR differs"
query("export_parity_tree", "parity", f"""
SELECT *, (SELECT count(DISTINCT fact_date) {_UNEQUAL}) AS unequal_dates, (SELECT count(DISTINCT date_trunc('month', fact_date)) {_UNEQUAL}) AS unequal_months
FROM ({_parity_summary("parity")})""")
query("export_parity_six_keys", "parity_six", _parity_summary("parity_six"))
_BY_KEY = each("@ NULLS FIRST", _OLD_KEYS)
query("export_parity_samples", "parity_six", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{kind}' AS kind, {', '.join(_OLD_KEYS)} FROM parity_six WHERE {cond} ORDER BY {_BY_KEY} LIMIT 10)"
    for kind, cond in (("only_left", "r = 0"), ("only_right", "l = 0"), ("mismatch", "l > 0 AND r > 0 AND differs"))))

# ---- column-level operators ------------------------------------------------------------------

query("kpi_attribution", "mcp", f"SELECT kpi_name, {_MODEL}, {_BASE} AS base_kpi, if({_IS_AD}, 'ad', 'adset') AS grain, count(*) AS row_count FROM mcp GROUP BY ALL")
query("kpi_grain_split", "mcp", f"SELECT fact_date, if({_IS_AD}, 'ad', 'adset') AS grain, count(*) AS row_count, sum(metric_value) AS metric_value FROM mcp GROUP BY ALL")
query("dim_normalize", "stg_perf", "SELECT report_date, " + each(
    "if(@ IS NULL OR lower(trim(@)) IN ('', 'none', 'n/a', 'na', 'null', '(not set)'), '', trim(@)) AS @", ("media_source", "campaign", "platform")) + " FROM stg_perf")
_CLICKS = "SELECT _extract_date, _payload->>'clicks' AS clicks_text, {} AS clicks FROM raw_perf"
query("lenient_float_mcp", "raw_perf", _CLICKS.format("try_cast(trim(_payload->>'clicks') AS DOUBLE)"))
query("lenient_float_pull", "raw_perf", _CLICKS.format("if(upper(trim(_payload->>'clicks')) IN ('N/A', 'NA', '—', '-'), NULL, try_cast(trim(_payload->>'clicks') AS DOUBLE))"))
query("utc_to_business_date", "mcp", f"""
SELECT fact_date, timezone('{LA}', fact_date::TIMESTAMP AT TIME ZONE 'UTC')::DATE AS business_date, count(*) AS row_count FROM mcp GROUP BY ALL""")
query("is_utc_like", "pull", """
SELECT timezone, coalesce(upper(replace(trim(timezone), ' ', '_')) IN ('', 'UTC', 'GMT', 'ETC/UTC', 'ETC/GMT', 'Z'), true) AS utc_like, count(*) AS row_count
FROM pull GROUP BY ALL""")
_ONE_DAY = "if(fetch_window_from = fetch_window_to, fetch_window_from, NULL)"
query("fact_date_fallback", "mcp", f"""
SELECT kpi_name, fetch_window_from, fetch_window_to, fetched_at, coalesce(if({_IS_AD}, NULL, fact_date), {_ONE_DAY})::VARCHAR AS fact_date FROM mcp""")

# ---- files, exports, stream --------------------------------------------------------------------

view("landed", "raw_perf raw_events", f"""
SELECT '{K.REPORT_PERFORMANCE}' AS _report_name, * FROM raw_perf UNION ALL SELECT '{K.REPORT_EVENTS}', * FROM raw_events""")
query("raw_report_scan", "landed")
query("raw_report_stream", "landed")
query("raw_lineage", "landed", """
SELECT _report_name, _extract_date, sha256('{"extract_date":"' || _extract_date::VARCHAR || '","payload":{'
  || list_aggregate(list_sort(list_transform(json_keys(_payload), lambda k: '"' || k || '":' || (_payload->k)::VARCHAR)), 'string_agg', ',')
  || '},"report_name":"' || _report_name || '"}') AS _row_hash FROM landed""")
query("batch_ledger", "landed", "SELECT _report_name AS report_name, _extract_date AS extract_date, 'loaded' AS status, count(*) AS row_count FROM landed GROUP BY ALL")
query("raw_stream_ledger", "landed stg_perf", f"""
FROM (SELECT _report_name AS report_name, _extract_date AS extract_date, count(*) AS row_count FROM landed GROUP BY ALL)
LEFT JOIN (SELECT '{K.REPORT_PERFORMANCE}' AS report_name, report_date AS extract_date, coalesce(sum(cost), 0)::DOUBLE AS cost FROM stg_perf GROUP BY ALL)
USING (report_name, extract_date)""")
query("pull_csv_scan", "pull", f"""
SELECT * EXCLUDE (ingest_seq, fetched_at) REPLACE ('{LA}' AS timezone, '{K.DEFAULT_REPORT_SEGMENT}' AS report_segment, campaign || ' "q", x' || chr(10) || 'y' AS campaign,
  if(report_segment = '{REATTR}', NULL, clicks) AS clicks)
FROM pull""")
query("pull_header_map", "pull", """
SELECT if(ingest_seq % 2 = 0, h || ' ', upper(h)) AS header, f AS field, count(*) AS row_count
FROM pull, (VALUES ('Date', 'fact_date'), ('Media Source (pid)', 'media_source'), ('Conversions', 'installs'), ('Total Cost', 'cost'),
  ('af_subscribe (Unique users)', 'af_subscribe'), ('af_subscribe (Event counter)', NULL), ('Adset', 'adset'), ('Other', NULL)) AS t(h, f)
GROUP BY ALL""")
_RESPONSES = f"""
SELECT fetch_window_from, fetch_window_to, coalesce(fact_date, {_ONE_DAY}) AS fact_date, coalesce(media_source, '') AS media_source,
  campaign || ' "q", x' || chr(10) || 'y' AS campaign, coalesce(adset, '') AS adset, coalesce(ad, '') AS ad, kpi_name, 'Unique users' AS metric_column,
  metric_value, installs, cost, 'UTC' AS timezone, 'USD' AS currency,
  max(fetched_at) OVER (PARTITION BY kpi_name, fetch_window_from, fetch_window_to, left(fetched_at, 18)) AS fetched_at
FROM mcp"""
query("mcp_response_scan", "mcp", _RESPONSES)
query("metric_column_identify", "mcp", f"""
SELECT kpi_name, metric_column, count(*) AS row_count, {each('sum(@) AS @', ('metric_value', 'installs', 'cost'))} FROM ({_RESPONSES}) GROUP BY ALL""")
_REPORT_OF = f"if(kpi_name = 'arpu_ltv', '{K.REPORT_COHORT_REVENUE}', '{K.REPORT_EVENTS}')"
query("raw_export", "mcp", f"SELECT {_REPORT_OF} AS _report_name, coalesce(fact_date, fetch_window_from) AS _extract_date, kpi_name, media_source, metric_value FROM mcp")
query("fact_export", "silver", f"SELECT * REPLACE ({each(f'{_CLEAN} AS @', ('media_source', 'campaign', 'adset', 'ad', 'currency', 'timezone'))}) FROM silver")
query("export_summary", "mcp silver", f"""
SELECT count(DISTINCT part) AS raw_snapshot_partitions_written, count_if(part IS NULL)::BIGINT AS normalized_rows_written
FROM (SELECT {{'r': {_REPORT_OF}, 'd': coalesce(fact_date, fetch_window_from)}} AS part FROM mcp UNION ALL SELECT NULL FROM silver)""")
