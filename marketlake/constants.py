"""Fixed values shared by the operators.

The values in the block below must equal those of the source system for results
to match: event names, KPI names, header synonyms, blank tokens and labels.
"""

# ---------------------------------------------------------------------------
# Fixed values (must match the source system exactly)
# ---------------------------------------------------------------------------

#: Default business time zone for calendar dates.
DEFAULT_BUSINESS_TZ = "America/Los_Angeles"

#: The four tracked in-app events, in the order used by the silver tables.
EVENT_NAMES = (
    "af_start_trial",
    "af_subscribe",
    "rc_trial_converted_event",
    "af_tutorial_completion",
)

#: KPI names of the adset-grain fetch (base names; "_activity" suffix = activity model).
KPI_UNIQUE_USERS_SUFFIX = "_unique_users"
KPI_ARPU = "arpu_ltv"
KPI_ACTIVITY_SUFFIX = "_activity"
KPI_AD_PREFIX = "ad_"
KPI_AD_PERFORMANCE = "ad_performance"

#: Attribution models.
MODEL_LTV = "ltv"
MODEL_ACTIVITY = "activity"

#: Dimension header names of the tool-response CSV and their fields.
MCP_DIMENSION_HEADERS = {
    "Date": "fact_date",
    "Media source": "media_source",
    "Campaign": "campaign",
    "Adset": "adset",
    "Ad": "ad",
}

#: Pull report header synonyms (lower-cased, trimmed) -> field.
PULL_HEADER_ALIASES = {
    "date": "fact_date",
    "media source": "media_source",
    "campaign": "campaign",
    "adset": "adset",
    "ad": "ad",
    "installs": "installs",
    "conversions": "installs",
    "clicks": "clicks",
    "impressions": "impressions",
    "total cost": "cost",
    "cost": "cost",
    "total revenue": "revenue",
    "revenue": "revenue",
    "af_start_trial (unique users)": "af_start_trial",
    "af_subscribe (unique users)": "af_subscribe",
    "rc_trial_converted_event (unique users)": "rc_trial_converted_event",
    "af_tutorial_completion (unique users)": "af_tutorial_completion",
}

#: Dimension values that mean "empty" (compared after trim + lower).
BLANK_DIM_TOKENS = ("none", "n/a", "na", "null", "(not set)")

#: Number strings that mean "missing" in the Pull report (compared after trim + upper).
BLANK_NUMBER_TOKENS = ("N/A", "NA", "—", "-")

#: Time-zone names treated as UTC (after trim, upper, space -> underscore).
UTC_LIKE_TZ = ("UTC", "GMT", "ETC/UTC", "ETC/GMT", "Z")

#: Report segments of the Pull report.
DEFAULT_REPORT_SEGMENT = "partners_by_date_report"
REATTR_SEGMENT_SUFFIX = "_reattr"
RETARGETING_AD_DEFAULT = "retargeting"

#: Raw report names of the warehouse path.
REPORT_PERFORMANCE = "aggregated_performance"
REPORT_EVENTS = "in_app_events"
REPORT_COHORT_REVENUE = "cohort_revenue"
KNOWN_RAW_REPORTS = (REPORT_PERFORMANCE, REPORT_EVENTS, REPORT_COHORT_REVENUE)

#: Label used for unknown entities in top-N reports.
UNKNOWN_ENTITY = "(unknown)"

#: Caveat text of the experimental breakdown layer.
BREAKDOWN_CAVEAT = (
    "MCP breakdowns are richer but may not exactly match LA dashboard day buckets yet."
)

#: Confidence labels.
CONF_HIGH = "high"
CONF_MEDIUM = "medium"
CONF_EXPERIMENTAL = "experimental"

# ---------------------------------------------------------------------------
# Source-system labels (ours: vendor-neutral names; override per deployment)
# ---------------------------------------------------------------------------

SRC_PULL = "attribution_pull"
SRC_MCP = "attribution_mcp"
SRC_MCP_AD = "attribution_mcp_ad"
RAW_SOURCE_SYSTEM = "attribution"

#: Dimension columns of the silver/gold layers.
DIMS = ("media_source", "campaign", "adset", "ad")

#: Pull metric columns, in table order.
PULL_METRICS = (
    "installs", "clicks", "impressions", "cost", "revenue",
    "af_start_trial", "af_subscribe", "rc_trial_converted_event", "af_tutorial_completion",
)

# Keys and values that export parity compares
PARITY_KEYS = ("fact_date", "source_system", "media_source", "campaign", "adset", "ad")
PARITY_VALUES = ("installs", "spend", "af_start_trial", "af_subscribe", "af_tutorial_completion",
                 "rc_trial_converted_event", "arpu_ltv", "currency", "timezone")
