"""Column names, view contracts and fixed lists of the usage-report format."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names of the daily usage reports. They are the input
# format, so they are spelled exactly as the reports spell them.
# ---------------------------------------------------------------------------
ACTIVE_USERS = "total_active_users"
PROMPTS = "user_initiated_interaction_count"
GENERATED = "code_generation_activity_count"
ACCEPTED = "code_acceptance_activity_count"
AGENT_MODE = "chat_panel_agent_mode"
ASK_MODE = "chat_panel_ask_mode"
EDIT_MODE = "chat_panel_edit_mode"
CUSTOM_MODE = "chat_panel_custom_mode"
AGENT_EDIT = "agent_edit"

MONTHLY_AGENT = "monthly_active_agent_users"
AGENT_1D = "copilot_coding_agent_active_users_1d"
AGENT_7D = "copilot_coding_agent_active_users_7d"
AGENT_28D = "copilot_coding_agent_active_users_28d"

FLAG_AGENT = "used_copilot_coding_agent"
FLAG_ACTIVE = "used_copilot_code_review_active"
FLAG_PASSIVE = "used_copilot_code_review_passive"

BREAKDOWN = "totals_by_language_feature"

METRICS = [
    ACTIVE_USERS, PROMPTS, GENERATED, ACCEPTED,
    AGENT_MODE, ASK_MODE, EDIT_MODE, CUSTOM_MODE, AGENT_EDIT,
]
ORG_METRICS = [MONTHLY_AGENT, AGENT_1D, AGENT_7D, AGENT_28D]
FLAGS = [FLAG_AGENT, FLAG_ACTIVE, FLAG_PASSIVE]
LANGUAGE_METRICS = [PROMPTS, GENERATED, ACCEPTED]
CHAT_MODES = [AGENT_MODE, ASK_MODE, EDIT_MODE, CUSTOM_MODE]

# Defaults of an incomplete breakdown entry.
UNKNOWN_LANGUAGE = "unknown"
DEFAULT_FEATURE = "code_completion"

# Selectable trailing windows (in report rows) and the default.
WINDOW_OPTIONS = (28, 60, 100)
DEFAULT_WINDOW = 60

# Bounds of the report window, and the reporting lag in days.
MAX_REPORT_DAYS = 100
REPORT_LAG_DAYS = 2

# Infrastructure and shell languages, in display order.
INFRA_LANGUAGES = ["bicep", "hcl", "bash", "powershell", "pwsh", "shellscript"]

# Language families and phases of the feature classification.
CHAT_LANGUAGES = ["markdown", "yaml", "json"]
AGENT_PHASES = ["agent-rollout", "delivery-sprint"]

# Phase bands over the progress 0..1 of a period, both ends
# inclusive; a later band wins where two overlap.
PHASE_BANDS = [
    ("onboarding-drive", 0.16, 0.24),
    ("release-hardening", 0.40, 0.48),
    ("agent-rollout", 0.62, 0.72),
    ("review-push", 0.78, 0.86),
    ("delivery-sprint", 0.92, 1.0),
]
BASELINE_PHASE = "baseline"

# Names of the raw tables and of the curated views.
RAW_TABLES = ("org_metrics", "user_metrics")
VIEWS = ("daily_summary", "user_summary", "user_daily_summary", "language_summary")


def _longs(names):
    return [T.StructField(n, T.LongType()) for n in names]


def _bools(names):
    return [T.StructField(n, T.BooleanType()) for n in names]


_DAY = T.StructField("day", T.StringType())
_USER = T.StructField("user_login", T.StringType())

BREAKDOWN_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("language", T.StringType()), T.StructField("feature", T.StringType())]
        + _longs(LANGUAGE_METRICS)
    )
)

VIEW_SCHEMAS = {
    "daily_summary": T.StructType([_DAY] + _longs(METRICS + ORG_METRICS)),
    "user_summary": T.StructType(
        [_USER]
        + _longs(["active_days"] + METRICS[1:] + [f"{f}_days" for f in FLAGS])
        + _bools(FLAGS)
    ),
    "user_daily_summary": T.StructType([_DAY, _USER] + _longs(METRICS) + _bools(FLAGS)),
    "language_summary": T.StructType(
        [_DAY, T.StructField("language", T.StringType())]
        + _longs(LANGUAGE_METRICS + ["activity_score"])
    ),
}
