"""SQL with the meaning of each registered query, for a second engine to check.

Written from the definitions, not from the Spark plans: rolling counts use a join
and ``count(DISTINCT)``, rankings use window functions.
"""

from __future__ import annotations

from ..fields import (
    ACCEPTED, ACTIVE_USERS, AGENT_1D, AGENT_28D, AGENT_7D, AGENT_EDIT, AGENT_MODE, ASK_MODE,
    CUSTOM_MODE, EDIT_MODE, FLAG_ACTIVE, FLAG_AGENT, FLAG_PASSIVE, FLAGS, GENERATED,
    INFRA_LANGUAGES, LANGUAGE_METRICS, METRICS, MONTHLY_AGENT, ORG_METRICS, PROMPTS,
)

# The rules are written down here again: a check must not take them from what it checks.
LANGUAGES = [
    "python", "typescript", "go", "java", "markdown", "yaml",
    "bicep", "hcl", "bash", "powershell", "pwsh", "shellscript",
]
FEATURE_OF_EVENT = {
    "view": "chat_panel_ask_mode",
    "click": "code_completion",
    "purchase": "chat_panel_agent_mode",
}
PHASE_BANDS = [
    ("onboarding-drive", 0.16, 0.24), ("release-hardening", 0.40, 0.48),
    ("agent-rollout", 0.62, 0.72), ("review-push", 0.78, 0.86), ("delivery-sprint", 0.92, 1.0),
]

ORACLE: dict[str, str] = {}


def _list(names, prefix=""):
    return ", ".join(f"{prefix}{n}" for n in names)


def _sums(names, prefix=""):
    return ", ".join(f"CAST(coalesce(sum({prefix}{n}), 0) AS BIGINT) AS {n}" for n in names)


_EV = """ev AS (
  SELECT ts, CAST(ts AS DATE) AS date, strftime(ts, '%Y-%m-%d') AS day,
         'u' || user_id AS user_login, event_type, CAST(props->>'$.k' AS BIGINT) AS k
  FROM events)"""


def _user_days_of(source):
    click = "FILTER (event_type = 'click')"
    modes = [AGENT_MODE, ASK_MODE, EDIT_MODE, CUSTOM_MODE]
    return f"""
  SELECT day, user_login, CAST(1 AS BIGINT) AS {ACTIVE_USERS},
    count(*) FILTER (event_type = 'view') AS {PROMPTS},
    CAST(coalesce(sum(k) {click}, 0) AS BIGINT) AS {GENERATED},
    CAST(coalesce(sum((k * (k % 10)) // 10) {click}, 0) AS BIGINT) AS {ACCEPTED},
    {", ".join(f"count(*) FILTER (event_type = 'view' AND k % 4 = {i}) AS {m}"
               for i, m in enumerate(modes))},
    CAST(coalesce(sum(k) FILTER (event_type = 'click' AND k % 5 = 0), 0) AS BIGINT) AS {AGENT_EDIT},
    bool_or(event_type = 'signup' AND k < 10) AS {FLAG_AGENT},
    bool_or(event_type = 'error' AND k < 20) AS {FLAG_ACTIVE},
    bool_or(event_type = 'error' AND k < 60) AS {FLAG_PASSIVE}
  FROM {source} GROUP BY day, user_login"""


_UD = f"{_EV},\nud AS ({_user_days_of('ev')})"

_SPINE = """sp AS (
  SELECT strftime(d, '%Y-%m-%d') AS day, row_number() OVER (ORDER BY d) - 1 AS idx
  FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM ev))"""

_ANY = f"({FLAG_AGENT} OR {AGENT_MODE} > 0 OR {AGENT_EDIT} > 0)"


def _rolled(name, predicate, n):
    predicate = predicate if predicate == FLAG_AGENT else _ANY
    return f"""
  SELECT sp.day, count(DISTINCT u.user_login) AS {name}
  FROM sp LEFT JOIN (SELECT p.idx, x.user_login FROM ud AS x JOIN sp AS p ON p.day = x.day
                     WHERE {predicate}) AS u
    ON u.idx BETWEEN sp.idx - {n - 1} AND sp.idx
  GROUP BY sp.day"""


_SUM = f"""sums AS (
  SELECT sp.day, {_sums(METRICS)} FROM sp LEFT JOIN ud ON ud.day = sp.day GROUP BY sp.day)"""

_BASE = f"{_UD},\n{_SPINE}"
_ORG = f"""{_BASE},
{_SUM},
r_m AS ({_rolled(MONTHLY_AGENT, "any", 28)}),
r_1 AS ({_rolled(AGENT_1D, FLAG_AGENT, 1)}),
r_7 AS ({_rolled(AGENT_7D, FLAG_AGENT, 7)}),
r_28 AS ({_rolled(AGENT_28D, FLAG_AGENT, 28)}),
od AS (SELECT * FROM sums JOIN r_m USING (day) JOIN r_1 USING (day) JOIN r_7 USING (day)
       JOIN r_28 USING (day))"""


def _visible_of(source, name):
    return f"""{name} AS (
  SELECT * FROM {source} WHERE day IN (
    SELECT day FROM (
      SELECT day, row_number() OVER (ORDER BY day DESC) AS pos, count(*) OVER () AS n
      FROM sp)
    WHERE pos <= CASE WHEN n >= 60 THEN 60 WHEN n >= 28 THEN 28 ELSE n END))"""


_VIS = f"{_ORG},\n{_visible_of('od', 'v')}"

_LANGUAGE_LIST = "[" + ", ".join(f"'{n}'" for n in LANGUAGES) + "]"
_FEATURE_CASE = " ".join(f"WHEN '{e}' THEN '{f}'" for e, f in FEATURE_OF_EVENT.items())
_ENTRIES = f"""en AS (
  SELECT day, user_login, {_LANGUAGE_LIST}[k % 12 + 1] AS language,
    CASE event_type {_FEATURE_CASE} END AS feature,
    count(*) FILTER (event_type <> 'click') AS {PROMPTS},
    CAST(coalesce(sum(k) FILTER (event_type = 'click'), 0) AS BIGINT) AS {GENERATED},
    CAST(coalesce(sum((k * (k % 10)) // 10) FILTER (event_type = 'click'), 0) AS BIGINT)
      AS {ACCEPTED}
  FROM ev WHERE event_type IN ('view', 'click', 'purchase')
  GROUP BY ALL)"""
_LANG = f"""{_EV},
{_ENTRIES},
lang AS (
  SELECT *, {" + ".join(LANGUAGE_METRICS)} AS activity_score
  FROM (SELECT day, language, {_sums(LANGUAGE_METRICS)} FROM en GROUP BY day, language))"""
_VLANG = f"""{_LANG},
{_SPINE},
{_visible_of('lang', 'vl')},
scores AS (
  SELECT language, CAST(sum(activity_score) AS BIGINT) AS score,
         min(day) AS first_day, arg_min(activity_score, day) AS first_score
  FROM vl GROUP BY language),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, first_day, first_score DESC, language) AS r
  FROM scores)"""

_USER_SUMS = ", ".join(
    [f"count(*) AS active_days, {_sums(METRICS[1:])}"]
    + [f"CAST(sum(CASE WHEN {f} THEN 1 ELSE 0 END) AS BIGINT) AS {f}_days" for f in FLAGS]
    + [f"bool_or({f}) AS {f}" for f in FLAGS]
)
_WU = f"""{_BASE},
{_visible_of('ud', 'vud')},
wu AS (SELECT user_login, {_USER_SUMS}, min(day) AS first_day FROM vud GROUP BY user_login),
tu AS (SELECT *, {FLAG_ACTIVE}_days + {FLAG_PASSIVE}_days AS review_days FROM wu)"""


def _ratio(part, whole, scale="* 100"):
    return f"CASE WHEN ({whole}) > 0 THEN CAST({part} AS DOUBLE) / ({whole}) {scale} ELSE 0.0 END"


def _peak(column, value, source="v"):
    return f"(SELECT {column} FROM {source} ORDER BY {value} DESC, day LIMIT 1)"


_RATE = _ratio(ACCEPTED, GENERATED)
_CHAT = f"({AGENT_MODE} + {ASK_MODE} + {EDIT_MODE} + {CUSTOM_MODE})"
_STANDING = f"{FLAG_AGENT}_days DESC, {PROMPTS} DESC, active_days DESC, first_day, user_login"
_USER_ORDER = f"review_days DESC, {_STANDING}"
_REVIEWER_ORDER = f"review_days DESC, {PROMPTS} DESC, {_STANDING}"


def put(name, prelude, body):
    ORACLE[name] = f"WITH {prelude}\n{body}"


# --- curated views
put("daily_summary", _ORG, f"SELECT day, {_list(METRICS + ORG_METRICS)} FROM od ORDER BY day")
put("user_summary", _UD, f"SELECT user_login, {_USER_SUMS} FROM ud GROUP BY user_login")
put("user_daily_summary", _UD, "SELECT * FROM ud")
put("language_summary", _LANG, "SELECT * FROM lang")
put("language_flatten", f"{_EV},\n{_ENTRIES}", "SELECT * FROM en")
put("org_language_rollup", f"{_EV},\n{_ENTRIES}", f"""
SELECT day, row_number() OVER (PARTITION BY day
         ORDER BY {GENERATED} DESC, {PROMPTS} DESC, language, feature) - 1 AS position,
       language, feature, {_list(LANGUAGE_METRICS)}
FROM (SELECT day, language, feature, {_sums(LANGUAGE_METRICS)} FROM en
      GROUP BY day, language, feature)""")
put("ensure_columns", _UD, f"""
SELECT * EXCLUDE ({AGENT_EDIT}, {_list(FLAGS)}), CAST(0 AS BIGINT) AS {AGENT_EDIT},
       {", ".join(f"false AS {f}" for f in FLAGS)} FROM ud""")

# --- rollups
put("org_rollup", f"{_BASE},\n{_SUM}", "SELECT * FROM sums")
put("rolling_agent_users", _ORG, f"SELECT day, {AGENT_1D}, {AGENT_7D}, {AGENT_28D} FROM od")
put("monthly_agent_users", _BASE, _rolled(MONTHLY_AGENT, "any", 28))
put("weekly_any_agent_users", _BASE, _rolled(MONTHLY_AGENT, "any", 7))
put("report_days", _UD, f"""
SELECT s.day, CAST(coalesce(sum(ud.{ACTIVE_USERS}), 0) AS BIGINT) AS {ACTIVE_USERS}
FROM (SELECT strftime(unnest(generate_series(max(date) - INTERVAL 99 DAY, CAST(max(date) AS TIMESTAMP),
             INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM ev) AS s
LEFT JOIN ud ON ud.day = s.day GROUP BY s.day""")
put("flag_adopters", _UD, f"""
SELECT count(DISTINCT user_login) AS population,
  count(DISTINCT user_login) FILTER ({FLAG_AGENT}) AS agent_users,
  count(DISTINCT user_login) FILTER ({FLAG_ACTIVE}) AS active_review_users,
  count(DISTINCT user_login) FILTER ({FLAG_PASSIVE}) AS passive_review_users
FROM ud""")
put("distinct_agent_users", _UD, f"""
SELECT day, count(DISTINCT user_login) FILTER ({FLAG_AGENT}) AS users FROM ud GROUP BY day""")

# --- windows
put("visible_days", _VIS, "SELECT * FROM v")
put("last_14_days", _ORG, "SELECT * FROM od ORDER BY day DESC LIMIT 14")
_ORDER_DAYS = """od AS (
  SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, count(*) AS orders,
    CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS amount
  FROM orders GROUP BY 1)"""
put("order_days_default", _ORDER_DAYS, "SELECT * FROM od ORDER BY day DESC LIMIT 60")
put("order_days_selected", _ORDER_DAYS, " UNION ALL ".join(
    f"SELECT * FROM (SELECT *, CAST({n} AS INTEGER) AS selected FROM od ORDER BY day DESC LIMIT {k})"
    for n, k in ((28, 28), (100, 100), (45, 60))))
put("visible_user_daily", f"{_BASE},\n{_visible_of('ud', 'v')}", "SELECT * FROM v")
put("visible_language_daily", f"{_LANG},\n{_SPINE},\n{_visible_of('lang', 'v')}", "SELECT * FROM v")
put("window_user_summary", _WU, "SELECT * FROM wu")

# --- cards
put("summary_kpis", _VIS, f"""
SELECT count(*) AS days,
  CAST(floor(sum({ACTIVE_USERS}) / count(*) + 0.5) AS BIGINT) AS avg_dau,
  CAST(sum({PROMPTS}) AS BIGINT) AS total_prompts,
  CAST(floor(sum({PROMPTS}) / count(*) + 0.5) AS BIGINT) AS prompts_per_day,
  CAST(sum({ACCEPTED}) AS BIGINT) AS total_accepted,
  CAST(sum({GENERATED}) AS BIGINT) AS total_generated,
  {_ratio(f"sum({ACCEPTED})", f"sum({GENERATED})")} AS acceptance_rate,
  CAST(sum({AGENT_MODE}) AS BIGINT) AS total_agent_mode,
  CAST(sum({_CHAT}) AS BIGINT) AS total_chat_requests,
  {_ratio(f"sum({AGENT_MODE})", f"sum({_CHAT})")} AS agent_mode_share
FROM v HAVING count(*) > 0""")
put("latest_org_metrics", _VIS, f"""
SELECT day AS latest_day, {_list(ORG_METRICS)} FROM v ORDER BY day DESC LIMIT 1""")
_INTENSITY = _ratio(PROMPTS, ACTIVE_USERS, "")
put("dau_insights", _VIS, f"""
SELECT CAST(floor({_ratio(f"sum({PROMPTS})", f"sum({ACTIVE_USERS})", "")} + 0.5) AS BIGINT)
    AS avg_prompts_per_user,
  {_peak(ACTIVE_USERS, ACTIVE_USERS)} AS peak_dau,
  {_peak("day", ACTIVE_USERS)} AS peak_dau_day,
  {_peak(_INTENSITY, _INTENSITY)} AS peak_prompt_intensity,
  {_peak("day", _INTENSITY)} AS peak_prompt_intensity_day,
  count(*) FILTER ({AGENT_MODE} > 0) AS agent_traffic_days
FROM v HAVING count(*) > 0""")
put("code_insights", _VIS, f"""
SELECT CAST(sum({ACCEPTED}) AS BIGINT) AS total_accepted,
  CAST(sum({GENERATED}) AS BIGINT) AS total_generated,
  {_ratio(f"sum({ACCEPTED})", f"sum({GENERATED})")} AS acceptance_rate,
  CAST(sum({AGENT_EDIT}) AS BIGINT) AS total_agent_edit,
  {_peak(GENERATED, GENERATED)} AS peak_generation,
  {_peak("day", GENERATED)} AS peak_generation_day,
  {_peak(ACCEPTED, ACCEPTED)} AS peak_acceptance,
  {_peak("day", ACCEPTED)} AS peak_acceptance_day,
  {_peak(AGENT_EDIT, AGENT_EDIT)} AS peak_agent_edit,
  {_peak("day", AGENT_EDIT)} AS peak_agent_edit_day
FROM v HAVING count(*) > 0""")


def _milestones(threshold):
    candidates = f"""CASE WHEN EXISTS (SELECT 1 FROM v WHERE {GENERATED} >= {threshold})
        THEN {GENERATED} >= {threshold}
      WHEN EXISTS (SELECT 1 FROM v WHERE {GENERATED} > 0) THEN {GENERATED} > 0
      ELSE true END"""
    merit = f"CASE WHEN {GENERATED} > 0 THEN {_ratio(ACCEPTED, GENERATED, '')} ELSE {ACCEPTED} END"
    return f""",
best AS (SELECT day AS best_day, {_RATE} AS best_rate, {ACCEPTED} AS best_accepted
         FROM v WHERE {candidates} ORDER BY {merit} DESC, day LIMIT 1),
spike AS (SELECT day AS spike_day, {GENERATED} AS spike_generated, {ACCEPTED} AS spike_accepted
          FROM v ORDER BY {GENERATED} DESC, day LIMIT 1),
agent AS (SELECT day AS agent_day, {AGENT_EDIT} AS agent_edits, {GENERATED} AS agent_generated
          FROM v ORDER BY {AGENT_EDIT} DESC, day LIMIT 1)"""


_CARDS = "SELECT * FROM spike CROSS JOIN best CROSS JOIN agent"
put("code_milestones", _VIS + _milestones(80), _CARDS)
put("code_milestones_3000", _VIS + _milestones(3000), _CARDS)
put("agent_insights", _VIS, f"""
SELECT {AGENT_1D} AS latest_1d, {AGENT_7D} AS latest_7d, {AGENT_28D} AS latest_28d,
  CASE WHEN {AGENT_28D} <> 0 AND {MONTHLY_AGENT} <> 0
       THEN {AGENT_28D} / {MONTHLY_AGENT} * 100 END AS cloud_reach
FROM v ORDER BY day DESC LIMIT 1""")
put("adoption_overview", _VIS, f"""
SELECT count(*) AS window_days, arg_max({MONTHLY_AGENT}, day) AS {MONTHLY_AGENT},
  {_ratio(f"sum({AGENT_MODE})", f"sum({_CHAT})")} AS agent_mode_share,
  CAST(sum({AGENT_EDIT}) AS BIGINT) AS total_agent_edit,
  count(*) FILTER ({AGENT_MODE} > 0) AS agent_days,
  arg_max({AGENT_1D} IS NOT NULL OR {AGENT_7D} IS NOT NULL OR {AGENT_28D} IS NOT NULL, day)
    AS has_cloud_metrics
FROM v HAVING count(*) > 0""")

# --- series
put("prompts_per_user", _VIS, f"""
SELECT day, {ACTIVE_USERS}, {PROMPTS}, {_INTENSITY} AS prompts_per_user FROM v""")
put("acceptance_rate", _VIS, f"""
SELECT day, {GENERATED}, {ACCEPTED}, {AGENT_EDIT}, {_RATE} AS acceptance_rate FROM v""")
put("mode_mix", _VIS, "SELECT day, " + ", ".join(
    f"{_ratio(m, _CHAT)} AS {n}_ratio"
    for n, m in (("agent", AGENT_MODE), ("ask", ASK_MODE), ("plan", EDIT_MODE),
                 ("custom", CUSTOM_MODE))) + " FROM v")
put("agent_trend", _VIS, f"""
SELECT day, {AGENT_1D} AS active_users_1d, {AGENT_7D} AS active_users_7d,
       {AGENT_28D} AS active_users_28d FROM v""")
put("agent_trend_available", _VIS, f"""
SELECT count(*) FILTER ({AGENT_1D} IS NOT NULL OR {AGENT_7D} IS NOT NULL
                        OR {AGENT_28D} IS NOT NULL) > 0 AS has_any_data FROM v""")

# --- users
_REACH = f"""{_WU},
reach AS (
  SELECT true AS has_flags, true AS has_day_counts, count(*) AS total_users,
    CAST(sum(active_days) AS BIGINT) AS total_active_days,
    count(*) FILTER ({FLAG_AGENT}) AS agent_users,
    count(*) FILTER ({FLAG_ACTIVE}) AS active_review_users,
    count(*) FILTER ({FLAG_PASSIVE}) AS passive_review_users,
    count(*) FILTER ({FLAG_ACTIVE} OR {FLAG_PASSIVE}) AS any_review_users,
    CAST(sum({FLAG_AGENT}_days) AS BIGINT) AS agent_days,
    CAST(sum({FLAG_ACTIVE}_days) AS BIGINT) AS active_review_days,
    CAST(sum({FLAG_PASSIVE}_days) AS BIGINT) AS passive_review_days,
    CAST(sum(review_days) AS BIGINT) AS review_touch_days,
    count(*) FILTER (review_days >= 7) AS heavy_reviewers
  FROM tu HAVING count(*) > 0)"""
put("review_engagement", _REACH, f"""
SELECT *,
  {_ratio("agent_users", "total_users")} AS agent_users_share,
  {_ratio("agent_days", "total_active_days")} AS agent_days_share,
  {_ratio("active_review_users", "total_users")} AS active_review_users_share,
  {_ratio("active_review_days", "total_active_days")} AS active_review_days_share,
  {_ratio("passive_review_users", "total_users")} AS passive_review_users_share,
  {_ratio("passive_review_days", "total_active_days")} AS passive_review_days_share,
  {_ratio("any_review_users", "total_users")} AS any_review_users_share,
  CAST(7 AS BIGINT) AS heavy_threshold,
  {_ratio("review_touch_days", "any_review_users", "")} AS avg_review_days
FROM reach""")
put("review_coverage", _REACH, " UNION ALL ".join(
    f"""SELECT '{label}' AS coverage, {d} AS days, {u} AS users, total_active_days, total_users,
  {_ratio(d, "total_active_days")} AS ratio FROM reach"""
    for label, d, u in (
        ("Coding agent coverage", "agent_days", "agent_users"),
        ("Active review coverage", "active_review_days", "active_review_users"),
        ("Passive review coverage", "passive_review_days", "passive_review_users"),
    )))
put("review_hotspots", _WU, f"""
SELECT CAST(row_number() OVER (ORDER BY {_REVIEWER_ORDER}) AS INTEGER) AS rank, user_login,
  review_days, {_ratio("review_days", "active_days")} AS review_share, {PROMPTS} AS prompts,
  {FLAG_AGENT}_days AS agent_days
FROM tu WHERE review_days > 0 ORDER BY rank LIMIT 3""")
put("top_reviewers", _WU, f"""
SELECT CAST(row_number() OVER (ORDER BY {_REVIEWER_ORDER}) AS INTEGER) AS rank, user_login,
  review_days, {FLAG_ACTIVE}_days AS active_review_days,
  {FLAG_PASSIVE}_days AS passive_review_days, {FLAG_AGENT}_days AS agent_days, active_days,
  {PROMPTS} AS prompts,
  {_ratio(f"{FLAG_ACTIVE}_days", "active_days")} AS active_share,
  {_ratio(f"{FLAG_PASSIVE}_days", "active_days")} AS passive_share,
  {_ratio("review_days", "active_days")} AS review_share
FROM tu ORDER BY rank LIMIT 5""")
_TABLE = f"""user_login, active_days, {PROMPTS}, {GENERATED}, {ACCEPTED},
  {_RATE} AS acceptance_rate, {AGENT_MODE}, {ASK_MODE}, {EDIT_MODE}, {CUSTOM_MODE},
  array_to_string(list_filter([CASE WHEN {FLAG_AGENT} THEN 'Coding agent' END,
    CASE WHEN {FLAG_ACTIVE} THEN 'Review active' END,
    CASE WHEN {FLAG_PASSIVE} THEN 'Review passive' END], lambda x: x IS NOT NULL), ', ')
    AS capabilities,
  review_days AS review_touch_days, {FLAG_AGENT}_days AS agent_days"""
put("user_table", _WU, f"""
SELECT CAST(row_number() OVER (ORDER BY {_USER_ORDER}) AS INTEGER) AS rank, {_TABLE}
FROM tu ORDER BY rank LIMIT 6""")
put("user_table_full", _WU, f"SELECT {_TABLE} FROM tu")

# --- languages
put("language_ranking", _VLANG, f"""
SELECT CAST(r AS INTEGER) AS rank, language, score,
  {_ratio("score", "(SELECT sum(score) FROM scores)")} AS share
FROM ranked WHERE r <= 5""")
_SERIES = f"""{_VLANG},
series AS (
  SELECT day, CASE WHEN r <= 6 THEN vl.language ELSE 'Other' END AS series,
    CAST(CASE WHEN r <= 6 THEN r ELSE 7 END AS INTEGER) AS series_rank,
    CAST(sum(activity_score) AS BIGINT) AS score
  FROM vl JOIN ranked ON ranked.language = vl.language GROUP BY 1, 2, 3),
kept AS (SELECT * FROM series WHERE series_rank < 7
         OR EXISTS (SELECT 1 FROM series WHERE series_rank = 7 AND score > 0))"""
put("language_series", _SERIES, "SELECT day, series, series_rank, score FROM kept")
_RANKED = ", ".join(
    f"CAST(sum(CASE WHEN series_rank = {i} THEN score END) AS BIGINT) AS top_{i}"
    for i in range(1, 7))
put("language_pivot", _SERIES, f"""
SELECT day, {_RANKED},
  CAST(sum(CASE WHEN series_rank = 7 THEN score END) AS BIGINT) AS other,
  (SELECT string_agg(series, ', ' ORDER BY series_rank)
   FROM (SELECT DISTINCT series, series_rank FROM kept)) AS series
FROM kept GROUP BY day""")
put("infra_languages", _VLANG, f"""
SELECT CAST(position AS BIGINT) AS position, language, count(*) AS day_rows
FROM vl JOIN (SELECT unnest([{", ".join(f"'{n}'" for n in INFRA_LANGUAGES)}]) AS language,
                     generate_subscripts([{", ".join(f"'{n}'" for n in INFRA_LANGUAGES)}], 1)
                       AS position) AS known
USING (language) GROUP BY ALL""")

# --- allocation, scores, calendar
_ITEMS = """items AS (
  SELECT l.*, CAST(floor(o_totalprice) AS BIGINT) AS total FROM (
    SELECT l_orderkey, l_partkey,
      sum(l_quantity * CASE WHEN l_returnflag = 'R' THEN 3.0 ELSE 2.0 END) AS weight
    FROM lineitem GROUP BY ALL) AS l JOIN orders ON o_orderkey = l_orderkey)"""


def _shares(group):
    return f"""shares AS (
  SELECT *, CASE WHEN sum(weight) OVER g > 0 THEN weight / sum(weight) OVER g
    ELSE 1.0 / count(*) OVER g END AS share
  FROM items WINDOW g AS (PARTITION BY {group}))"""


def _apportioned(group):
    return f"""{_shares(group)},
parts AS (SELECT *, CAST(floor(total * share) AS BIGINT) AS base,
                 total * share - floor(total * share) AS frac FROM shares)
SELECT * EXCLUDE (base, frac),
  base + CASE WHEN row_number() OVER (PARTITION BY {group} ORDER BY frac DESC, l_partkey)
    <= total - CAST(sum(base) OVER (PARTITION BY {group}) AS BIGINT) THEN 1 ELSE 0 END AS allotted
FROM parts"""


ORACLE["normalised_weights"] = f"WITH {_ITEMS}, {_shares('l_orderkey')} SELECT * FROM shares"
ORACLE["apportion"] = f"WITH {_ITEMS}, {_apportioned('l_orderkey')}"
ORACLE["apportion_any_scale"] = f"""WITH {_ITEMS}, {_apportioned('l_orderkey')}""".replace(
    "SELECT * EXCLUDE (base, frac)", "SELECT * EXCLUDE (base, frac, weight)")
ORACLE["apportion_large_groups"] = f"""WITH items AS (
  SELECT l_returnflag, l_partkey, sum(l_quantity) AS weight, CAST(1000003 AS BIGINT) AS total
  FROM lineitem GROUP BY l_returnflag, l_partkey), {_apportioned('l_returnflag')}"""

_PHASE = "CASE " + " ".join(
    f"WHEN progress BETWEEN CAST({lo} AS DOUBLE) AND CAST({hi} AS DOUBLE) THEN '{n}'"
    for n, lo, hi in reversed(PHASE_BANDS)
) + " ELSE 'baseline' END"
_CAL = f"""{_EV},
{_SPINE},
cal AS (
  SELECT *, {_PHASE} AS phase FROM (
    SELECT day, idx / greatest((SELECT count(*) FROM sp) - 1, 1) AS progress,
      CAST(isodow(CAST(day AS DATE)) - 1 AS BIGINT) AS weekday,
      isodow(CAST(day AS DATE)) >= 6 AS is_weekend
    FROM sp))"""
put("calendar_phase", _CAL, "SELECT * FROM cal")
put("feature_class", f"{_CAL},\n{_ENTRIES}", f"""
SELECT day, phase, language,
  CASE WHEN language IN ({", ".join(f"'{n}'" for n in INFRA_LANGUAGES)})
         AND phase IN ('agent-rollout', 'delivery-sprint') THEN 'chat_panel_agent_mode'
       WHEN language IN ('markdown', 'yaml', 'json') THEN 'chat_panel_ask_mode'
       ELSE 'code_completion' END AS feature,
  {_sums(LANGUAGE_METRICS)}
FROM en JOIN cal USING (day) GROUP BY 1, 2, 3, 4""")
put("signal_scores", _UD, f"""
SELECT *, agent_score >= 10 AS agent_signal, active_review_score >= 18 AS active_review_signal,
  passive_review_score >= 10 AS passive_review_signal
FROM (SELECT day, user_login,
    {AGENT_MODE} * 2 + {AGENT_EDIT} * 3 + {EDIT_MODE} AS agent_score,
    {ACCEPTED} + {PROMPTS} // 2 + {EDIT_MODE} AS active_review_score,
    {ACCEPTED} + {GENERATED} // 3 AS passive_review_score
  FROM ud)""")

put("sketched_agent_users", _ORG, f"""
SELECT day, {MONTHLY_AGENT}, {AGENT_1D}, {AGENT_7D}, {AGENT_28D}, true AS agree FROM od""")

# --- checks
put("reconcile", f"""{_BASE},
{_SUM},
early AS ({_user_days_of("ev WHERE hour(ts) < 22")}),
stored AS (SELECT sp.day, {_sums(METRICS)} FROM sp LEFT JOIN early ON early.day = sp.day
           GROUP BY sp.day)""", " UNION ALL ".join(
    f"""SELECT day, '{m}' AS field, a.{m} AS stored, b.{m} AS recomputed
FROM stored AS a FULL JOIN sums AS b USING (day) WHERE a.{m} IS DISTINCT FROM b.{m}"""
    for m in METRICS))
_BOUNDS = {
    ACTIVE_USERS: (3, 10), PROMPTS: (30, 260), GENERATED: (25, 364), ACCEPTED: (5, 208),
    AGENT_MODE: (0, 68), ASK_MODE: (6, 84), EDIT_MODE: (2, 65), CUSTOM_MODE: (0, 23),
    AGENT_EDIT: (0, 47),
}
put("range_violations", f"{_BASE},\n{_SUM}", " UNION ALL ".join(
    f"""SELECT day, '{f}' AS field, {f} AS value, CAST({lo} AS BIGINT) AS low,
CAST({hi} AS BIGINT) AS high FROM sums WHERE {f} NOT BETWEEN {lo} AND {hi}"""
    for f, (lo, hi) in _BOUNDS.items()))
put("bound_violations", """daily AS (
  SELECT o_orderpriority AS organization, CAST(o_orderdate AS DATE) AS date,
         count(*) AS orders, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS amount
  FROM orders GROUP BY ALL),
mean AS (
  SELECT organization, date_trunc('quarter', date) AS quarter, avg(orders) AS orders,
         avg(amount) AS amount FROM daily GROUP BY ALL),
long AS (
  SELECT d.organization, d.date, 'orders' AS field, CAST(d.orders AS DOUBLE) AS value,
         CAST(floor(m.orders * 0.5) AS BIGINT) AS low, CAST(floor(m.orders * 2) AS BIGINT) AS high
  FROM daily AS d JOIN mean AS m
    ON d.organization = m.organization AND m.quarter = date_trunc('quarter', d.date)
  UNION ALL
  SELECT d.organization, d.date, 'amount', CAST(d.amount AS DOUBLE), NULL,
         CAST(floor(m.amount * 2) AS BIGINT)
  FROM daily AS d JOIN mean AS m
    ON d.organization = m.organization AND m.quarter = date_trunc('quarter', d.date))""", """
SELECT organization, strftime(date, '%Y-%m-%d') AS day, field, value, low, high
FROM long WHERE value < low OR value > high""")
_OVER = f"{_UD},\nov AS (SELECT * REPLACE ({ACCEPTED} + {AGENT_EDIT} AS {ACCEPTED}) FROM ud)"
put("accept_violations", _OVER, f"SELECT * FROM ov WHERE {ACCEPTED} > {GENERATED}")
put("clamp_accepted", _OVER,
    f"SELECT * REPLACE (least({ACCEPTED}, {GENERATED}) AS {ACCEPTED}) FROM ov")
put("missing_members", _EV, """
SELECT 'u' || c_custkey AS user_login, c_name AS name FROM customer
WHERE 'u' || c_custkey NOT IN (SELECT user_login FROM ev)""")
put("duplicate_user_days", _EV, """
SELECT day, user_login, count(*) AS rows FROM ev GROUP BY ALL HAVING count(*) > 1""")
put("period_comparison", f"{_BASE},\n{_SUM}", "SELECT *, recent - early AS change FROM (" + (
    " UNION ALL ".join(
        f"""SELECT '{m}' AS field,
  (SELECT CAST(sum({m}) AS BIGINT) FROM (SELECT {m} FROM sums ORDER BY day LIMIT 20)) AS early,
  (SELECT CAST(sum({m}) AS BIGINT) FROM (SELECT {m} FROM sums ORDER BY day DESC LIMIT 20)) AS recent"""
        for m in METRICS)) + ")")
put("swing", f"{_BASE},\n{_SUM}", f"""
SELECT max({PROMPTS}) - min({PROMPTS}) AS prompts_swing,
  max({AGENT_MODE}) - min({AGENT_MODE}) AS agent_mode_swing,
  max({_RATE}) - min({_RATE}) AS acceptance_rate_swing FROM sums""")

# --- ledger
_RUNS = """started AS (
  SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS t0 FROM orders),
runs AS (
  SELECT strftime(t0, '%Y%m%dT%H%M%SZ') || '-' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS id,
    o_orderpriority AS source, 'timer' AS trigger, t0 AS started_at,
    CASE WHEN o_custkey % 10 <> 0 THEN 'org' || (o_custkey % 10) END AS org,
    lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS invocation_id,
    CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'P' THEN 'failed' ELSE 'succeeded' END
      AS status,
    CASE WHEN o_orderstatus <> 'O' THEN t0 + to_seconds(o_custkey % 600) END AS completed_at,
    CASE WHEN o_orderstatus = 'P' THEN 'failed at ' || o_custkey END AS error
  FROM started),
told AS (SELECT * REPLACE (strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS started_at,
                           strftime(completed_at, '%Y-%m-%dT%H:%M:%SZ') AS completed_at) FROM runs),
events_told AS (
  SELECT *, coalesce(completed_at, started_at) AS updated_at FROM told
  UNION ALL
  SELECT * REPLACE ('running' AS status, NULL AS completed_at, NULL AS error),
         started_at AS updated_at
  FROM told WHERE status <> 'running')"""
put("run_ledger_current", _RUNS, "SELECT * FROM told")


def _latest(keys):
    return f"""
SELECT 'latest:' || source AS latest_id, id AS run_id, * EXCLUDE (id)
FROM events_told
QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY updated_at DESC,
  CASE status WHEN 'running' THEN 0 ELSE 1 END DESC, id DESC) = 1"""


put("latest_per_source", _RUNS, _latest("source"))
put("latest_per_org_source", _RUNS, _latest("org, source"))
put("run_metrics", _RUNS, """
SELECT 'run:' || id AS id, 'usage-metrics-run' AS document_type,
  coalesce(org, 'mock') AS organization, source, id AS run_id, trigger, started_at, completed_at,
  status FROM told""")

# --- sources and sinks
_COUNTS = {
    "daily_summary": "SELECT count(*) FROM sp",
    "user_summary": "SELECT count(DISTINCT user_login) FROM ud",
    "user_daily_summary": "SELECT count(*) FROM ud",
    "language_summary": "SELECT count(*) FROM lang",
}
_ALL = f"{_BASE},\n{_LANG.removeprefix(_EV + ',')}"
put("record_counts", _ALL, " UNION ALL ".join(
    f"SELECT '{n}' AS artifact, ({q}) AS records"
    for n, q in {"org_metrics": "SELECT count(*) FROM sp",
                 "user_metrics": "SELECT count(*) FROM ud", **_COUNTS}.items()))
put("ndjson_roundtrip", _UD, "SELECT * FROM ud")
put("drift_union", _UD, f"""
SELECT * EXCLUDE ({AGENT_EDIT}, {FLAG_AGENT}),
  CASE WHEN day >= '2024-01-16' THEN {AGENT_EDIT} END AS {AGENT_EDIT},
  CASE WHEN day >= '2024-01-16' THEN {FLAG_AGENT} END AS {FLAG_AGENT} FROM ud""")
put("history_latest", _UD, "SELECT * FROM ud")
put("pinned_version", _UD, f"""
SELECT day, count(*) AS user_days, CAST(sum({ACTIVE_USERS}) AS BIGINT) AS {ACTIVE_USERS}, version
FROM ud, (VALUES (1), (2)) AS v (version)
WHERE version = 2 OR day < '2024-01-10' GROUP BY day, version""")
put("snapshot_read", _LANG, "SELECT * FROM lang")
put("view_documents", _ALL, " UNION ALL ".join(
    f"""SELECT '{prefix}:{n}' AS id, 'dashboard-view' AS document_type, 'mock' AS organization,
  'events' AS source, 'run-1' AS run_id, '2024-02-01T00:00:00Z' AS updated_at,
  '{n}' AS view_type, ({q}) AS items"""
    for n, q in _COUNTS.items() for prefix in ("latest", "run-1")))

_TOTALS = f"""SELECT user_login, count(*) AS active_days, {_sums(METRICS[1:])},
  {", ".join(f"count(*) FILTER ({f}) AS {f}_days" for f in FLAGS)},
  {", ".join(f"coalesce(bool_or({f}), false) AS {f}" for f in FLAGS)}
FROM ud GROUP BY user_login"""
_DOCUMENTS = " UNION ALL ".join(
    f"""SELECT '{name}' AS view_type, row_number() OVER (ORDER BY {order}) AS pos,
  CAST(to_json(t) AS VARCHAR) AS item FROM ({source}) AS t"""
    for name, order, source in [
        ("daily_summary", "day", f"SELECT day, {_list(METRICS + ORG_METRICS)} FROM od"),
        ("user_summary", f"{PROMPTS} DESC, user_login", _TOTALS),
        ("language_summary", "day, activity_score DESC, language", "SELECT * FROM lang")])
put("view_documents_bounded", f"""{_ORG},
{_LANG.removeprefix(_EV + ',')},
items AS (SELECT *, strlen(item) + 1 AS size FROM ({_DOCUMENTS})),
placed AS (
  SELECT *, (sum(size) OVER (PARTITION BY view_type ORDER BY pos) - size) // 2000 AS block,
    CASE WHEN size > 2000 THEN pos ELSE -1 END AS alone FROM items),
docs AS (
  SELECT view_type, block, alone, count(*) AS item_count,
    '[' || string_agg(item, ',' ORDER BY pos) || ']' AS items
  FROM placed GROUP BY ALL),
told AS (
  SELECT *, row_number() OVER (PARTITION BY view_type ORDER BY block, alone) AS number,
    count(*) OVER (PARTITION BY view_type) AS total FROM docs)""", """
SELECT prefix || ':' || view_type || CASE WHEN total > 1 THEN ':' || number ELSE '' END AS id,
  'dashboard-view' AS document_type, 'acme' AS organization, 'events' AS source,
  'run-1' AS run_id, '2024-02-01T00:00:00Z' AS updated_at, view_type, number, total, item_count,
  items
FROM told, (VALUES ('latest'), ('run-1')) AS p (prefix)""")

# every day is restated in full, so a refresh ends in the whole table
ORACLE["refresh_available_now"] = ORACLE["user_daily_summary"]
ORACLE["refresh_org_rows"] = ORACLE["daily_summary"]
ORACLE["refresh_user_totals"] = ORACLE["user_summary"]
put("refresh_restated_languages", _LANG,
    "SELECT * FROM lang WHERE dayofmonth(CAST(day AS DATE)) % 2 = 1")
for _name in ("summary_kpis", "user_table", "language_ranking"):
    ORACLE[f"published_{_name}"] = ORACLE[_name]
put("ingest_window", f"{_BASE}", "SELECT * FROM ud WHERE day IN (SELECT day FROM sp ORDER BY day DESC LIMIT 14)")
ORACLE["ingest_landed_window"] = ORACLE["ingest_window"]
