"""The same answers in DuckDB SQL, written from the definitions: plain joins, no shared code."""

from __future__ import annotations

from datetime import datetime, timezone

HOUR, DAY = 3_600_000, 86_400_000


def ms(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()) * 1000


def day(text: str) -> str:
    return f"BETWEEN {ms(text)} AND {ms(text) + DAY - 1000}"


def days(first: str, last: str) -> str:
    return f"BETWEEN {ms(first)} AND {ms(last) + DAY - 1000}"


def event_type() -> str:
    """How the test table's kinds map to event types."""
    return """CASE WHEN kind = 'signup' THEN 'USER_CREATED_ACCOUNT' WHEN kind = 'purchase' THEN 'SAVING_PAYMENT_SUCCESSFUL'
         WHEN kind = 'error' THEN 'ADMIN_SETTLED_WITHDRAWAL'
         WHEN kind = 'view' AND k % 2 = 0 THEN 'USER_OPENED_APP'
         WHEN kind = 'view' AND k < 54 THEN ['USER_ENTERED_INTRO', 'USER_ENTERED_REFERRAL_SCREEN',
           'USER_ENTERED_VALID_REFERRAL_CODE', 'USER_PROFILE_REGISTER_SUCCEEDED', 'USER_PROFILE_PASSWORD_SUCCEEDED',
           'USER_INITIATED_FIRST_ADD_CASH', 'USER_LEFT_APP_AT_PAYMENT_LINK', 'USER_RETURNED_TO_PAYMENT_LINK',
           'PAYMENT_SUCCEEDED'][(k // 2) % 9 + 1]
         WHEN kind = 'view' THEN 'USER_INITIATED_ADD_CASH'
         WHEN k % 4 = 0 THEN 'BOOST_CREATED' WHEN k % 4 = 1 THEN 'BOOST_REDEEMED'
         WHEN k % 4 = 2 THEN 'BOOST_EXPIRED' ELSE 'MESSAGE_SENT' END"""


# --- the test tables as event log, money movements and flags -------------------------------
BASE = f"""
raw AS (
  SELECT event_id, cast(user_id AS varchar) AS user_id, event_type AS kind, value,
         cast(json_extract(props, '$.k') AS int) AS k, epoch_us(ts) // 1000 AS t, ts
  FROM events),
ev AS (
  SELECT user_id,
    {event_type()} AS event_type,
    t, CASE WHEN kind = 'view' OR event_id % 5 = 0 THEN 'AMPLITUDE' ELSE 'INTERNAL_SERVICES' END AS source,
    t + (event_id % 7) * 60000 AS c,
    CASE WHEN kind = 'click' AND k % 4 < 3 THEN
      '{{"boostId":"b' || k || '","boostType":"' || CASE k % 3 WHEN 0 THEN 'GAME' WHEN 1 THEN 'SIMPLE' ELSE 'SOCIAL' END
      || '","boostCategory":"' || CASE k % 3 WHEN 0 THEN 'TAP_SCREEN' WHEN 1 THEN 'SIMPLE_SAVE' ELSE 'NUMBER_FRIENDS' END
      || '","boostAmount":"' || (1 + k) || '","boostUnit":"WHOLE_CURRENCY","boostStartTime":' || t
      || ',"boostEndTime":' || (t + (1 + k % 7) * {DAY})
      || CASE WHEN k % 5 = 0 THEN '' ELSE ',"statusConditions":{{"UNLOCKED":["app_opened"],"REDEEMED":["save_greater_than #{{'
         || (10 * (1 + k)) || '::WHOLE_CURRENCY::ZAR}}"]}}' END || '}}'
    ELSE '' END AS context
  FROM raw),
ub AS (
  SELECT user_id, 'acc-' || user_id AS account_id,
    CASE kind WHEN 'purchase' THEN 'SAVING_EVENT' ELSE 'WITHDRAWAL' END AS tx,
    cast(round(value * 100) AS bigint) * CASE WHEN t >= {ms('2024-01-29')} AND k % 5 = 0 THEN 1000000 ELSE 50000 END AS amount, 'HUNDREDTH_CENT' AS unit, t, t + (event_id % 7) * 60000 AS c
  FROM raw WHERE kind IN ('purchase', 'error')),
saves AS (SELECT user_id, amount, t FROM ub WHERE tx = 'SAVING_EVENT'),
wds AS (SELECT user_id, amount, t FROM ub WHERE tx = 'WITHDRAWAL'),
fl AS (SELECT * FROM (
  SELECT user_id, account_id, c AS created_at,
    CASE WHEN tx = 'SAVING_EVENT' AND amount > 1000000000 THEN 'single_very_large_saving_event'
         WHEN tx = 'SAVING_EVENT' AND amount > 500000000 THEN 'saving_events_greater_than_benchmark_within_six_months'
         WHEN tx = 'SAVING_EVENT' AND amount > 400000000 THEN 'latest_saving_event_greater_than_six_months_average'
         WHEN tx = 'WITHDRAWAL' AND amount > 500000000 THEN 'withdrawals_within_two_days_of_saving_events_during_one_month'
         WHEN tx = 'WITHDRAWAL' AND amount > 400000000 THEN 'withdrawals_within_one_day_of_saving_events_during_one_week'
    END AS rule_label
  FROM ub WHERE c < {ms('2024-01-15')}) WHERE rule_label IS NOT NULL),
offers AS (
  SELECT user_id, t, c, context, json_extract_string(context, '$.boostId') AS boost_id,
    json_extract_string(context, '$.boostType') AS boost_type,
    json_extract_string(context, '$.boostCategory') AS boost_category,
    cast(json_extract_string(context, '$.boostAmount') AS double) AS boost_amount,
    row_number() OVER (ORDER BY t, user_id, context) AS rid
  FROM ev WHERE event_type LIKE 'BOOST_CREATED%'),
evsaves AS (SELECT user_id, t, c FROM ev WHERE event_type = 'SAVING_PAYMENT_SUCCESSFUL'),
evwds AS (SELECT user_id, t FROM ev WHERE event_type = 'ADMIN_SETTLED_WITHDRAWAL'),
opens AS (SELECT user_id, t FROM ev WHERE event_type = 'USER_CREATED_ACCOUNT')
"""


def q(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n" + body


SQL: dict[str, str] = {}

# --- funnel --------------------------------------------------------------------------------


def drop_off(step: str, nexts: str, first: str, last: str) -> str:
    return (
        f"SELECT DISTINCT user_id FROM ev WHERE event_type = '{step}' AND t {days(first, last)} "
        f"AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type IN ({nexts}) AND t <= {ms(last) + DAY - 1000})"
    )


CHAIN = [
    ("USER_CREATED_ACCOUNT", "USER_OPENED_APP"),
    ("USER_OPENED_APP", "USER_INITIATED_ADD_CASH"),
    ("USER_INITIATED_ADD_CASH", "SAVING_PAYMENT_SUCCESSFUL"),
]
SQL["drop_off_users"] = q(
    drop_off("USER_CREATED_ACCOUNT", "'SAVING_PAYMENT_SUCCESSFUL'", "2024-01-01", "2024-01-04")
)
SQL["recovered_users_intent"] = q(f"""
SELECT DISTINCT user_id FROM ev WHERE event_type = 'SAVING_PAYMENT_SUCCESSFUL' AND t {day('2024-01-04')}
  AND user_id IN (SELECT user_id FROM ev WHERE event_type = 'USER_CREATED_ACCOUNT' AND t < {ms('2024-01-04')})
  AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type = 'SAVING_PAYMENT_SUCCESSFUL' AND t < {ms('2024-01-04')})
""")
SQL["recovered_users_literal"] = q(f"""
SELECT DISTINCT user_id FROM ev WHERE event_type = 'SAVING_PAYMENT_SUCCESSFUL' AND t {day('2024-01-04')}
  AND user_id IN (SELECT user_id FROM ev WHERE event_type = 'USER_CREATED_ACCOUNT' AND t {day('2024-01-04')}
  AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type = 'SAVING_PAYMENT_SUCCESSFUL' AND t <= {ms('2024-01-05') - 1000}))
""")
SQL["drop_off_counts"] = q(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{a}' AS step, '{b}' AS next_steps, "
        f"(SELECT count(*) FROM ({drop_off(a, repr(b), '2024-01-02', '2024-01-04')})) AS drop_offs, "
        f"(SELECT count(DISTINCT user_id) FROM ev WHERE event_type = '{b}' AND t {day('2024-01-04')} "
        f"AND user_id IN (SELECT user_id FROM ev WHERE event_type = '{a}' AND t < {ms('2024-01-04')}) "
        f"AND user_id NOT IN (SELECT user_id FROM ev WHERE event_type = '{b}' AND t < {ms('2024-01-04')})) AS recoveries"
        for i, (a, b) in enumerate(CHAIN)
    )
)
STAGES = [
    ("USER_INITIATED_FIRST_ADD_CASH", "USER_LEFT_APP_AT_PAYMENT_LINK"),
    ("USER_INITIATED_ADD_CASH", "USER_LEFT_APP_AT_PAYMENT_LINK"),
    ("USER_LEFT_APP_AT_PAYMENT_LINK", "USER_RETURNED_TO_PAYMENT_LINK"),
    ("USER_RETURNED_TO_PAYMENT_LINK", "PAYMENT_SUCCEEDED"),
    ("USER_ENTERED_REFERRAL_SCREEN", "USER_ENTERED_VALID_REFERRAL_CODE"),
    ("USER_ENTERED_VALID_REFERRAL_CODE", "USER_PROFILE_REGISTER_SUCCEEDED"),
    ("USER_PROFILE_REGISTER_SUCCEEDED", "USER_PROFILE_PASSWORD_SUCCEEDED"),
    ("USER_PROFILE_PASSWORD_SUCCEEDED", "USER_INITIATED_FIRST_ADD_CASH"),
]
SQL["drop_off_by_stage"] = q(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{a}' AS step, '{b}' AS next_steps, count(*) AS drop_offs "
        f"FROM ({drop_off(a, repr(b), '2024-01-02', '2024-01-02')})"
        for i, (a, b) in enumerate(STAGES)
    )
)
SQL["drop_off_daily_avg"] = q(
    "SELECT step, round(sum(n) / 3.0, 6) AS daily_average FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS step, count(*) AS n FROM ({drop_off(a, repr(b), d, d)})"
        for a, b in CHAIN
        for d in ("2024-01-02", "2024-01-03", "2024-01-04")
    )
    + ") GROUP BY step"
)

# --- metrics -------------------------------------------------------------------------------
AS_OF, YESTERDAY = "2024-01-20", "2024-01-19"


def users(kind: str, when: str, source: str) -> str:
    return f"SELECT DISTINCT user_id FROM ev WHERE event_type = '{kind}' AND source = '{source}' AND t {when}"


APP, SERVICE = "AMPLITUDE", "INTERNAL_SERVICES"
TO_TODAY = f"BETWEEN {ms(YESTERDAY)} AND {ms(AS_OF)}"
WEEK = days("2024-01-13", YESTERDAY)

for name, tx in (("total_saved", "SAVING_EVENT"), ("total_withdrawn", "WITHDRAWAL")):
    SQL[name] = q(
        f"SELECT round(coalesce(sum(amount), 0) / 10000.0, 6) AS total_amount FROM ub WHERE tx = '{tx}' AND t {day(YESTERDAY)}"
    )
SQL["users_by_transaction"] = q(
    f"SELECT count(DISTINCT user_id) AS users FROM ub WHERE tx = 'SAVING_EVENT' AND t {day(YESTERDAY)}"
)
SQL["users_by_event"] = q(f"SELECT count(*) AS users FROM ({users('USER_OPENED_APP', day(YESTERDAY), APP)})")
SQL["total_users"] = q(
    f"SELECT count(DISTINCT user_id) AS users FROM ev WHERE source = '{SERVICE}' AND t <= {ms(AS_OF)}"
)
SQL["user_ids_by_event"] = q(users("USER_CREATED_ACCOUNT", day(YESTERDAY), SERVICE))
SQL["users_in_list_that_did"] = q(
    f"SELECT count(*) AS users FROM ({users('SAVING_PAYMENT_SUCCESSFUL', WEEK, SERVICE)}) "
    f"WHERE user_id IN ({users('USER_CREATED_ACCOUNT', WEEK, SERVICE)})"
)
SQL["new_users_that_saved"] = q(
    f"SELECT count(*) AS users FROM ({users('USER_OPENED_APP', WEEK, APP)}) "
    f"WHERE user_id IN ({users('USER_CREATED_ACCOUNT', WEEK, SERVICE)})"
)
SQL["saved_vs_tried_ratio"] = q(f"""
SELECT round(CASE WHEN b = 0 THEN 0 ELSE a / b END, 6) AS ratio FROM (SELECT
  (SELECT count(DISTINCT user_id) FROM ub WHERE tx = 'SAVING_EVENT' AND t {day(YESTERDAY)})::double AS a,
  (SELECT count(*) FROM ({users('USER_INITIATED_ADD_CASH', day(YESTERDAY), APP)}))::double AS b)
""")
SQL["pct_not_returned"] = q(
    f"""
SELECT round(CASE WHEN (SELECT count(*) FROM a) = 0 THEN 0 ELSE
  100.0 * (SELECT count(*) FROM a WHERE user_id NOT IN (SELECT user_id FROM b)) / (SELECT count(*) FROM a) END, 6) AS percent
""",
    f"a AS ({users('USER_CREATED_ACCOUNT', day('2024-01-17'), SERVICE)})",
    f"b AS ({users('USER_OPENED_APP', days('2024-01-18', AS_OF), APP)})",
)
SQL["daily_avg_users_by_event"] = q(
    "SELECT round(sum(n) / 3.0, 6) AS daily_average FROM ("
    + " UNION ALL ".join(
        f"SELECT count(*) AS n FROM ({users('USER_OPENED_APP', day(d), APP)})"
        for d in ("2024-01-17", "2024-01-18", "2024-01-19")
    )
    + ")"
)
SQL["daily_avg_users_by_transaction"] = q(
    "SELECT round(sum(n) / 10.0, 6) AS daily_average FROM ("
    + " UNION ALL ".join(
        f"SELECT count(DISTINCT user_id) AS n FROM ub WHERE tx = 'SAVING_EVENT' AND t {day(f'2024-01-{d}')}"
        for d in range(10, 20)
    )
    + ")"
)
SQL["avg_signups"] = q(
    f"SELECT round(count(*) / 3.0, 6) AS daily_average FROM ({users('USER_CREATED_ACCOUNT', days('2024-01-17', YESTERDAY), SERVICE)})"
)
SQL["users_with_context_value"] = q(
    f"SELECT count(DISTINCT user_id) AS users FROM ev WHERE source = '{SERVICE}' AND t {days('2024-01-01', AS_OF)} "
    "AND event_type LIKE '%BOOST_EXPIRED%' AND context LIKE '%SOCIAL%'"
)
SQL["context_values"] = q(
    "SELECT user_id, json_extract_string(context, '$.boostId') AS value FROM ev WHERE event_type LIKE 'BOOST_%'"
)
EXPIRED = [
    f"today AS (SELECT json_extract_string(context, '$.boostId') AS boost_id FROM ev "
    f"WHERE event_type = 'BOOST_EXPIRED' AND source = '{SERVICE}' AND t {day(AS_OF)})",
    f"gone AS (SELECT user_id, context, json_extract_string(context, '$.boostId') AS own FROM ev "
    f"WHERE event_type LIKE '%BOOST_EXPIRED%' AND source = '{SERVICE}' AND t BETWEEN -2208988800 AND {ms(AS_OF) + DAY - 1000})",
    "ids AS (SELECT boost_id, count(*) AS times FROM today GROUP BY boost_id)",
]
OFFERED = {
    "": "SELECT boost_id, times, (SELECT count(DISTINCT user_id) FROM gone WHERE contains(context, boost_id)) AS users FROM ids",
    "_by_key": "SELECT boost_id, times, (SELECT count(DISTINCT user_id) FROM gone WHERE own = boost_id) AS users FROM ids",
}
for suffix, body in OFFERED.items():
    SQL[f"users_offered_boosts{suffix}"] = q(body, *EXPIRED)
    SQL[f"pct_boosts_expired{suffix}"] = q(
        f"SELECT round(coalesce(100.0 * sum(times) / nullif(sum(times * users), 0), 0), 6) AS percent FROM ({body})",
        *EXPIRED,
    )
SQL["users_entered"] = q(f"SELECT count(*) AS users FROM ({users('USER_ENTERED_INTRO', day(YESTERDAY), APP)})")
SQL["users_that_tried_saving"] = q(
    f"SELECT count(*) AS users FROM ({users('USER_INITIATED_ADD_CASH', day(YESTERDAY), APP)})"
)
SQL["compare_withdrew_saved"] = q(f"""
SELECT 'Number of Users that Withdrew ' || CASE WHEN w > s THEN 'GREATER THAN' WHEN w < s THEN 'LESS THAN' ELSE 'EQUAL' END
  || ' Number of Users that Saved' AS comparison
FROM (SELECT count(DISTINCT CASE WHEN tx = 'WITHDRAWAL' THEN user_id END) AS w,
             count(DISTINCT CASE WHEN tx = 'SAVING_EVENT' THEN user_id END) AS s FROM ub WHERE t {day(YESTERDAY)})
""")
JOINED_Y = users("USER_CREATED_ACCOUNT", day(YESTERDAY), SERVICE)
JOINED_W = users("USER_CREATED_ACCOUNT", WEEK, SERVICE)
MESSAGED = users("MESSAGE_SENT", TO_TODAY, SERVICE)
SQL["daily_metrics"] = q(
    f"""
SELECT position, metric_name, round(v, 6) AS metric_value, display FROM (
SELECT 1 AS position, 'Total users @ start of day' AS metric_name, n1::double AS v, n1::varchar AS display FROM n
UNION ALL SELECT 2, 'Total amount saved yesterday', n2 / 10000.0, 'R' || regexp_replace((n2::decimal(38,4) / 10000)::decimal(38,4)::varchar, '(\\.\\d+?)0*$', '\\1') FROM n
UNION ALL SELECT 3, 'How many saved yesterday', n3, n3::varchar FROM n
UNION ALL SELECT 4, 'Number users opened account yesterday', n4, n4::varchar FROM n
UNION ALL SELECT 5, 'Number of those who saved', n5, n5::varchar FROM n
UNION ALL SELECT 6, 'Number opened account in last week', n6, n6::varchar FROM n
UNION ALL SELECT 7, '% who completed save', round_even(coalesce(100.0 * n7 / nullif(n6, 0), 0), 2), printf('%.2f', round_even(coalesce(100.0 * n7 / nullif(n6, 0), 0), 2)) FROM n
UNION ALL SELECT 8, 'Number users sent msg yesterday', n8, n8::varchar FROM n
UNION ALL SELECT 9, 'Number of those who opened app', n9, n9::varchar FROM n
UNION ALL SELECT 10, '% of messages led to open', round_even(coalesce(100.0 * n9 / nullif(n8, 0), 0), 0), round_even(coalesce(100.0 * n9 / nullif(n8, 0), 0), 0)::bigint || '%' FROM n
UNION ALL SELECT 11, '% whose boosts expired', p, printf('%.6f', p) FROM x)
""",
    *EXPIRED,
    f"x AS (SELECT round(coalesce(100.0 * sum(times) / nullif(sum(times * users), 0), 0), 6) AS p FROM ({OFFERED['']}))",
    f"""n AS (SELECT
  (SELECT count(DISTINCT user_id) FROM ev WHERE source = '{SERVICE}' AND t <= {ms(AS_OF)}) AS n1,
  (SELECT coalesce(sum(amount), 0) FROM ub WHERE tx = 'SAVING_EVENT' AND t {day(YESTERDAY)}) AS n2,
  (SELECT count(*) FROM ({users('SAVING_PAYMENT_SUCCESSFUL', day(YESTERDAY), SERVICE)})) AS n3,
  (SELECT count(*) FROM ({JOINED_Y})) AS n4,
  (SELECT count(*) FROM ({users('SAVING_PAYMENT_SUCCESSFUL', TO_TODAY, APP)}) WHERE user_id IN ({JOINED_Y})) AS n5,
  (SELECT count(*) FROM ({JOINED_W})) AS n6,
  (SELECT count(*) FROM ({users('SAVING_PAYMENT_SUCCESSFUL', WEEK, SERVICE)}) WHERE user_id IN ({JOINED_W})) AS n7,
  (SELECT count(*) FROM ({MESSAGED})) AS n8,
  (SELECT count(*) FROM ({users('USER_OPENED_APP', TO_TODAY, APP)}) WHERE user_id IN ({MESSAGED})) AS n9)""",
)

# --- fraud ---------------------------------------------------------------------------------
F_AS_OF = "2024-01-30"
NEVER = -2208988800


def pair_count(hours: int, since: int, strict: bool = False, rule: str = "") -> str:
    cut = f"LEFT JOIN cuts f ON f.user_id = w.user_id AND f.rule_label = '{rule}'" if rule else ""
    after = f"AND w.t > coalesce(f.cut, {NEVER}) AND s.t > coalesce(f.cut, {NEVER})" if rule else ""
    return (
        f"SELECT w.user_id, count(*) AS pairs FROM wds w JOIN saves s ON w.user_id = s.user_id {cut} "
        f"WHERE s.amount * 0.95::double <= w.amount AND w.amount <= s.amount AND w.t - s.t <= {hours * HOUR} "
        f"AND w.t >= {since} AND s.t >= {since} {after} {'AND w.t >= s.t' if strict else ''} GROUP BY w.user_id"
    )


SQL["quick_withdrawal_pairs"] = q(pair_count(48, ms("2023-12-31")))
SQL["quick_withdrawal_pairs_strict"] = q(pair_count(48, ms("2023-12-31"), True))
SQL["last_flag_times"] = q(
    "SELECT user_id, rule_label, max(created_at) AS last_flag_time FROM fl GROUP BY user_id, rule_label"
)
SIX_MONTHS = ms("2023-08-01")  # 182 days before
CUTS = "cuts AS (SELECT user_id, rule_label, max(created_at) AS cut FROM fl GROUP BY user_id, rule_label)"


def since_cut(label: str) -> str:
    return f"u.t > coalesce((SELECT cut FROM cuts f WHERE f.user_id = u.user_id AND f.rule_label = '{label}'), {NEVER})"


TWO_DAYS = "withdrawals_within_two_days_of_saving_events_during_one_month"
ONE_DAY = "withdrawals_within_one_day_of_saving_events_during_one_week"
FACTS = f"""
{CUTS},
marked AS (SELECT *, {since_cut('single_very_large_saving_event')} AS after1,
  {since_cut('saving_events_greater_than_benchmark_within_six_months')} AS after2,
  {since_cut('latest_saving_event_greater_than_six_months_average')} AS after3 FROM ub u),
facts AS (
  SELECT u.user_id, max(account_id) AS account_id,
    count(*) FILTER (tx = 'SAVING_EVENT' AND amount > 1000000000 AND after1) AS saves_above_100k,
    count(*) FILTER (tx = 'SAVING_EVENT' AND amount > 500000000 AND after2 AND u.t >= {SIX_MONTHS}) AS saves_above_50k_6m,
    coalesce(arg_max(amount, u.t::hugeint * 1000000000000 + amount) FILTER (tx = 'SAVING_EVENT' AND after3), 0) / 10000.0 AS latest_save,
    coalesce(avg(amount) FILTER (tx = 'SAVING_EVENT' AND after3 AND u.t >= {SIX_MONTHS}), 0) / 10000.0 * 10 AS average_save_6m_x10,
    coalesce(any_value(p1.pairs), 0) AS within_48h_30d, coalesce(any_value(p2.pairs), 0) AS within_24h_7d
  FROM marked u
    LEFT JOIN ({pair_count(48, ms('2023-12-31'), rule=TWO_DAYS)}) p1 ON p1.user_id = u.user_id
    LEFT JOIN ({pair_count(24, ms('2024-01-23'), rule=ONE_DAY)}) p2 ON p2.user_id = u.user_id
  GROUP BY u.user_id)"""
SQL["fraud_facts"] = q(
    "SELECT user_id, account_id, saves_above_100k, saves_above_50k_6m, round(latest_save, 6) AS latest_save, "
    "round(average_save_6m_x10, 6) AS average_save_6m_x10, within_48h_30d, within_24h_7d FROM facts",
    FACTS,
)
_RULES = [
    ("saves_above_100k > 0", "single_very_large_saving_event", "User has a saving_event greater than 100,000 rands"),
    (
        "saves_above_50k_6m >= 3",
        "saving_events_greater_than_benchmark_within_six_months",
        "User has saving_event 50,000 rands 3 or more times in the last 6 months",
    ),
    (
        "latest_save > average_save_6m_x10",
        "latest_saving_event_greater_than_six_months_average",
        "User''s latest inward transfer > 10x past 6 month average transfer",
    ),
    (
        "within_48h_30d > 3",
        "withdrawals_within_two_days_of_saving_events_during_one_month",
        "User has more than 3 instances within a 30 day cycle, of withdrawal of saving_event within 48 hours of saving_eventing",
    ),
    (
        "within_24h_7d > 1",
        "withdrawals_within_one_day_of_saving_events_during_one_week",
        "User has more than 1 instance within a 7 day cycle, of withdrawal instruction of saving_event transferred within 24 hours",
    ),
]
_NONE = "NOT (" + " OR ".join(c for c, _, _ in _RULES) + ")"
SQL["fraud_flags"] = q(
    " UNION ALL ".join(
        f"SELECT user_id, account_id, '{label}' AS rule_label, '{reason}' AS reason, 'PENDING_CONFIRMATION' AS accuracy, "
        f"{ms(F_AS_OF)} AS created_at, {ms(F_AS_OF)} AS updated_at FROM facts WHERE {cond}"
        for cond, label, reason in _RULES
        + [(_NONE, "user_not_flagged", "User was not flagged by any of the rules")]
    ),
    FACTS,
)


def _period(i: int, first: str, stop: str) -> list[str]:
    """The flags given after the i-th batch of payments: its users' whole history, cut off by the flags of earlier batches."""
    day = "strftime(make_timestamp(c * 1000), '%Y-%m-%d')"
    given = " UNION ALL ".join(f"SELECT * FROM given{n}" for n in range(i)) or (
        "SELECT '' AS user_id, '' AS account_id, '' AS rule_label, '' AS reason, 0 AS created_at WHERE false"
    )
    since = lambda days: f"(SELECT today - {days * DAY} FROM now{i})"
    cut = lambda label, u="u": (
        f"{u}.t > coalesce((SELECT cut FROM cuts{i} f WHERE f.user_id = {u}.user_id AND f.rule_label = '{label}'), {NEVER})"
    )
    pairs = lambda hours, days, label: (
        f"(SELECT count(*) FROM known{i} w JOIN known{i} s ON w.user_id = s.user_id WHERE w.user_id = u.user_id "
        f"AND w.tx = 'WITHDRAWAL' AND s.tx = 'SAVING_EVENT' AND s.amount * 0.95::double <= w.amount AND w.amount <= s.amount "
        f"AND w.t - s.t <= {hours * HOUR} AND w.t >= {since(days)} AND s.t >= {since(days)} AND {cut(label, 'w')} AND {cut(label, 's')})"
    )
    labels = [label for _, label, _ in _RULES]
    return [
        f"batch{i} AS (SELECT * FROM ub WHERE {day} >= '{first}' AND {day} < '{stop}')",
        f"now{i} AS (SELECT max(c) AS now, max(c) // {DAY} * {DAY} AS today FROM batch{i})",
        f"known{i} AS (SELECT * FROM ub WHERE {day} < '{stop}' AND user_id IN (SELECT user_id FROM batch{i}))",
        f"cuts{i} AS (SELECT user_id, rule_label, max(created_at) AS cut FROM ({given}) GROUP BY user_id, rule_label)",
        f"""marked{i} AS (SELECT *, {cut(labels[0])} AS after1, {cut(labels[1])} AS after2, {cut(labels[2])} AS after3,
  u.t >= {since(182)} AS half FROM known{i} u)""",
        f"""facts{i} AS (SELECT u.user_id, max(account_id) AS account_id,
    count(*) FILTER (tx = 'SAVING_EVENT' AND amount > 1000000000 AND after1) AS saves_above_100k,
    count(*) FILTER (tx = 'SAVING_EVENT' AND amount > 500000000 AND after2 AND half) AS saves_above_50k_6m,
    coalesce(arg_max(amount, u.t::hugeint * 1000000000000 + amount) FILTER (tx = 'SAVING_EVENT' AND after3), 0) / 10000.0 AS latest_save,
    coalesce(avg(amount) FILTER (tx = 'SAVING_EVENT' AND after3 AND half), 0) / 10000.0 * 10 AS average_save_6m_x10,
    {pairs(48, 30, TWO_DAYS)} AS within_48h_30d, {pairs(24, 7, ONE_DAY)} AS within_24h_7d
  FROM marked{i} u GROUP BY u.user_id)""",
        f"given{i} AS ("
        + " UNION ALL ".join(
            f"SELECT user_id, account_id, '{label}' AS rule_label, '{reason}' AS reason, (SELECT now FROM now{i}) AS created_at "
            f"FROM facts{i} WHERE {cond}"
            for cond, label, reason in _RULES
            + [(_NONE, "user_not_flagged", "User was not flagged by any of the rules")]
        )
        + ")",
    ]


SQL["fraud_stream"] = q(
    "SELECT user_id, account_id, rule_label, reason, 'PENDING_CONFIRMATION' AS accuracy, created_at, created_at AS updated_at "
    "FROM (SELECT * FROM given0 UNION ALL SELECT * FROM given1 UNION ALL SELECT * FROM given2)",
    *_period(0, "0000-00-00", "2024-01-11"),
    *_period(1, "2024-01-11", "2024-01-21"),
    *_period(2, "2024-01-21", "9999-99-99"),
)
SQL["flags_for_user"] = q("SELECT user_id, account_id, rule_label, created_at FROM fl WHERE user_id = '3' AND account_id = 'acc-3'")

# --- cohorts -------------------------------------------------------------------------------
C_AS_OF = ms("2024-03-01")
MONTH = "strftime(date_trunc('month', make_timestamp({} * 1000)), '%Y-%m-%d')"
WTS = """wts AS (SELECT w.user_id, w.t AS withdrawal_time, min(s.t) AS next_save_time, count(*) AS subsequent_save_count
  FROM evwds w JOIN saves s ON w.user_id = s.user_id AND s.t > w.t GROUP BY w.user_id, w.t)"""
OTW = f"""otw AS (SELECT o.user_id, o.t AS account_open_time, min(w.t) AS first_withdraw_time,
  trunc((min(w.t) - o.t) / {DAY}.0)::bigint AS days_to_withdraw
  FROM opens o JOIN evwds w ON o.user_id = w.user_id GROUP BY o.user_id, o.t)"""
MSG = f"""msg AS (SELECT m.user_id, m.h AS message_hour, min(a.t) AS earliest_app_open
  FROM (SELECT user_id, t // {HOUR} * {HOUR} AS h FROM ev WHERE event_type = 'MESSAGE_SENT') m
  LEFT JOIN (SELECT user_id, t FROM ev WHERE event_type = 'USER_OPENED_APP') a ON m.user_id = a.user_id AND m.h < a.t
  WHERE m.h < {C_AS_OF - 2 * DAY} AND (a.t IS NULL OR (a.t - m.h) // {HOUR} < 48) GROUP BY m.user_id, m.h)"""
BNS = f"""bns AS (SELECT b.user_id, b.c AS boost_creation_time, min(s.c) AS earliest_save_time
  FROM offers b LEFT JOIN evsaves s ON b.user_id = s.user_id AND b.c < s.c
  WHERE b.c < {C_AS_OF - 2 * DAY} AND (s.c IS NULL OR (s.c - b.c) // {HOUR} < 96) GROUP BY b.user_id, b.c)"""
COHORT = """cohort AS (SELECT o.user_id, o.t AS account_open_time, count(*) AS count_save_events,
  max(s.amount) / 10000.0 AS max_save, sum(s.amount) / 10000.0 AS total_save, avg(s.amount) / 10000.0 AS average_save
  FROM opens o JOIN saves s ON o.user_id = s.user_id GROUP BY o.user_id, o.t)"""
LATE = f"""late AS (SELECT f.user_id, f.t AS first_save_time, count(*) AS later_saves, avg(s.amount) / 10000.0 AS average_save
  FROM (SELECT user_id, min(t) AS t FROM evsaves GROUP BY user_id) f
  JOIN saves s ON f.user_id = s.user_id AND s.t - f.t >= {15 * DAY}
  WHERE f.t < {C_AS_OF - 30 * DAY} GROUP BY f.user_id, f.t)"""
SINCE = f"since AS (SELECT ({C_AS_OF} - max(t)) // {DAY} AS d FROM saves GROUP BY user_id)"

SQL["last_save_per_user"] = q("SELECT user_id, max(t) AS save_time FROM saves GROUP BY user_id")
SQL["user_first_seen_total"] = q(
    "SELECT user_id, min(t) AS first_seen, sum(amount)::bigint AS total_amount FROM ub GROUP BY user_id"
)
SQL["monthly_save_totals"] = q(
    "SELECT month(make_timestamp(t * 1000))::int AS save_month, unit, sum(amount)::bigint AS sum_amount, "
    "round(avg(amount), 6) AS avg_amount, count(*) AS saves FROM ub WHERE tx = 'SAVING_EVENT' GROUP BY 1, 2"
)
SQL["never_redeemed_boosts"] = q(
    "SELECT user_id, 'BOOST_CREATED' AS event_type, context, c AS boost_creation_time FROM offers "
    "WHERE user_id NOT IN (SELECT user_id FROM ev WHERE event_type = 'BOOST_REDEEMED')"
)
SQL["withdraw_then_save"] = q("SELECT * FROM wts", WTS)
SQL["returning_savers"] = q("SELECT count(DISTINCT user_id) AS users FROM wts", WTS)
SQL["open_to_withdrawal"] = q("SELECT * FROM otw", OTW)
SQL["days_to_withdraw_summary"] = q(
    """SELECT count(*) AS count, round(avg(days_to_withdraw), 6) AS mean, round(stddev_samp(days_to_withdraw), 6) AS std,
  min(days_to_withdraw) AS min, quantile_cont(days_to_withdraw, 0.25) AS q25, quantile_cont(days_to_withdraw, 0.5) AS q50,
  quantile_cont(days_to_withdraw, 0.75) AS q75, max(days_to_withdraw) AS max FROM otw""",
    OTW,
)
SQL["message_app_open"] = q("SELECT * FROM msg", MSG)
SQL["message_open_rate"] = q(
    f"SELECT {MONTH.format('message_hour')} AS month, count(*) AS messages, count(earliest_app_open) AS opens, "
    "round(count(earliest_app_open) / count(*)::double, 6) AS open_rate FROM msg GROUP BY 1",
    MSG,
)
SQL["boost_next_save"] = q("SELECT * FROM bns", BNS)
SQL["boost_induce_rate"] = q(
    f"SELECT {MONTH.format('boost_creation_time')} AS month, count(*) AS offers, count(earliest_save_time) AS induced, "
    "round(count(earliest_save_time) / count(*)::double, 6) AS induce_rate FROM bns GROUP BY 1",
    BNS,
)
SQL["boost_monthly_stats"] = q(
    "SELECT month(make_timestamp(boost_creation_time * 1000))::int AS month, count(*) AS offers, count(earliest_save_time) AS induced, "
    "count(DISTINCT user_id) AS unique_users, round(count(*) / count(DISTINCT user_id)::double, 6) AS boost_per_user, "
    "round(count(earliest_save_time) / count(DISTINCT user_id)::double, 6) AS induce_rate FROM bns GROUP BY 1",
    BNS,
)
SQL["cohort_savings"] = q(
    "SELECT user_id, account_open_time, count_save_events, round(max_save, 6) AS max_save, round(total_save, 6) AS total_save, "
    "round(average_save, 6) AS average_save FROM cohort",
    COHORT,
)
SQL["cohort_monthly"] = q(
    f"SELECT {MONTH.format('account_open_time')} AS cohort_month, round(sum(total_save), 6) AS total_save, "
    "round(avg(average_save), 6) AS average_save FROM cohort GROUP BY 1",
    COHORT,
)
SQL["saves_after_14_days"] = q(
    "SELECT user_id, first_save_time, later_saves, round(average_save, 6) AS average_save FROM late", LATE
)
SQL["late_savers_by_cohort"] = q(
    "SELECT year(make_timestamp(first_save_time * 1000))::int AS year, month(make_timestamp(first_save_time * 1000))::int AS month, "
    "count(DISTINCT user_id) AS users, round(avg(average_save), 6) AS average_save, round(avg(later_saves), 6) AS later_saves "
    "FROM late GROUP BY 1, 2",
    LATE,
)
SQL["recency_buckets"] = q(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '({a},{a + 30}]' AS bucket, count(*) AS users FROM since WHERE d > {a} AND d <= {a + 30}"
        for i, a in enumerate((0, 30, 60, 90))
    ),
    SINCE,
)
SQL["recency_histogram"] = q(
    " UNION ALL ".join(
        f"SELECT {i} AS position, '[{a},{a + 15}{']' if a == 105 else ')'}' AS bin, count(*) AS users FROM since "
        f"WHERE d >= {a} AND d {'<=' if a == 105 else '<'} {a + 15}"
        for i, a in enumerate(range(0, 120, 15))
    ),
    SINCE,
)
SQL["value_counts"] = q("SELECT event_type, count(*) AS rows FROM ev GROUP BY event_type")
SQL["distinct_and_null_count"] = q(
    "SELECT count(DISTINCT user_id) AS distinct_values, count(*) FILTER (user_id IS NULL) AS null_values FROM ev"
)

# --- offers --------------------------------------------------------------------------------
REQUIREMENT = """CASE WHEN json_extract(context, '$.statusConditions') IS NULL THEN NULL ELSE
  split_part(json_extract_string(context, '$.statusConditions.REDEEMED[0]'), ' ', 1) END AS save_type,
  cast(regexp_extract(json_extract_string(context, '$.statusConditions.REDEEMED[0]'), '\\{(\\d+)', 1) AS double) AS save_amount"""
TOP2 = """top2 AS (SELECT user_id, count(*) AS events FROM ev WHERE event_type LIKE 'BOOST_CREATED%' OR event_type = 'SAVING_PAYMENT_SUCCESSFUL'
  GROUP BY user_id ORDER BY events DESC, user_id LIMIT 2)"""
PRIOR = f"""prior AS (SELECT o.rid, any_value(o.user_id) AS user_id, any_value(o.t) AS t, any_value(o.context) AS context,
  any_value(o.boost_type) AS boost_type, any_value(o.boost_category) AS boost_category, any_value(o.boost_amount) AS boost_amount,
  count(*) FILTER (s.t < o.t) AS prior_save_count,
  count(*) FILTER (s.t > o.t AND s.t - o.t < {48 * HOUR}) > 0 AS save_within_48
  FROM offers o LEFT JOIN evsaves s ON s.user_id = o.user_id GROUP BY o.rid)"""
SQL["drop_top_users"] = q(
    "SELECT user_id, event_type, t FROM ev WHERE (event_type LIKE 'BOOST_CREATED%' OR event_type = 'SAVING_PAYMENT_SUCCESSFUL') "
    "AND user_id NOT IN (SELECT user_id FROM top2)",
    TOP2,
)
SQL["top_users"] = q("SELECT user_id, events FROM top2", TOP2)
SQL["boost_fields"] = q(
    "SELECT user_id, t, boost_id, boost_type, boost_category, boost_amount, boost_type || '::' || boost_category AS boost_type_category, "
    f"(cast(json_extract(context, '$.boostEndTime') AS bigint) - cast(json_extract(context, '$.boostStartTime') AS bigint)) / {DAY}.0 AS days_open FROM offers"
)
SQL["save_requirement"] = q(
    f"SELECT user_id, t, save_type, CASE WHEN save_type IS NULL THEN NULL ELSE save_amount END AS save_amount FROM (SELECT user_id, t, {REQUIREMENT} FROM offers)"
)
SQL["prior_save_count"] = q("SELECT user_id, t, prior_save_count FROM prior", PRIOR)
SQL["save_within_48"] = q("SELECT user_id, t, save_within_48 FROM prior", PRIOR)
SQL["boost_dataset"] = q(
    f"""SELECT boost_type, boost_category, save_type, save_amount, boost_amount, round(save_amount / boost_amount, 6) AS boost_save_ratio,
  day(make_timestamp(t * 1000))::int AS day_of_month, (isodow(make_timestamp(t * 1000)) - 1)::int AS day_of_week, prior_save_count, save_within_48
FROM (SELECT *, {REQUIREMENT} FROM prior) WHERE save_type IS NOT NULL AND user_id NOT IN (SELECT user_id FROM top2)""",
    TOP2,
    PRIOR,
)
# hour differences are cut toward zero, so 'before' and 'after' mean a full hour
TRAIN = [
    """pairs AS (SELECT o.*, s.c AS save_c, trunc((s.c - o.c) / 3600000.0) AS hrs FROM offers o LEFT JOIN evsaves s ON s.user_id = o.user_id)""",
    """busy AS (SELECT user_id, count(*) AS n FROM pairs GROUP BY user_id ORDER BY n DESC, user_id LIMIT 2)""",
    """kept AS (SELECT * FROM pairs WHERE user_id NOT IN (SELECT user_id FROM busy))""",
    """before AS (SELECT user_id, boost_id, count(*) AS boost_prior_saves,
       arg_max(hrs, save_c::hugeint * 10000000000000 + c) AS h_latest, arg_min(hrs, save_c::hugeint * 10000000000000 + c) AS h_first
       FROM kept WHERE hrs < 0 GROUP BY user_id, boost_id)""",
    """ahead AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, boost_id ORDER BY save_c, c, boost_amount) AS rn
       FROM kept WHERE hrs > 0) WHERE rn = 1)""",
    """redeems AS (SELECT user_id, c FROM ev WHERE event_type = 'BOOST_REDEEMED')""",
    """redeemed AS (SELECT o.user_id, o.boost_id, bool_or(r.c IS NOT NULL) AS has_prior_redeemed
       FROM offers o LEFT JOIN redeems r ON r.user_id = o.user_id
       WHERE r.c IS NULL OR trunc((r.c - o.c) / 3600000.0) < 0 GROUP BY o.user_id, o.boost_id)""",
]
_TRAIN_COLS = """a.user_id, a.boost_id, a.boost_amount AS boost_amount_whole_currency, day(make_timestamp(a.c * 1000))::int AS day_of_month,
  b.boost_prior_saves, a.boost_type || '::' || a.boost_category AS boost_type_category, round(abs(b.h_latest) / 24.0, 6) AS days_since_latest_save,
  r.has_prior_redeemed, round(abs(b.h_first) / 24.0, 6) AS days_since_first_save, (isodow(make_timestamp(a.c * 1000)) - 1)::int AS day_of_week,
  a.hrs < 24 AS is_save_within_day"""
_TRAIN_FROM = "FROM ahead a JOIN before b USING (user_id, boost_id) JOIN redeemed r USING (user_id, boost_id)"
SQL["boost_training_set"] = q(f"SELECT {_TRAIN_COLS} {_TRAIN_FROM}", *TRAIN)
SQL["boost_training_set_with_withdrawals"] = q(
    f"SELECT {_TRAIN_COLS}, x.n AS saves_after_withdraw, coalesce(x.n > 0, false) AS has_withdrawn_and_saved {_TRAIN_FROM} "
    "LEFT JOIN (SELECT user_id, sum(subsequent_save_count)::bigint AS n FROM wts GROUP BY user_id) x ON x.user_id = a.user_id",
    *TRAIN,
    WTS,
)
SQL["boost_future_saves"] = q(
    """SELECT user_id, c AS boost_creation_time, min(save_c) AS next_save,
  coalesce(trunc((min(save_c) - c) / 3600000.0) < 24, false) AS is_save_within_day
FROM pairs WHERE hrs > 0 OR hrs IS NULL GROUP BY rid, user_id, c""",
    TRAIN[0],
)
SQL["boost_prior_redemptions"] = q(
    """SELECT o.user_id, o.c AS boost_creation_time, count(r.c) AS prior_redemptions, count(r.c) > 0 AS has_prior_redeemed
FROM offers o LEFT JOIN redeems r ON r.user_id = o.user_id
WHERE r.c IS NULL OR trunc((r.c - o.c) / 3600000.0) < 0 GROUP BY o.rid, o.user_id, o.c""",
    TRAIN[5],
)
S_NOW = ms("2024-01-30")
STATS = f"""stats AS (SELECT user_id, count(*) AS prior_save_count, max(t) AS latest_save, min(t) AS earliest_save,
  trunc(({S_NOW} - max(t)) / {HOUR}.0)::bigint AS hours_since_latest, trunc(({S_NOW} - min(t)) / {HOUR}.0)::bigint AS hours_since_earliest
  FROM saves GROUP BY user_id)"""
RCOUNT = "rcount AS (SELECT user_id, count(*) AS number_boost_redeems FROM ev WHERE event_type = 'BOOST_REDEEMED' GROUP BY user_id)"
CANDIDATES = "cand AS (SELECT DISTINCT user_id FROM ev WHERE event_type = 'USER_OPENED_APP' AND t >= %d)" % ms("2024-01-28")
SQL["user_save_stats"] = q("SELECT * FROM stats WHERE user_id IN (SELECT user_id FROM cand)", STATS, CANDIDATES)
SQL["redeem_counts"] = q("SELECT * FROM rcount WHERE user_id IN (SELECT user_id FROM cand)", RCOUNT, CANDIDATES)
CATEGORIES = (
    "GAME::CHASE_ARROW GAME::DESTROY_IMAGE GAME::TAP_SCREEN SIMPLE::ROUND_UP SIMPLE::SIMPLE_SAVE SIMPLE::TIME_LIMITED "
    "SIMPLE::TARGET_BALANCE SOCIAL::FRIENDS_ADDED SOCIAL::NUMBER_FRIENDS WITHDRAWAL::CANCEL_WITHDRAWAL"
).split()
SQL["score_input"] = q(
    "SELECT s.user_id, 10.0::double AS boost_amount_whole_currency, round(hours_since_latest / 24.0, 6) AS days_since_latest_save, "
    "round(hours_since_earliest / 24.0, 6) AS days_since_first_save, prior_save_count AS boost_prior_saves, "
    "coalesce(number_boost_redeems, 0) > 0 AS has_prior_redeemed, 1 AS day_of_week, 30 AS day_of_month, 'GAME::TAP_SCREEN' AS boost_type_category, "
    + ", ".join(f"{int(c == 'GAME::TAP_SCREEN')} AS \"boost_type_category_{c}\"" for c in CATEGORIES)
    + " FROM stats s LEFT JOIN rcount r USING (user_id) WHERE s.user_id IN (SELECT user_id FROM cand)",
    STATS,
    RCOUNT,
    CANDIDATES,
)

# --- ingest --------------------------------------------------------------------------------
NOW = ms("2024-01-31")
SECRET = "shared-secret"


def _pad(x: int) -> str:
    return "'" + "".join(f"\\x{b ^ x:02X}" for b in SECRET.encode().ljust(64, b"\0")) + "'::blob"


HMAC = f"sha256({_pad(0x5C)} || unhex(sha256({_pad(0x36)} || encode('{SECRET}_' || event_type))))"
NOTES = f"""notes AS (SELECT user_id, event_type, t AS time_transaction_occurred, context,
  CASE WHEN value >= 5 THEN {HMAC} ELSE 'forged' END AS hash, {HMAC} AS expected FROM (
  SELECT user_id, t, value, CASE WHEN kind = 'purchase' THEN '{{"accountId":"acc-' || user_id || '"}}' ELSE '' END AS context,
    {event_type()} AS event_type
  FROM raw))"""
SQL["normalise_sns"] = q("SELECT user_id, event_type, time_transaction_occurred, context FROM notes", NOTES)
SQL["verify_signature"] = q(
    "SELECT user_id, event_type, time_transaction_occurred, hash = expected AS genuine FROM notes", NOTES
)
STAMPED = (
    f"SELECT user_id, event_type, t AS time_transaction_occurred, 'INTERNAL_SERVICES' AS source_of_event, "
    f"{NOW} AS created_at, {NOW} AS updated_at, context FROM ev"
)
SQL["stamp_events"] = q(STAMPED)
SQL["ingest_stream"] = q(STAMPED)
PAYMENTS = """pay AS (SELECT user_id, kind, k, t, cast(round(value * 100) AS bigint) AS cents,
  CASE WHEN kind NOT IN ('purchase', 'error') THEN 'no account' WHEN k % 10 = 8 THEN 'no amount'
       WHEN k % 10 = 7 THEN 'unreadable amount' END AS reject_reason FROM raw)"""
MOVED = f"""SELECT user_id, 'acc-' || user_id AS account_id,
  CASE kind WHEN 'purchase' THEN 'SAVING_EVENT' ELSE 'WITHDRAWAL' END AS transaction_type,
  CASE k % 3 WHEN 2 THEN cents // 100 * 10000 ELSE cents * 100 END AS amount, 'HUNDREDTH_CENT' AS unit, 'ZAR' AS currency,
  t AS time_transaction_occurred, {NOW} AS created_at, {NOW} AS updated_at FROM pay WHERE reject_reason IS NULL"""
SQL["to_behaviour"] = q(MOVED, PAYMENTS)
SQL["behaviour_stream"] = q(MOVED, PAYMENTS)
SQL["rejected_payments"] = q(
    "SELECT reject_reason, count(*) AS rows FROM pay WHERE reject_reason IS NOT NULL GROUP BY reject_reason", PAYMENTS
)
EXPORT = f"""ex AS (SELECT *, {event_type()} AS event_type,
  CASE WHEN k % 11 IN (0, 1) THEN (100000 + user_id::bigint)::varchar ELSE user_id END AS uid,
  CASE WHEN k % 4 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS told,
  CASE WHEN k % 4 = 0 THEN t // 1000 * 1000 ELSE t END AS at_ms FROM raw WHERE k NOT IN (50, 51, 52))"""
_GIVEN = {
    "client_event_time": "told",
    "insert_id": "'i-' || event_id",
    "app": "CASE WHEN k % 7 = 4 THEN '240' ELSE '240000' END",
    "user_id": "uid",
    "city": "CASE WHEN k % 3 <> 0 THEN 'Cape Town' END",
    "event_type": "event_type",
    "paying": "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
    "amplitude_id": "(100000 + user_id::bigint)::varchar",
    "is_attribution_event": "'false'",
    "location_lat": "value",
    "session_id": "CASE WHEN k % 7 <> 3 THEN event_id::varchar END",
    "reference_time": "told",
}
_CONTEXT = (
    "client_event_time ip_address library dma user_creation_time insert_id schema client_upload_time app user_id city "
    "event_type device_carrier location_lat event_time platform is_attribution_event os_version paying amplitude_id "
    "device_type sample_rate device_manufacturer start_version uuid version_name location_lng server_upload_time event_id "
    "device_id device_family os_name adid amplitude_event_type device_brand country device_model language region "
    "session_id idfa reference_time"
).split()
SQL["flatten_export"] = SQL["export_files"] = q(
    f"""SELECT uid AS user_id, event_type, at_ms AS time_transaction_occurred, 'AMPLITUDE' AS source_of_event,
  {NOW} AS created_at, {NOW} AS updated_at, {", ".join(f"{_GIVEN.get(n, 'NULL')} AS c_{n}" for n in _CONTEXT)},
  concat_ws(',', 'event_properties:i-' || event_id || ':k:' || k,
    'event_properties:i-' || event_id || ':even:' || CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END,
    'event_properties:i-' || event_id || ':kind:' || kind) AS properties,
  'user_properties:i-' || event_id || ':value' AS last_property, value AS last_value, 4 AS n_properties FROM ex""",
    EXPORT,
)
SQL["bad_export_lines"] = q("SELECT count(*) AS rows FROM raw WHERE k IN (50, 51, 52)")
SQL["events_per_hour_stream"] = q(
    f"SELECT t // {HOUR} * {HOUR} AS hour, event_type, count(*) AS rows FROM ev GROUP BY 1, 2"
)
SQL["deduplicated_stream"] = q("SELECT DISTINCT user_id, event_type, t AS time_transaction_occurred, context FROM ev")
SQL["last_flag_stream"] = SQL["last_flag_times"]
SQL["group_size"] = q(
    "SELECT user_id, event_type, c AS created_at, count(*) OVER (PARTITION BY user_id) AS group_size FROM ev"
)
for _name, _order in (("first_per_group", "ASC"), ("last_per_group", "DESC")):
    SQL[_name] = q(
        "SELECT user_id, "
        + ", ".join(
            f"(list({c} ORDER BY c {_order}, {c} {_order}) FILTER ({c} IS NOT NULL))[1] AS {name}"
            for c, name in (("event_type", "event_type"), ("c", "created_at"), ("ctx", "context"))
        )
        + " FROM (SELECT *, nullif(context, '') AS ctx FROM ev) GROUP BY user_id"
    )

# --- tables and files ----------------------------------------------------------------------
LOG = "user_id, event_type, t AS time_transaction_occurred, source AS source_of_event, c AS created_at, c AS updated_at, context"
SQL["read_events"] = q(f"SELECT {LOG} FROM ev")
# a CSV does not tell an empty context from a missing one
SQL["read_events_csv"] = q("SELECT " + LOG.replace("context", "nullif(context, '') AS context") + " FROM ev")
SQL["read_behaviour"] = q(
    "SELECT user_id, account_id, tx AS transaction_type, amount, unit, 'ZAR' AS currency, t AS time_transaction_occurred, "
    "c AS created_at, c AS updated_at FROM ub"
)
SQL["read_flags"] = q(
    "SELECT user_id, account_id, rule_label, 'earlier payment' AS reason, 'PENDING_CONFIRMATION' AS accuracy, created_at, "
    "created_at AS updated_at FROM fl"
)
SQL["write_features_csv"] = SQL["boost_dataset"]
SQL["dummies"] = q(
    "SELECT user_id, boost_id, c AS boost_type_category, "
    + ", ".join(
        f"(c = '{v}')::int AS \"boost_type_category_{v}\""
        for v in ("GAME::TAP_SCREEN", "SIMPLE::SIMPLE_SAVE", "SOCIAL::NUMBER_FRIENDS")
    )
    + " FROM (SELECT *, boost_type || '::' || boost_category AS c FROM offers) x(user_id, t, own, context, boost_id, a, b, amount, rid, c)"
)
SQL["dummy_vectors"] = q(
    """SELECT e.user_id, event_type, place AS user_id_place, '(' || (SELECT count(*) FROM places) || ',[' || place || '],[1.0])' AS vector, count(*) AS n
FROM ev e JOIN places USING (user_id) GROUP BY ALL""",
    "places AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS place FROM (SELECT DISTINCT user_id FROM ev))",
)
SCORES = """SELECT n AS rows, tp + fn AS positives, round(coalesce(tp / nullif(tp + fp, 0)::double, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::double, 0), 6) AS recall, round(f1, 6) AS f_score, round((tp + tn) / n::double, 6) AS accuracy,
  round((f1 + f0) / 2, 6) AS macro_f1, round(auc, 6) AS roc_auc
FROM (SELECT *, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0) AS f1, coalesce(2 * tn / nullif(2 * tn + fp + fn, 0)::double, 0) AS f0
  FROM (SELECT count(*) AS n, count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp,
          count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (NOT y AND NOT p) AS tn FROM guess)),
  (SELECT avg(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END) AS auc FROM guess a JOIN guess b ON a.y AND NOT b.y)"""
SQL["evaluate"] = q(
    SCORES,
    *TRAIN,
    f"guess AS (SELECT boost_prior_saves AS s, boost_prior_saves > 5 AS p, is_save_within_day AS y FROM (SELECT {_TRAIN_COLS} {_TRAIN_FROM}))",
)
SQL["evaluate_payments"] = q(
    SCORES, "guess AS (SELECT amount AS s, amount > 100000000 AS p, tx = 'SAVING_EVENT' AS y FROM ub)"
)
_BAYES_INPUTS = [
    "coalesce(boost_amount_whole_currency, 0)::double",
    "day_of_month::double",
    "day_of_week::double",
    "coalesce(boost_prior_saves, 0)::double",
    "coalesce(has_prior_redeemed, false)::int::double",
    *(f"(boost_type_category = '{c}')::int::double" for c in CATEGORIES),
]


def _bayes(model: str) -> str:
    """The scores of one model over the test rows: the statistics are rows per class and input, not columns."""
    gaussian = "-0.5 * (ln(2 * pi() * (v + least)) + (x - mu) * (x - mu) / (v + least))"
    multinomial = "(x - low) / w * ln((size * (mu - low) / w + 1) / (total + k))"
    term = {"gaussian_naive_bayes": gaussian, "multinomial_naive_bayes": multinomial}.get(model, "0.0")
    score = "(SELECT CASE WHEN avg(y::int) >= 0.5 THEN 0.5 ELSE -0.5 END FROM fitted_rows WHERE NOT test)"
    if model != "majority":
        score = "sum(CASE WHEN c THEN 1 ELSE -1 END * (prior + inner_sum))"
    return f"""(WITH guess AS (
  SELECT *, s > 0 AS p FROM (SELECT any_value(y) AS y, {score} AS s FROM (
    SELECT r, y, c, any_value(ln(size / n)) AS prior, sum({term}) AS inner_sum FROM tested JOIN learnt USING (i) GROUP BY r, y, c) GROUP BY r)
) SELECT *, '{model}' AS model FROM ({SCORES}))"""


SQL["bayes_portfolio"] = q(
    " UNION ALL ".join(_bayes(m) for m in ("gaussian_naive_bayes", "multinomial_naive_bayes", "majority")),
    *TRAIN,
    f"""fitted_rows AS (SELECT row_number() OVER () AS r, is_save_within_day AS y, [{", ".join(_BAYES_INPUTS)}] AS xs,
  substr(md5(user_id || '/' || boost_id), 1, 1) IN ('0', '1', '2') AS test FROM (SELECT {_TRAIN_COLS} {_TRAIN_FROM}))""",
    f"long_rows AS MATERIALIZED (SELECT r, y, test, unnest(xs) AS x, unnest(range({len(_BAYES_INPUTS)})) AS i FROM fitted_rows)",
    "tested AS (SELECT * FROM long_rows WHERE test)",
    """overall AS (SELECT i, min(x) AS low, coalesce(nullif(max(x) - min(x), 0), 1) AS w, var_pop(x) AS spread, count(*) AS n
  FROM long_rows WHERE NOT test GROUP BY i)""",
    """by_class AS (SELECT i, y AS c, count(*) AS size, avg(x) AS mu, var_pop(x) AS v FROM long_rows WHERE NOT test GROUP BY i, y)""",
    """learnt AS MATERIALIZED (SELECT *, 1e-9 * (SELECT coalesce(nullif(max(spread), 0), 1) FROM overall) AS least,
  sum(size * (mu - low) / w) OVER (PARTITION BY c) AS total, count(*) OVER (PARTITION BY c) AS k FROM by_class JOIN overall USING (i))""",
)
SQL["training_log"] = q(
    f"SELECT '2024-01-30' AS run_date, rows AS n, positives AS n_positive, precision, recall, f_score, accuracy FROM ({SCORES})",
    *TRAIN,
    f"guess AS (SELECT boost_prior_saves AS s, boost_prior_saves > 5 AS p, is_save_within_day AS y FROM (SELECT {_TRAIN_COLS} {_TRAIN_FROM}))",
)
_ON_TRIAL = [*((c, label) for c, label, _ in _RULES), ("saves_above_50k_6m > 0", "any_large_saving_event")]


def _flag_counts(rules: list[tuple[str, str]], on: str) -> str:
    none = "NOT (" + " OR ".join(c for c, _ in rules) + ")"
    return " UNION ALL ".join(
        f"SELECT {on} AS on_trial, '{label}' AS rule_label FROM facts WHERE {cond}"
        for cond, label in [*rules, (none, "user_not_flagged")]
    )


SQL["rules_on_trial"] = q(
    f"SELECT on_trial, rule_label, count(*) AS flags FROM ({_flag_counts(_ON_TRIAL[:-1], 'false')} UNION ALL {_flag_counts(_ON_TRIAL, 'true')}) GROUP BY ALL",
    FACTS,
)

SQL["append_events"] = q(
    "SELECT event_type AS what, strftime(make_timestamp(t * 1000), '%Y-%m-%d') AS day, count(*) AS rows, true AS taken "
    "FROM ev WHERE t % 11 <> 0 AND t % 13 <> 0 AND t % 17 <> 0 GROUP BY 1, 2 "
    "UNION ALL SELECT what, NULL, count(*), false FROM ("
    "SELECT 'no user_id' AS what FROM ev WHERE t % 11 = 0 UNION ALL SELECT 'no event_type' FROM ev WHERE t % 13 = 0 "
    "UNION ALL SELECT 'time_transaction_occurred is not a time' FROM ev WHERE t % 17 = 0) GROUP BY what"
)
