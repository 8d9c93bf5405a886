"""DuckDB oracle SQL for every registered query.

Each string runs on DuckDB over the driver's tables (views ``events``,
``customer``, ``orders``, ...).  Each oracle is an independent SQL
formulation, deliberately different from the Spark plan it checks: correlated EXISTS per offset for
retention (Spark: one min/max pass), whole-partition window functions
for sessions (Spark: aggregate joined back), a transition table folded
day by day in a recursive CTE for user states (Spark: closed form over
one window), brute-force "all bars up to the day" for the price arrays
(Spark: bounded window), and CUBE over raw rows (Spark: count at the
grain first).

DuckDB differences handled here: ``date_sub('minute', ...)`` for whole
elapsed minutes, ``concat_ws`` instead of lambdas, BIGINT casts for
``sum`` and ``year``, DATE casts after interval arithmetic, integer
half-up rounding for the growth percentages.
"""

from __future__ import annotations

from kestrel import queries as Qy
from kestrel.functions.rules import DEVICE_RULES, HOST_RULES, OS_RULES, OTHER
from kestrel.sources.fixtures import EVENT_HOSTS

# ---------------------------------------------------------------------------
# stand-in views (same expressions as kestrel.sources.fixtures)
# ---------------------------------------------------------------------------

EV = "ev AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"

_HOSTS = "\n".join(f"         WHEN event_type = '{kind}' THEN '{name}'" for kind, name in EVENT_HOSTS)
WEB_EVENTS = f"""web_events AS (
  SELECT user_id, k AS device_id, CAST(NULL AS VARCHAR) AS referrer,
    CASE WHEN event_type = 'error' AND k % 10 = 0 THEN NULL
{_HOSTS} END AS host,
    '/' || event_type || '/' || CAST(k % 7 AS VARCHAR) AS url,
    ts AS event_time
  FROM ev)"""

DEVICES = """devices AS (
  SELECT c_custkey AS device_id,
    CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS browser_type,
    CASE c_nationkey % 4 WHEN 0 THEN 'Android' WHEN 1 THEN 'iOS' WHEN 3 THEN 'Windows' END AS os_type,
    CASE c_nationkey % 3 WHEN 0 THEN 'Samsung Galaxy' WHEN 1 THEN 'iPhone' END AS device_type
  FROM customer)"""

HOST_CASE = "CASE " + " ".join(f"WHEN host LIKE '{p}' THEN '{name}'" for p, name in HOST_RULES) + " ELSE host END"
DEVICE_CASE = ("CASE " + " ".join(f"WHEN device_type LIKE '{p}' THEN '{name}'" for p, name in DEVICE_RULES)
               + " ELSE COALESCE(device_type, 'unknown') END")

WEB_WINDOW = f"w.event_time BETWEEN DATE '{Qy.WEB_START}' AND DATE '{Qy.WEB_END}'"

# the filled, date-windowed map (cube table and sessions)
MAPPED = f"""mapped AS (
  SELECT {HOST_CASE} AS h,
    COALESCE(browser_type, 'unknown') AS b,
    {DEVICE_CASE} AS d,
    COALESCE(os_type, 'unknown') AS o,
    CAST(event_time AS DATE) AS event_date, event_time, user_id, url
  FROM web_events w JOIN devices d ON d.device_id = w.device_id
  WHERE {WEB_WINDOW})"""

# the collapsed map of the grouping-set reports (browser not filled)
MAPPED_DEDUP = f"""mapped AS (
  SELECT DISTINCT {HOST_CASE} AS h, browser_type AS b, {DEVICE_CASE} AS d,
    COALESCE(os_type, 'unknown') AS o, url
  FROM web_events e JOIN devices d ON d.device_id = e.device_id)"""

ACTIVITY = "activity AS (SELECT o_custkey AS user_id, o_custkey AS device_id, o_orderdate AS event_time FROM orders)"
ACTIVITY_DEVICES = """activity_devices AS (
  SELECT c_custkey AS device_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Android' WHEN 'MACHINERY' THEN 'iOS'
      WHEN 'FURNITURE' THEN 'ios-web' WHEN 'HOUSEHOLD' THEN 'iOS 17' END AS os_type
  FROM customer)"""

DAILY = """daily AS (
  SELECT user_id, CAST(ts AS DATE) AS ds, COUNT(*) AS total_page_visits
  FROM events GROUP BY 1, 2)"""


def _f2d(x: str) -> str:
    """double -> float -> double, the float column widened back."""
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


BARS = f"""bars AS (
  SELECT event_type AS stock_symbol, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS created_ts,
    {_f2d('first(value ORDER BY ts, event_id)')} AS opening_price,
    {_f2d('max(value)')} AS high_price,
    {_f2d('min(value)')} AS low_price,
    {_f2d('last(value ORDER BY ts, event_id)')} AS closing_price,
    CAST(sum(floor(value)) AS BIGINT) AS trade_volume,
    COUNT(*) AS trade_count,
    CAST(ts AS DATE) AS ds
  FROM events GROUP BY event_type, CAST(ts AS DATE))"""
BAR_COLS = ("stock_symbol, created_ts, opening_price, high_price, low_price, closing_price, "
            "trade_volume, trade_count")

RAW_CUSTOMERS = """raw_customers AS (
  SELECT c_custkey AS customer_id, 18 + c_custkey % 60 AS age,
    CASE c_nationkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Other' END AS gender,
    CASE c_custkey % 5
      WHEN 0 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@example.com'
      WHEN 1 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@example.io'
      WHEN 2 THEN 'u' || CAST(c_custkey AS VARCHAR) || '@other.org'
      WHEN 3 THEN 'u' || CAST(c_custkey AS VARCHAR) || '.example.com' END AS email
  FROM customer)"""
RAW_HOUSES = """raw_haunted_houses AS (
  SELECT p_partkey AS haunted_house_id, p_name AS house_name, p_brand AS park_area,
    p_type AS theme, 1 + p_size % 5 AS fear_level, p_size AS house_size
  FROM part)"""
RAW_TICKETS = """raw_haunted_house_tickets AS (
  SELECT o_orderkey AS ticket_id, o_custkey AS customer_id, o_orderkey % 200 AS haunted_house_id,
    CAST(o_orderdate AS DATE) AS purchase_date, CAST(l.first_ship AS DATE) AS visit_date,
    o_orderpriority AS ticket_type, o_totalprice AS ticket_price
  FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1) l
    ON l.l_orderkey = orders.o_orderkey)"""
RAW_FEEDBACKS = """raw_customer_feedbacks AS (
  SELECT l_orderkey AS feedback_id, l_orderkey AS ticket_id,
    1 + CAST(sum(l_quantity) AS BIGINT) % 5 AS rating,
    'qty ' || CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS comments
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)"""

STG = [
    RAW_CUSTOMERS, RAW_HOUSES, RAW_TICKETS, RAW_FEEDBACKS,
    "stg_haunted_customers AS (SELECT customer_id, age, gender, email FROM raw_customers)",
    "stg_customer_feedbacks AS (SELECT feedback_id, ticket_id, rating, comments FROM raw_customer_feedbacks)",
    """stg_haunted_houses AS (SELECT haunted_house_id, house_name, park_area, theme, fear_level,
         house_size FROM raw_haunted_houses)""",
    """stg_haunted_house_tickets AS (SELECT ticket_id, customer_id, haunted_house_id, purchase_date,
         visit_date, ticket_type, ticket_price FROM raw_haunted_house_tickets)""",
]
VALID_DOMAINS = "valid_domains AS (SELECT * FROM (VALUES ('example.com'), ('example.io')) t(valid_domain))"
DIM_CUSTOMERS = """dim_customers AS (
  SELECT s.customer_id, s.age, s.gender, s.email,
    (s.email LIKE '%@%.%' AND v.valid_domain IS NOT NULL) IS TRUE AS is_valid_email_address
  FROM stg_haunted_customers s
  LEFT JOIN (SELECT DISTINCT valid_domain FROM valid_domains) v
    ON split_part(s.email, '@', 2) = v.valid_domain)"""
DIM_HOUSES = """dim_haunted_houses AS (
  SELECT haunted_house_id, house_name, park_area, theme, fear_level,
    house_size AS house_size_in_ft2, CAST(house_size * 0.3048 AS DECIMAL(16, 2)) AS house_size_in_m2
  FROM stg_haunted_houses)"""
FACT = """fact_visits AS (
  SELECT t.*, fb.rating, fb.comments
  FROM stg_haunted_house_tickets t
  LEFT JOIN stg_customer_feedbacks fb USING (ticket_id))"""
AUDIT = f"""audit_fact_visits AS (
  SELECT * FROM fact_visits WHERE purchase_date = DATE '{Qy.AUDIT_DATE}')"""

# the declared layout of three tables, as the catalog must give it back
LAYOUTS = (
    [("bars", "column", name, kind) for name, kind in (
        ("stock_symbol", "string"), ("created_ts", "timestamp_ntz"), ("opening_price", "float"), ("high_price", "float"),
        ("low_price", "float"), ("closing_price", "float"), ("trade_volume", "bigint"), ("trade_count", "bigint"),
        ("ds", "date"))]
    + [("state", "column", name, kind) for name, kind in (
        ("user_id", "bigint"), ("first_active_date", "date"), ("last_active_date", "date"), ("current_state", "string"),
        ("lifetime_page_visits", "bigint"), ("ds", "date"))]
    + [("domains", "column", "valid_domain", "string"), ("bars", "partitioned by", "ds", "0"),
       ("state", "partitioned by", "ds", "0"), ("state", "bucketed by", "user_id", str(Qy.STATE_BUCKETS)),
       ("gone", "exists", "false", "")])


def _with(ctes: list[str], body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body


# ---------------------------------------------------------------------------
# analytical patterns
# ---------------------------------------------------------------------------

OS_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"d.os_type LIKE '{p}'" for p in ((patterns,) if isinstance(patterns, str) else patterns))
    + f" THEN '{name}'" for patterns, name in OS_RULES) + f" ELSE '{OTHER}' END"
MONTHLY = f"""monthly AS (
  SELECT CAST(DATE_TRUNC('month', event_time) AS DATE) AS activity_month,
    {OS_CASE} AS os,
    COUNT(DISTINCT w.user_id) AS monthly_users_active
  FROM activity w JOIN activity_devices d ON w.device_id = d.device_id
  GROUP BY 1, 2)"""


def _growth(cur: str, prev: str) -> str:
    d = f"({cur} - {prev})"
    return (f"CASE WHEN {prev} IS NULL OR {prev} = 0 THEN NULL ELSE "
            f"CAST(sign({d}) * ((2 * 1000 * abs({d}) + {prev}) // (2 * {prev})) / 10.0 "
            f"AS DECIMAL(23, 1)) END")


OS_GROWTH = _with([ACTIVITY, ACTIVITY_DEVICES, MONTHLY, """my AS (
  SELECT activity_month AS m, os, monthly_users_active,
    LAG(monthly_users_active, 1) OVER (PARTITION BY os ORDER BY activity_month) AS prior_month_users,
    LAG(monthly_users_active, 12) OVER (PARTITION BY os ORDER BY activity_month) AS prior_year_users
  FROM monthly)"""], f"""
SELECT CAST(YEAR(m) AS BIGINT) AS activity_year, CAST(MONTH(m) AS BIGINT) AS activity_month, os,
  monthly_users_active, prior_month_users, prior_year_users,
  {_growth('monthly_users_active', 'prior_month_users')} AS mom_growth_percentage,
  {_growth('monthly_users_active', 'prior_year_users')} AS yoy_growth_percentage
FROM my ORDER BY activity_year DESC, activity_month DESC, os""")

def _later(offset: str) -> str:
    return (f"EXISTS (SELECT 1 FROM activity a WHERE a.user_id = f.user_id "
            f"AND CAST(a.event_time AS DATE) >= CAST(f.d0 + {offset} AS DATE))")


RETENTION = _with([ACTIVITY, """firsts AS (
  SELECT user_id, MIN(CAST(event_time AS DATE)) AS d0 FROM activity GROUP BY user_id)""",
                   f"""flags AS (
  SELECT f.user_id, f.d0,
    {_later("INTERVAL 14 DAY")} AS w2,
    {_later("INTERVAL 1 MONTH")} AS m1,
    {_later("INTERVAL 3 MONTH")} AS m3
  FROM firsts f)"""], """
SELECT CAST(year(d0) AS BIGINT) AS first_year, CAST(month(d0) AS BIGINT) AS first_month,
  COUNT(user_id) AS total_started,
  COUNT(user_id) FILTER (WHERE w2) AS two_weeks_active,
  COUNT(user_id) FILTER (WHERE m1) AS one_month_active,
  COUNT(user_id) FILTER (WHERE m3) AS three_months_active
FROM flags GROUP BY 1, 2""")

# the state machine as a transition table (yesterday's state, active today)
MOVES = """moves(prev_state, active, next_state) AS (VALUES
  ('new', true, 'retained'), ('new', false, 'churned'),
  ('retained', true, 'retained'), ('retained', false, 'churned'),
  ('resurrected', true, 'retained'), ('resurrected', false, 'churned'),
  ('churned', true, 'resurrected'), ('churned', false, 'stale'),
  ('stale', true, 'resurrected'), ('stale', false, 'unknown'),
  ('unknown', true, 'unknown'), ('unknown', false, 'unknown'))"""

# the state table folded one day at a time from each user's first day
STATE_FOLD = [f"""daily AS (
  SELECT user_id, CAST(ts AS DATE) AS ds, COUNT(*) AS total_page_visits FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '{Qy.DAY_START}' AND DATE '{Qy.DAY_END}'
  GROUP BY 1, 2)""", MOVES, f"""st AS (
  SELECT d.user_id, d.ds AS first_active_date, d.ds AS last_active_date, 'new' AS current_state,
    d.total_page_visits AS lifetime_page_visits, d.ds
  FROM daily d
  WHERE d.ds = (SELECT min(x.ds) FROM daily x WHERE x.user_id = d.user_id)
  UNION ALL
  SELECT y.user_id, y.first_active_date, COALESCE(t.ds, y.last_active_date), m.next_state,
    y.lifetime_page_visits + COALESCE(t.total_page_visits, 0), CAST(y.ds + 1 AS DATE)
  FROM st y
  LEFT JOIN daily t ON t.user_id = y.user_id AND t.ds = y.ds + 1
  JOIN moves m ON m.prev_state = y.current_state AND m.active = (t.user_id IS NOT NULL)
  WHERE y.ds < DATE '{Qy.DAY_END}')"""]

STATE_BACKFILL = _with(STATE_FOLD, """
SELECT user_id, first_active_date, last_active_date, current_state,
  CAST(lifetime_page_visits AS BIGINT) AS lifetime_page_visits, ds FROM st""", recursive=True)

STATE_STEP = _with(STATE_FOLD, f"""
SELECT COALESCE(t.user_id, y.user_id) AS user_id,
  COALESCE(y.first_active_date, t.ds) AS first_active_date,
  COALESCE(t.ds, y.last_active_date) AS last_active_date,
  COALESCE(m.next_state, 'new') AS current_state,
  CAST(COALESCE(y.lifetime_page_visits, 0) + COALESCE(t.total_page_visits, 0) AS BIGINT) AS lifetime_page_visits,
  DATE '{Qy.STEP_DAY}' AS ds
FROM (SELECT * FROM daily WHERE ds = DATE '{Qy.STEP_DAY}') t
FULL OUTER JOIN (SELECT * FROM st WHERE ds = DATE '{Qy.STEP_DAY}' - 1) y ON t.user_id = y.user_id
LEFT JOIN moves m ON m.prev_state = y.current_state AND m.active = (t.user_id IS NOT NULL)""",
                   recursive=True)

WEB = [EV, WEB_EVENTS, DEVICES]


def _grouped(grouping: str, extra: str = "") -> str:
    return _with(WEB + [MAPPED_DEDUP], f"""
SELECT COALESCE(h, '(overall)') AS host, COALESCE(b, '(overall)') AS browser_type,
  COALESCE(d, '(overall)') AS device_type, COALESCE(o, '(overall)') AS os_type,
  COUNT(1) AS page_hits{extra}
FROM mapped GROUP BY {grouping}""")


GSETS = "GROUPING SETS ((h, b, d, o), (h), (b))"

OLAP_CUBE = _with(WEB + [MAPPED], f"""
SELECT COALESCE(h, '(overall)') AS host, COALESCE(b, '(overall)') AS browser_type,
  COALESCE(d, '(overall)') AS device_type, COALESCE(o, '(overall)') AS os_type,
  COUNT(1) AS page_hits, DATE '{Qy.WEB_END}' AS ds,
  concat_ws('__',
    CASE WHEN GROUPING(h) = 0 THEN 'host' END,
    CASE WHEN GROUPING(b) = 0 THEN 'browser_type' END,
    CASE WHEN GROUPING(d) = 0 THEN 'device_type' END,
    CASE WHEN GROUPING(o) = 0 THEN 'os_type' END) AS agg_level
FROM mapped GROUP BY CUBE (h, b, d, o)""")


DAY_WINDOW = """windowed AS (
  SELECT user_id, event_time,
    min(event_time) OVER day AS first_action_on_date,
    max(event_time) OVER day AS last_action_on_date,
    count(event_time) OVER day AS total_event_today
  FROM mapped
  WINDOW day AS (PARTITION BY user_id, event_date))"""
RUNNING_WINDOW = """windowed AS (
  SELECT user_id, event_time,
    min(event_time) OVER upto AS first_action_on_date,
    event_time AS last_action_on_date,
    count(event_time) OVER upto AS total_event_today
  FROM mapped
  WINDOW upto AS (PARTITION BY user_id, event_date ORDER BY event_time ROWS UNBOUNDED PRECEDING))"""


SESSION_FULL = _with(WEB + [MAPPED, DAY_WINDOW], """
SELECT *, date_sub('minute', first_action_on_date, event_time) AS minutes_since_first FROM windowed""")
SESSION_RUNNING = _with(WEB + [MAPPED, RUNNING_WINDOW], """
SELECT *, date_sub('minute', first_action_on_date, event_time) AS minutes_since_first FROM windowed""")
MULTI_EVENT = _with(WEB + [MAPPED, DAY_WINDOW], """
SELECT * FROM windowed WHERE total_event_today > 1""")

# ---------------------------------------------------------------------------
# bars
# ---------------------------------------------------------------------------

LAST7 = f"""days AS (
  SELECT CAST(d AS DATE) AS ds
  FROM generate_series(TIMESTAMP '{Qy.DAY_START}', TIMESTAMP '{Qy.DAY_END}', INTERVAL 1 DAY) t(d)),
in_range AS (SELECT * FROM bars WHERE ds BETWEEN DATE '{Qy.DAY_START}' AND DATE '{Qy.DAY_END}'),
grid AS (
  SELECT s.stock_symbol, days.ds
  FROM (SELECT stock_symbol, min(ds) AS first_ds FROM in_range GROUP BY 1) s
  JOIN days ON days.ds >= s.first_ds),
hist AS (
  SELECT g.stock_symbol, g.ds, b.closing_price,
    row_number() OVER (PARTITION BY g.stock_symbol, g.ds ORDER BY b.ds DESC) AS rn,
    count(*) OVER (PARTITION BY g.stock_symbol, g.ds) AS n_all,
    max(b.created_ts) OVER (PARTITION BY g.stock_symbol, g.ds) AS last_update
  FROM grid g JOIN in_range b ON b.stock_symbol = g.stock_symbol AND b.ds <= g.ds)"""
LAST7_SELECT = """
SELECT stock_symbol, ds, last_update, CAST(least(n_all, 7) - rn AS INTEGER) AS pos,
  closing_price AS price
FROM hist WHERE rn <= 7"""

ORACLE: dict[str, str] = {
    "os_monthly_active": _with([ACTIVITY, ACTIVITY_DEVICES, MONTHLY], "SELECT * FROM monthly"),
    "os_growth_mom_yoy": OS_GROWTH,
    "os_growth_order": f"""SELECT *, ROW_NUMBER() OVER (ORDER BY activity_year DESC, activity_month DESC, os) AS position
FROM ({OS_GROWTH}) report""",
    "user_first_activity": _with([ACTIVITY], """
SELECT user_id, MIN(CAST(event_time AS DATE)) AS first_active_date FROM activity GROUP BY user_id"""),
    "retention_monthly": RETENTION,
    "retention_order": f"""SELECT *, ROW_NUMBER() OVER (ORDER BY first_year DESC, first_month DESC) AS position
FROM ({RETENTION}) report""",
    "user_state_step": STATE_STEP,
    "user_state_backfill": STATE_BACKFILL,
    "user_state_job": f"SELECT * FROM ({STATE_BACKFILL}) WHERE ds >= DATE '{Qy.JOB_START}'",
    "user_state_late_backfill": STATE_BACKFILL,
    "web_mapped": _with(WEB + [MAPPED], """
SELECT h AS host, b AS browser_type, d AS device_type, o AS os_type, url, user_id, event_time,
  event_date FROM mapped"""),
    "web_mapped_dedup": _with(WEB + [MAPPED_DEDUP], """
SELECT h AS host, b AS browser_type, d AS device_type, o AS os_type, url FROM mapped"""),
    "grouping_sets_hits": _grouped(GSETS),
    "grouping_sets_combo_count": "SELECT COUNT(1) AS combo_count FROM (" + _grouped(GSETS) + ") agged",
    "rollup_hits": _grouped("ROLLUP (h, b, d, o)"),
    "cube_hits": _grouped("CUBE (h, b, d, o)"),
    "olap_cube_levels": OLAP_CUBE,
    "olap_cube_slice": f"SELECT * FROM ({OLAP_CUBE}) c WHERE agg_level = '{Qy.CUBE_LEVEL}'",
    "session_minutes": SESSION_FULL,
    "session_running": SESSION_RUNNING,
    "multi_event_days": MULTI_EVENT,
    # bars
    "stock_bars": _with([BARS], "SELECT * FROM bars"),
    "ingest_bars": _with([BARS], """
SELECT * FROM bars WHERE trade_count % 7 <> 0 AND trade_count % 11 <> 0"""),
    "ingest_quarantine": _with([BARS, """lines AS (
  SELECT ds, trade_count AS n, CASE WHEN trade_count % 23 <> 0 THEN stock_symbol END AS stock_symbol,
    created_ts + to_seconds(k) AS created_ts,
    CASE WHEN trade_count % 17 = 0 THEN -closing_price ELSE closing_price END AS closing_price
  FROM bars, range(2) r(k) WHERE k = 0 OR trade_count % 13 = 0
), judged AS (
  SELECT *, CASE WHEN n % 19 = 0 THEN 'malformed response' WHEN n % 7 = 0 OR n % 11 = 0 THEN 'skipped'
    WHEN stock_symbol IS NULL THEN 'no symbol' WHEN closing_price <= 0 THEN 'price not positive' END AS fault
  FROM lines
), told AS (
  SELECT *, COALESCE(fault, CASE WHEN EXISTS (SELECT 1 FROM judged later WHERE later.fault IS NULL AND later.ds = judged.ds
    AND later.stock_symbol = judged.stock_symbol AND later.created_ts > judged.created_ts)
    THEN 'repeated symbol' ELSE 'kept' END) AS outcome
  FROM judged
)"""], """
SELECT ds, CASE WHEN outcome <> 'malformed response' THEN stock_symbol END AS stock_symbol,
  CASE WHEN outcome = 'kept' THEN created_ts END AS created_ts,
  CASE WHEN outcome = 'kept' THEN closing_price END AS closing_price, outcome, CAST(1 AS BIGINT) AS copies
FROM told WHERE outcome <> 'skipped'"""),
    "bars_by_day": _with([BARS], f"SELECT {BAR_COLS}, ds AS created_at_day FROM bars"),
    "last7_backfill": _with([BARS, LAST7], LAST7_SELECT),
    "last7_job": _with([BARS, LAST7], LAST7_SELECT + f" AND ds >= DATE '{Qy.JOB_START}'"),
    "cumulative_clear": _with([BARS, LAST7], LAST7_SELECT + f" AND ds <= DATE '{Qy.STEP_DAY}'"),
    "last7_step": _with([BARS, LAST7], LAST7_SELECT + f" AND ds = DATE '{Qy.STEP_DAY}'"),
    # mart
    "stg_customers": _with(STG, "SELECT * FROM stg_haunted_customers"),
    "stg_feedbacks": _with(STG, "SELECT * FROM stg_customer_feedbacks"),
    "stg_houses": _with(STG, "SELECT * FROM stg_haunted_houses"),
    "stg_tickets": _with(STG, "SELECT * FROM stg_haunted_house_tickets"),
    "valid_domains": _with(STG, """
SELECT split_part(email, '@', 2) AS valid_domain, COUNT(*) AS customers, CAST(NULL AS VARCHAR) AS bad_line
FROM stg_haunted_customers WHERE email LIKE '%@%' GROUP BY 1
UNION ALL
SELECT NULL, NULL, email || ',' || CAST(customer_id AS VARCHAR)
FROM stg_haunted_customers WHERE email NOT LIKE '%@%' AND customer_id % 100 = 3"""),
    "dq_unit_dim_customers": _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS], """
SELECT 'as expected' AS test, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS unexpected, 'pass' AS status
UNION ALL
SELECT 'every seventh flag wrong', COUNT(*), COUNT(*), CASE WHEN COUNT(*) = 0 THEN 'pass' ELSE 'fail' END
FROM dim_customers WHERE customer_id % 7 = 0"""),
    "fact_audit_job": _with(STG + [FACT], f"""
SELECT * FROM fact_visits WHERE purchase_date IS DISTINCT FROM DATE '{Qy.FAILED_DATE}'
UNION ALL
SELECT NULL, NULL, NULL, day, NULL, NULL, NULL, NULL, passed
FROM (VALUES (DATE '{Qy.AUDIT_DATE}', 'true'), (DATE '{Qy.FAILED_DATE}', 'false')) audits(day, passed)"""),
    "table_layouts": _with([BARS], f"""
SELECT * FROM (VALUES {", ".join(str(r) for r in LAYOUTS)}) declared(table_name, kind, name, detail)
UNION ALL
SELECT 'bars', 'partition', 'ds=' || CAST(ds AS VARCHAR), '' FROM (SELECT DISTINCT ds FROM bars)
UNION ALL
SELECT 'state', 'partition', 'ds=' || CAST(CAST(d AS DATE) AS VARCHAR), ''
FROM range(DATE '{Qy.DAY_START}', DATE '{Qy.STEP_DAY}' + 1, INTERVAL 1 DAY) days(d)"""),
    "dim_customers": _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS], "SELECT * FROM dim_customers"),
    "dim_houses": _with(STG + [DIM_HOUSES], "SELECT * FROM dim_haunted_houses"),
    "feet_to_meters": _with(STG, """
SELECT haunted_house_id, house_size,
  CAST(house_size * 0.3048 AS DECIMAL(16, 2)) AS size_m_scale2,
  CAST(house_size * 0.3048 AS DECIMAL(16, 4)) AS size_m_scale4
FROM stg_haunted_houses"""),
    "fact_visits": _with(STG + [FACT], "SELECT * FROM fact_visits"),
    "audit_fact_visits": _with(STG + [FACT, AUDIT], "SELECT * FROM audit_fact_visits"),
    "fact_visits_merge": _with(STG + [FACT], f"""
SELECT * REPLACE (CASE WHEN purchase_date <> DATE '{Qy.AUDIT_DATE}' AND ticket_id % {Qy.DATELESS} = 0
  THEN NULL ELSE purchase_date END AS purchase_date) FROM fact_visits"""),
    "mart_build": _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS, DIM_HOUSES, FACT], """
SELECT f.*, c.is_valid_email_address, h.house_name, h.house_size_in_m2 FROM fact_visits f
LEFT JOIN dim_customers c USING (customer_id) LEFT JOIN dim_haunted_houses h USING (haunted_house_id)"""),
    # publish
    "wap_gate": _with([BARS], f"""
SELECT d.ds, CASE WHEN COUNT(b.ds) = 0 THEN 'fail' ELSE 'pass' END AS dq_check
FROM (VALUES (DATE '{Qy.STEP_DAY}'), (DATE '{Qy.DAY_END}')) d(ds) LEFT JOIN bars b ON b.ds = d.ds GROUP BY d.ds"""),
    "wap_publish": _with([BARS], "SELECT * FROM bars"),
    "audit_then_publish": _with([BARS], f"SELECT * FROM bars WHERE ds <= DATE '{Qy.STEP_DAY}'"),
    "overwrite_snapshot": _with([BARS], f"""
SELECT {BAR_COLS}, ds AS created_at_day FROM bars WHERE ds = DATE '{Qy.STEP_DAY}'"""),
    # data tests
    "dq_not_null": _with(STG, "SELECT * FROM stg_haunted_house_tickets WHERE visit_date IS NULL"),
    "dq_unique": _with(STG, """
SELECT haunted_house_id AS unique_field, COUNT(*) AS n_records FROM stg_haunted_house_tickets
WHERE haunted_house_id IS NOT NULL GROUP BY haunted_house_id HAVING COUNT(*) > 1"""),
    "dq_accepted_values": _with(STG + [FACT], """
SELECT CAST(rating AS VARCHAR) AS value_field, COUNT(*) AS n_records FROM fact_visits
WHERE rating IS NOT NULL AND CAST(rating AS VARCHAR) NOT IN ('1', '2', '3', '4')
GROUP BY 1"""),
    "dq_relationships": _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS, FACT, AUDIT], """
SELECT * FROM audit_fact_visits
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM dim_customers WHERE is_valid_email_address)"""),
    "dq_is_positive": "SELECT c_acctbal AS positive_field FROM customer WHERE c_acctbal <= 0",
    "dq_valid_email": _with(STG, """
SELECT email FROM stg_haunted_customers
WHERE email NOT LIKE '%@%.%' OR email LIKE '%@%@%' OR email LIKE '@%' OR email LIKE '%@.%'
   OR email LIKE '%.@%'"""),
    "dq_nonempty": _with([BARS, f"""days AS (
  SELECT CAST(d AS DATE) AS ds
  FROM generate_series(TIMESTAMP '{Qy.DAY_START}', TIMESTAMP '{Qy.DAY_END}', INTERVAL 1 DAY) t(d))"""], """
SELECT days.ds, COALESCE(c.n, 0) AS row_count,
  CASE WHEN COALESCE(c.n, 0) = 0 THEN 'fail' ELSE 'pass' END AS dq_check
FROM days LEFT JOIN (SELECT ds, COUNT(*) AS n FROM bars GROUP BY ds) c ON c.ds = days.ds"""),
}


def _check_sql(model: str, test: str, column: str, where: str | None, values: tuple) -> str:
    w = f"({where}) AND " if where else ""
    if test == "not_null":
        n = f"SELECT COUNT(*) FROM {model} WHERE {w}{column} IS NULL"
    elif test == "unique":
        n = (f"SELECT COUNT(*) FROM (SELECT {column} FROM {model} WHERE {w}{column} IS NOT NULL "
             f"GROUP BY {column} HAVING COUNT(*) > 1)")
    elif test == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in values)
        n = f"SELECT COUNT(*) FROM {model} WHERE {w}CAST({column} AS VARCHAR) NOT IN ({vals})"
    elif test == "is_positive":
        n = f"SELECT COUNT(*) FROM {model} WHERE {w}{column} <= 0"
    else:
        raise ValueError(test)
    return (f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, "
            f"CAST(({n}) AS BIGINT) AS failures")


def _mart_checks() -> str:
    from kestrel.plans.jobs import MART_CHECKS
    parts = [_check_sql(m, c.test, c.column, c.where, c.values)
             for m, checks in MART_CHECKS.items() for c in checks]
    body = ("SELECT model, column_name, test, failures, "
            "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n"
            + "\nUNION ALL\n".join(parts) + "\n) r")
    return _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS, DIM_HOUSES, FACT], body)


ORACLE["dq_mart_checks"] = _mart_checks()
ORACLE["dq_audit_checks"] = _with(STG + [VALID_DOMAINS, DIM_CUSTOMERS, DIM_HOUSES, FACT, AUDIT], """
SELECT 'audit_fact_visits' AS model, column_name, test, CAST(failures AS BIGINT) AS failures,
  CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (
  SELECT 'ticket_id' AS column_name, 'not_null' AS test, COUNT(*) FILTER (WHERE ticket_id IS NULL) AS failures FROM audit_fact_visits
  UNION ALL SELECT 'ticket_id', 'unique', COUNT(ticket_id) - COUNT(DISTINCT ticket_id) FROM audit_fact_visits
  UNION ALL SELECT 'customer_id', 'not_null', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM audit_fact_visits
  UNION ALL SELECT 'customer_id', 'relationships', COUNT(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)) FROM audit_fact_visits
  UNION ALL SELECT 'haunted_house_id', 'not_null', COUNT(*) FILTER (WHERE haunted_house_id IS NULL) FROM audit_fact_visits
  UNION ALL SELECT 'haunted_house_id', 'relationships', COUNT(*) FILTER (WHERE haunted_house_id NOT IN
    (SELECT haunted_house_id FROM dim_haunted_houses WHERE haunted_house_id > 20)) FROM audit_fact_visits) r""")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
