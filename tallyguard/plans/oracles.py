"""The registered queries in plain SQL, for checking on the same tables."""

from __future__ import annotations

from tallyguard.functions.geo import CITIES
from tallyguard.operators.availability import PRODUCTS
from tallyguard.plans import derived

DAY = 86_400_000

# --- derived tables ----------------------------------------------------------

_NAMES = [city for city, _, _ in CITIES] + derived.UNKNOWN_CITIES
_CITY_LIST = "[" + ", ".join(f"'{name}'" for name in _NAMES) + "]"
_CITY = f"""
CASE WHEN (event_id*5 + user_id) % 23 >= {len(_NAMES)} THEN NULL
     WHEN event_id % 7 = 0 THEN upper({_CITY_LIST}[(event_id*5 + user_id) % 23 + 1])
     ELSE {_CITY_LIST}[(event_id*5 + user_id) % 23 + 1] END
"""

TXN = f"""
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS account_id,
         CASE WHEN event_type IN ('signup', 'view') THEN 'DEPOSIT'
              WHEN event_type = 'error' THEN 'TRANSFER' ELSE 'WITHDRAW' END AS type,
         CAST(value AS DECIMAL(18,2)) AS amount,
         CAST(round(value * 100) AS BIGINT) AS cents,
         {_CITY} AS city,
         epoch_us(ts) // 1000 AS event_ms,
         epoch_us(CASE WHEN event_id % 10 = 3 THEN ts - INTERVAL 2 HOUR ELSE ts END) // 1000
           AS record_ms,
         event_id * 2 AS arrival,
         user_id % 3 AS part
  FROM events)
"""

REPLAYED = """
txn_all AS (
  SELECT * FROM txn
  UNION ALL
  SELECT * REPLACE (arrival + 1001 AS arrival) FROM txn
  WHERE CAST(transaction_id AS BIGINT) % 50 = 0)
"""

ORDER_TXN = """
txn AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS account_id,
         CASE WHEN o_orderstatus = 'F' THEN 'DEPOSIT' ELSE 'WITHDRAW' END AS type,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         epoch_us(o_orderdate) // 1000 AS event_ms,
         o_orderkey AS arrival
  FROM orders)
"""

ACCOUNTS = """
acc AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS holder_name,
         CAST(round(c_acctbal * 100) AS BIGINT) AS opening,
         CASE WHEN c_custkey % 29 = 0 THEN 'FROZEN' ELSE 'ACTIVE' END AS status
  FROM customer WHERE c_custkey % 17 <> 0)
"""

LEDGER = """
led AS (SELECT transaction_id FROM txn WHERE CAST(transaction_id AS BIGINT) % 97 = 5)
"""

REQUESTS = """
req AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '  '
              ELSE CAST(user_id AS VARCHAR) END AS account_id,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 13 = 1 THEN 'REFUND'
              WHEN event_type IN ('signup', 'view') THEN 'DEPOSIT'
              WHEN event_type = 'error' THEN 'TRANSFER' ELSE 'WITHDRAW' END AS type,
         CASE WHEN event_id % 5 = 0 THEN NULL
              WHEN event_id % 5 = 1 THEN -CAST(round(value * 100) AS BIGINT)
              WHEN event_id % 35 = 2 THEN 1
              ELSE CAST(round(value * 100) AS BIGINT) END AS cents,
         {city} AS city, epoch_us(ts) // 1000 AS event_ms
  FROM events),
checked AS (
  SELECT *, concat_ws(',',
           CASE WHEN account_id IS NULL OR trim(account_id) = '' THEN 'accountId' END,
           CASE WHEN type IS NULL OR type NOT IN ('DEPOSIT', 'WITHDRAW', 'TRANSFER')
                THEN 'type' END,
           CASE WHEN cents IS NULL OR cents < 1 THEN 'amount' END) AS violations
  FROM req)
""".replace("{city}", _CITY)

# --- alerts ------------------------------------------------------------------


def _large(source: str, limit: int) -> str:
    return f"""
    SELECT account_id, transaction_id, 'LARGE_AMOUNT' AS rule_type,
           'Large transaction: ' || CAST(amount AS VARCHAR) || ' exceeds {limit}' AS reason,
           CAST(1 AS BIGINT) AS alert_count, arrival AS trigger_arrival, event_ms AS alert_ms
    FROM {source} WHERE cents > {limit * 100}"""


def _spike_ctes(source: str) -> str:
    return f"""
    hist AS (
      SELECT *,
        coalesce(sum(cents) OVER w, 0) AS prior_cents, count(cents) OVER w AS prior_count
      FROM {source}
      WINDOW w AS (PARTITION BY account_id ORDER BY arrival
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    stats AS (
      SELECT *, CASE WHEN prior_count = 0 THEN 0
                     ELSE (2*prior_cents + prior_count) // (2*prior_count) END AS mean
      FROM hist)"""


def _spike(multiplier_tenths: int, shown: str, history: int = 3) -> str:
    return f"""
    SELECT account_id, transaction_id, 'SPEND_SPIKE' AS rule_type,
           'Spike: ' || CAST(amount AS VARCHAR) || ' > {shown}x rolling avg ' ||
             CAST(CAST(mean AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS VARCHAR) AS reason,
           CAST(1 AS BIGINT) AS alert_count, arrival AS trigger_arrival, event_ms AS alert_ms
    FROM stats WHERE prior_count >= {history} AND cents * 10 > mean * {multiplier_tenths}"""


_CITY_ROWS = ", ".join(f"('{c}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for c, lat, lon in CITIES)


def _geo_ctes(source: str) -> str:
    return f"""
    city(key, lat, lon) AS (VALUES {_CITY_ROWS}),
    chain AS (
      SELECT *, lag(city) OVER w AS from_city, lag(event_ms) OVER w AS from_ms
      FROM {source} WHERE city IS NOT NULL
      WINDOW w AS (PARTITION BY account_id ORDER BY arrival)),
    trip AS (
      SELECT chain.*,
        2 * 6371.0 * asin(sqrt(
          sin(radians(t.lat - f.lat) / 2) ** 2 +
          cos(radians(f.lat)) * cos(radians(t.lat)) * sin(radians(t.lon - f.lon) / 2) ** 2)) AS km
      FROM chain JOIN city f ON f.key = lower(from_city) JOIN city t ON t.key = lower(chain.city)
      WHERE lower(from_city) <> lower(chain.city)),
    speed AS (
      SELECT *, km / (greatest(event_ms - from_ms, 1) / 3600000.0) AS kmh FROM trip)"""


_GEO = """
    SELECT account_id, transaction_id, 'GEO_IMPOSSIBLE' AS rule_type,
           'Impossible travel: ' || from_city || ' -> ' || city || ' (' ||
             CAST(CAST(floor(km + 0.5) AS BIGINT) AS VARCHAR) || ' km) would require ' ||
             CAST(CAST(floor(kmh + 0.5) AS BIGINT) AS VARCHAR) || ' km/h' AS reason,
           CAST(1 AS BIGINT) AS alert_count, arrival AS trigger_arrival, event_ms AS alert_ms
    FROM speed WHERE kmh > 900"""


def _timed_ctes(source: str) -> str:
    return f"""
    timed AS (
      SELECT *, record_ms - record_ms % {DAY} AS window_start_ms,
        max(record_ms) OVER (PARTITION BY part ORDER BY arrival
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_ms
      FROM {source}),
    on_time AS (
      SELECT * FROM timed WHERE window_start_ms + {DAY} + 600000 > stream_ms)"""


def _velocity(source: str) -> str:
    return f"""
    SELECT account_id, CAST(NULL AS VARCHAR) AS transaction_id, 'HIGH_VELOCITY' AS rule_type,
           'Too many transactions: ' || CAST(n AS VARCHAR) || ' in 86400s' AS reason,
           n AS alert_count, arrival AS trigger_arrival, event_ms AS alert_ms
    FROM (SELECT *, row_number() OVER (PARTITION BY account_id, window_start_ms
                                       ORDER BY arrival) AS n FROM {source})
    WHERE n > 5"""


def _all_ctes(source: str) -> str:
    return f"""{_timed_ctes(source)}, {_spike_ctes(source)}, {_geo_ctes(source)},
    alerts AS ({_velocity("on_time")} UNION ALL {_large(source, 200)}
               UNION ALL {_spike(50, "5.0")} UNION ALL {_GEO})"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(c.strip() for c in ctes) + "\n"


# --- balances ----------------------------------------------------------------


def _freezes(alerts: str) -> str:
    return f"""
    freezes AS (
      SELECT account_id, min(trigger_arrival) AS freeze_arrival
      FROM ({alerts}) JOIN acc USING (account_id) WHERE status = 'ACTIVE' GROUP BY account_id)"""


_NO_FREEZES = """
    freezes AS (SELECT account_id, CAST(NULL AS BIGINT) AS freeze_arrival FROM acc WHERE false)"""


def _walk(source: str, name: str = "", accounts: str = "acc", ledger: str = "led",
          freezes: str = "freezes") -> str:
    """One record per account and step; state is the balance and the repeated ids applied."""
    return f"""
    steps{name} AS (
      SELECT t.*, a.opening, l.transaction_id IS NOT NULL AS in_ledger,
        coalesce(t.type <> 'DEPOSIT' AND (a.status = 'FROZEN'
                 OR t.arrival > f.freeze_arrival), false) AS blocked,
        count(*) OVER (PARTITION BY t.account_id, t.transaction_id) > 1 AS repeated,
        row_number() OVER (PARTITION BY t.account_id ORDER BY t.arrival) AS step
      FROM {source} t LEFT JOIN {accounts} a ON a.account_id = t.account_id
        LEFT JOIN {freezes} f ON f.account_id = t.account_id
        LEFT JOIN {ledger} l ON l.transaction_id = t.transaction_id),
    walk{name} AS (
      SELECT account_id, CAST(0 AS BIGINT) AS step, min(opening) AS balance,
             CAST([] AS VARCHAR[]) AS done, CAST('' AS VARCHAR) AS outcome
      FROM steps{name} GROUP BY account_id
      UNION ALL
      SELECT account_id, step,
             CASE WHEN outcome <> 'APPLIED' THEN balance
                  WHEN type = 'DEPOSIT' THEN balance + cents ELSE balance - cents END,
             CASE WHEN outcome = 'APPLIED' AND repeated THEN list_append(done, transaction_id)
                  ELSE done END,
             outcome
      FROM (
        SELECT s.account_id, s.step, s.type, s.cents, s.transaction_id, s.repeated,
               w.balance, w.done,
               CASE WHEN s.in_ledger OR list_contains(w.done, s.transaction_id) THEN 'DUPLICATE'
                    WHEN s.opening IS NULL THEN 'UNKNOWN_ACCOUNT'
                    WHEN s.blocked THEN 'ACCOUNT_FROZEN'
                    WHEN s.type <> 'DEPOSIT' AND w.balance < s.cents THEN 'INSUFFICIENT_FUNDS'
                    ELSE 'APPLIED' END AS outcome
        FROM walk{name} w JOIN steps{name} s
          ON s.account_id = w.account_id AND s.step = w.step + 1)),
    outcomes{name} AS (
      SELECT s.transaction_id, s.account_id, s.type, s.amount, s.cents, s.city, s.event_ms,
             s.arrival, s.part,
             CASE WHEN outcome IN ('APPLIED', 'DUPLICATE') THEN outcome ELSE 'REJECTED'
                  END AS status,
             CASE WHEN outcome NOT IN ('APPLIED', 'DUPLICATE') THEN outcome END AS error_class,
             CASE outcome
               WHEN 'UNKNOWN_ACCOUNT' THEN 'Unknown account: ' || s.account_id
               WHEN 'ACCOUNT_FROZEN' THEN 'Account frozen: ' || s.account_id || ' — ' || s.type
                                          || ' rejected pending fraud review'
               WHEN 'INSUFFICIENT_FUNDS' THEN 'Insufficient funds for ' || s.account_id
               END AS error_message,
             CASE WHEN outcome = 'APPLIED' THEN w.balance END AS balance_after_cents
      FROM walk{name} w JOIN steps{name} s
        ON s.account_id = w.account_id AND s.step = w.step)"""


_OUTCOME_COLUMNS = """SELECT transaction_id, account_id, arrival, status, error_class,
  error_message, balance_after_cents"""
_BASE = (TXN, REPLAYED, ACCOUNTS, LEDGER)
_APPLY = _with(*_BASE, _NO_FREEZES, _walk("txn_all"), recursive=True)
_LOOP = _with(
    *_BASE,
    _all_ctes("txn_all"),
    _freezes("SELECT * FROM alerts"),
    _walk("txn_all"),
    recursive=True,
)
_MOVED = """(SELECT account_id,
   sum(CASE WHEN type = 'DEPOSIT' THEN cents ELSE -cents END) AS moved, count(*) AS n
 FROM outcomes WHERE status = 'APPLIED' GROUP BY account_id)"""

# --- designs and availability ------------------------------------------------


def _alias(names: list[str]) -> str:
    return "coalesce(" + ", ".join(f"r ->> '$.{name}'" for name in names) + ")"


def _unwrapped(source: str, columns: str) -> str:
    return f"""
    parsed AS (SELECT {columns},
      CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM ({source})),
    listed AS (SELECT * EXCLUDE (j), CASE
        WHEN json_type(j) = 'ARRAY' THEN CAST(j AS JSON[])
        WHEN json_type(j, '$.rows') = 'ARRAY' THEN CAST(j -> '$.rows' AS JSON[])
        ELSE CAST([] AS JSON[]) END AS items FROM parsed),
    unwrapped AS (SELECT * EXCLUDE (items, place), items[place] AS r,
                         CAST(place - 1 AS BIGINT) AS row_index
      FROM (SELECT *, unnest(range(1, len(items) + 1)) AS place FROM listed))"""


def _sql_names():
    from tallyguard.operators import designs

    return designs


_D = _sql_names()
_TYPES = _unwrapped(f"SELECT p_partkey AS pos, {derived.TYPE_PAYLOAD_SQL} AS payload FROM part", "pos")
_FOLDERS = _unwrapped(
    f"SELECT s_suppkey AS pos, {derived.FOLDER_PAYLOAD_SQL} AS payload FROM supplier", "pos"
)
_MAPPINGS = _unwrapped(
    "SELECT CAST(l_suppkey AS VARCHAR) AS folder_id, "
    f"{derived.MAPPING_PAYLOAD_SQL} AS payload FROM lineitem",
    "folder_id",
)
_FOLDER_TABLE = f"""
    folders AS (SELECT {_alias(_D.FOLDER_ID)} AS folder_id,
                       coalesce({_alias(_D.FOLDER_NAME)}, '') AS folder_name FROM unwrapped)"""
_TYPE_PAIRS = f"""
    pairs AS (SELECT * FROM (
      SELECT pos, row_index, {_alias(_D.TYPE_ID)} AS id, {_alias(_D.TYPE_NAME)} AS name
      FROM unwrapped) WHERE id IS NOT NULL AND trim(coalesce(name, '')) <> '')"""

_GRID = "grid AS (SELECT " + ", ".join(
    f"{derived.GRID_SQL[source]} AS {name}" for name, source in _D.GRID_FIELDS.items()
) + " FROM orders)"

_PRODUCT_ROWS = ", ".join(
    f"('{retailer}', '{product}', '{code}', {number})"
    for number, (retailer, product, code) in enumerate(PRODUCTS)
)
_RESULTS = f"""
    pair(retailer, product, code, ordinal) AS (VALUES {_PRODUCT_ROWS}),
    slots AS (
      SELECT run_id, retailer, product, CAST(s_suppkey + 411001 AS VARCHAR) AS pincode,
             {derived.RESPONSE_SLOT} AS slot
      FROM supplier, pair, (SELECT unnest(range(1, {derived.RUNS + 1})) AS run_id)),
    resp AS (SELECT *, CASE WHEN slot = 7 THEN 503 ELSE 200 END AS http_status,
                    {derived.RESPONSE_BODY} AS body FROM slots),
    vals AS (SELECT *, lower(body) AS text,
        CASE WHEN json_valid(body) THEN coalesce(
          CAST(json_extract(body, '$.pinCodeDetails') AS VARCHAR), 'null') END AS pin,
        CASE WHEN json_valid(body) THEN coalesce(
          CAST(json_extract(body, '$.promiseDetails') AS VARCHAR), 'null') END AS promise
      FROM resp),
    results AS (
      SELECT run_id, retailer, product, pincode, CASE
        WHEN slot = 15 THEN 'ERROR: ConnectTimeout'
        WHEN http_status <> 200 THEN 'ERROR: HTTP ' || CAST(http_status AS VARCHAR)
        WHEN NOT json_valid(body) THEN 'ERROR: bad JSON'
        WHEN retailer = 'Croma' THEN CASE
          WHEN contains(text, 'not serviceable') OR contains(text, 'out of stock')
            THEN 'OUT OF STOCK'
          WHEN pin NOT IN ('null', 'false', '0', '0.0', '[]', '{{}}', '""')
            OR promise NOT IN ('null', 'false', '0', '0.0', '[]', '{{}}', '""')
            OR contains(text, 'eddmessage') THEN 'IN STOCK'
          ELSE 'OUT OF STOCK' END
        WHEN regexp_matches(text, '"serviceable"\\s*:\\s*true') THEN 'IN STOCK'
        ELSE 'OUT OF STOCK' END AS status
      FROM vals)"""
_KEY = "retailer || '|' || product || '|' || pincode"


def _windows(counts: str) -> str:
    return f"SELECT account_id, window_start_ms, window_start_ms + {DAY} AS window_end_ms, n {counts}"


_COUNTED = f"""counted AS (
  SELECT account_id, record_ms - record_ms % {DAY} AS window_start_ms, count(*) AS n
  FROM txn GROUP BY ALL)"""

_DATE = "CASE WHEN coalesce({c}, '') = '' THEN 'N/A' ELSE strftime(CAST({c} AS TIMESTAMP), '{f}') END"


def _date(column: str, form: str) -> str:
    return _DATE.format(c=column, f=form)


ORACLES: dict[str, str] = {
    "src_transactions": _with(TXN) + """
        SELECT transaction_id, account_id, type, cents, city, event_ms, record_ms, arrival,
               part AS partition FROM txn""",
    "validate_requests": _with(REQUESTS) + """
        SELECT transaction_id, violations, violations = '' AS is_valid FROM checked""",
    "normalize_requests": _with(REQUESTS) + """
        SELECT transaction_id, account_id, type, cents, city, event_ms
        FROM checked WHERE violations = ''""",
    "rule_large_amount": _with(TXN) + _large("txn", 200),
    "rule_large_amount_orders": _with(ORDER_TXN) + _large("txn", 400000),
    "velocity_counts": _with(TXN, _COUNTED) + _windows("FROM counted"),
    "rule_high_velocity_final": _with(TXN, _COUNTED) + _windows("FROM counted WHERE n > 5"),
    "rule_high_velocity_changelog": _with(TXN, _timed_ctes("txn")) + _velocity("timed"),
    "late_records": _with(TXN, _timed_ctes("txn")) + f"""
        SELECT transaction_id, account_id, arrival, part AS partition, window_start_ms, stream_ms
        FROM timed WHERE window_start_ms + {DAY} + 600000 <= stream_ms""",
    "velocity_with_grace": _with(TXN, _timed_ctes("txn")) + _velocity("on_time"),
    "rolling_stats": _with(TXN, _spike_ctes("txn")) + """
        SELECT transaction_id, account_id, CAST(prior_cents AS BIGINT) AS prior_cents,
               prior_count, CAST(mean AS BIGINT) AS prior_mean_cents FROM stats""",
    "rule_spend_spike": _with(TXN, _spike_ctes("txn")) + _spike(50, "5.0"),
    "rule_spend_spike_orders": _with(ORDER_TXN, _spike_ctes("txn")) + _spike(25, "2.5"),
    "rule_geo_impossible": _with(TXN, _geo_ctes("txn")) + _GEO,
    "all_alerts": _with(TXN, _all_ctes("txn")) + "SELECT * FROM alerts",
    "dedup_alerts": _with(TXN, _all_ctes("txn")) + f"""
        SELECT account_id, transaction_id, rule_type, trigger_arrival, window_start_ms, n_alerts
        FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY account_id,
                rule_type, window_start_ms) AS n_alerts
              FROM (SELECT *, alert_ms - alert_ms % {DAY} AS window_start_ms FROM alerts)
              WINDOW w AS (PARTITION BY account_id, rule_type, window_start_ms
                           ORDER BY trigger_arrival))
        WHERE rn = 1""",
    "rule_backfill": _with(TXN, _spike_ctes("txn"), f"strict AS ({_spike(30, '3.0', 5)})") + """
        SELECT account_id, count(*) AS n_alerts, min(trigger_arrival) AS first_arrival
        FROM strict GROUP BY account_id""",
    "velocity_hopping": _with(TXN) + f"""
        SELECT account_id, start_ms AS window_start_ms, start_ms + {DAY} AS window_end_ms,
               count(*) AS n
        FROM (SELECT account_id, record_ms - record_ms % 21600000 - 21600000 * hop AS start_ms
              FROM txn, (SELECT unnest([0, 1, 2, 3]) AS hop))
        GROUP BY ALL HAVING count(*) > 5""",
    "velocity_sliding": _with(TXN) + f"""
        SELECT transaction_id, account_id, arrival, n FROM (
          SELECT *, count(*) OVER (PARTITION BY account_id ORDER BY record_ms
            RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS n FROM txn)
        WHERE n > 5""",
    "unknown_account_rejects": _with(TXN, ACCOUNTS) + """
        SELECT transaction_id, account_id, 'Unknown account: ' || account_id AS error_message
        FROM txn WHERE account_id NOT IN (SELECT account_id FROM acc)""",
    "new_transactions": _with(TXN, REPLAYED, LEDGER) + """
        SELECT transaction_id, account_id, arrival, cents FROM txn_all
        WHERE transaction_id NOT IN (SELECT transaction_id FROM led)""",
    "dedup_transactions": _APPLY + """
        SELECT transaction_id, account_id, arrival FROM outcomes WHERE status = 'DUPLICATE'""",
    "freeze_accounts": _with(TXN, REPLAYED, ACCOUNTS, _all_ctes("txn_all"), _freezes("SELECT * FROM alerts")) + """
        SELECT a.account_id, holder_name, opening AS cents,
               CASE WHEN f.account_id IS NOT NULL THEN 'FROZEN' ELSE status END AS status
        FROM acc a LEFT JOIN freezes f ON f.account_id = a.account_id""",
    "first_alerts": _with(TXN, _all_ctes("txn")) + """
        SELECT account_id, min(trigger_arrival) AS first_arrival,
               arg_min(rule_type, (trigger_arrival, rule_type)) AS rule_type, count(*) AS n_alerts
        FROM alerts GROUP BY account_id""",
    "alert_rejects": _with(TXN, ACCOUNTS, _all_ctes("txn")) + """
        SELECT account_id, transaction_id, rule_type,
               'Unknown account: ' || account_id AS error_message
        FROM alerts WHERE account_id NOT IN (SELECT account_id FROM acc)""",
    "frozen_rejects": _with(TXN, REPLAYED, ACCOUNTS, _all_ctes("txn_all"), _freezes("SELECT * FROM alerts")) + """
        SELECT t.transaction_id, t.account_id, t.arrival,
               'Account frozen: ' || t.account_id || ' — ' || t.type
                 || ' rejected pending fraud review' AS error_message
        FROM txn_all t JOIN acc a ON a.account_id = t.account_id
          LEFT JOIN freezes f ON f.account_id = t.account_id
        WHERE t.type <> 'DEPOSIT' AND (a.status = 'FROZEN' OR t.arrival > f.freeze_arrival)""",
    "apply_transactions": _APPLY + _OUTCOME_COLUMNS + " FROM outcomes",
    "account_balances": _APPLY + f"""
        SELECT a.account_id, holder_name, CAST(opening + coalesce(moved, 0) AS BIGINT) AS cents,
               status, coalesce(n, 0) AS n_applied
        FROM acc a LEFT JOIN {_MOVED} m ON m.account_id = a.account_id""",
    "ledger_append": _APPLY + """
        SELECT transaction_id, account_id, type, cents, event_ms AS processed_ms
        FROM outcomes WHERE status = 'APPLIED'""",
    "dead_letters": _LOOP + """
        SELECT 'transactions.DLT' AS dlt_topic, account_id AS key, 'transactions' AS orig_topic,
               part AS orig_partition, arrival AS orig_offset, error_class, error_message,
               '{"transactionId":"' || transaction_id || '","accountId":"' || account_id
                 || '","type":"' || type || '","amount":' || CAST(amount AS VARCHAR)
                 || CASE WHEN city IS NULL THEN '' ELSE ',"city":"' || city || '"' END
                 || ',"timestamp":' || CAST(event_ms AS VARCHAR) || '}' AS payload
        FROM outcomes WHERE status = 'REJECTED'""",
    "rejection_report": _LOOP + """
        SELECT error_class, account_id, count(*) AS n_rejected, min(arrival) AS first_offset,
               max(arrival) AS last_offset
        FROM outcomes WHERE status = 'REJECTED' GROUP BY error_class, account_id""",
    "replay_rejects": _with(
        *_BASE,
        _all_ctes("txn_all"),
        _freezes("SELECT * FROM alerts"),
        _walk("txn_all"),
        """acc2 AS (SELECT a.account_id, holder_name,
             CAST(opening + coalesce(moved, 0) AS BIGINT) AS opening,
             CASE WHEN f.account_id IS NOT NULL THEN 'FROZEN' ELSE status END AS status
           FROM acc a LEFT JOIN freezes f ON f.account_id = a.account_id
             LEFT JOIN """ + _MOVED + """ m ON m.account_id = a.account_id)""",
        """led2 AS (SELECT transaction_id FROM led UNION
                    SELECT transaction_id FROM outcomes WHERE status = 'APPLIED')""",
        """none AS (SELECT account_id, CAST(NULL AS BIGINT) AS freeze_arrival FROM acc
                    WHERE false)""",
        "again AS (SELECT * EXCLUDE (status, error_class, error_message, balance_after_cents) "
        "FROM outcomes WHERE status = 'REJECTED')",
        _walk("again", "2", "acc2", "led2", "none"),
        recursive=True,
    ) + _OUTCOME_COLUMNS + " FROM outcomes2",
    "flagship": _LOOP + _OUTCOME_COLUMNS + " FROM outcomes",
    "flagship_balances": _LOOP + f"""
        SELECT a.account_id, CAST(opening + coalesce(moved, 0) AS BIGINT) AS cents,
               CASE WHEN f.account_id IS NOT NULL THEN 'FROZEN' ELSE status END AS status,
               coalesce(n, 0) AS n_applied
        FROM acc a LEFT JOIN freezes f ON f.account_id = a.account_id
          LEFT JOIN {_MOVED} m ON m.account_id = a.account_id""",
    "stream_large_amount": _with(TXN) + _large("txn", 200),
    "stream_velocity": _with(TXN, _timed_ctes("txn")) + _velocity("on_time"),
    "stream_account_alerts": _with(TXN, _spike_ctes("txn"), _geo_ctes("txn"))
    + f"{_large('txn', 200)} UNION ALL {_spike(50, '5.0')} UNION ALL {_GEO}",
    "stream_balances": _LOOP + _OUTCOME_COLUMNS + " FROM outcomes",
    "stream_freezes": _LOOP + f"""
        SELECT a.account_id, CAST(opening + coalesce(moved, 0) AS BIGINT) AS cents,
               CASE WHEN f.account_id IS NOT NULL THEN 'FROZEN' ELSE status END AS status
        FROM acc a LEFT JOIN freezes f ON f.account_id = a.account_id
          LEFT JOIN {_MOVED} m ON m.account_id = a.account_id""",
    "stream_alert_rejects": _with(TXN, REPLAYED, ACCOUNTS, _all_ctes("txn_all")) + """
        SELECT 'alerts.DLT' AS dlt_topic, account_id AS key, 'alerts' AS orig_topic,
               trigger_arrival AS orig_offset, 'UNKNOWN_ACCOUNT' AS error_class,
               'Unknown account: ' || account_id AS error_message
        FROM alerts WHERE account_id NOT IN (SELECT account_id FROM acc)""",
    "stream_dedup_alerts": _with(TXN, _all_ctes("txn")) + f"""
        SELECT account_id, transaction_id, rule_type, trigger_arrival, window_start_ms
        FROM (SELECT *, row_number() OVER (PARTITION BY account_id, rule_type, window_start_ms
                                           ORDER BY trigger_arrival) AS rn
              FROM (SELECT *, alert_ms - alert_ms % {DAY} AS window_start_ms FROM alerts))
        WHERE rn = 1""",
    "stream_flagship": _LOOP + _OUTCOME_COLUMNS + " FROM outcomes",
    "stream_dead_letters": _LOOP + """
        SELECT 'transactions.DLT' AS dlt_topic, account_id AS key, arrival AS orig_offset,
               error_class, error_message
        FROM outcomes WHERE status = 'REJECTED'
        UNION ALL
        SELECT 'alerts.DLT', account_id, trigger_arrival, 'UNKNOWN_ACCOUNT',
               'Unknown account: ' || account_id
        FROM alerts WHERE account_id NOT IN (SELECT account_id FROM acc)""",
    "velocity_session": _with(TXN) + """
        SELECT account_id, min(record_ms) AS start_ms, max(record_ms) AS end_ms, count(*) AS n
        FROM (SELECT *, sum(CASE WHEN record_ms - before <= 21600000 THEN 0 ELSE 1 END) OVER (
                PARTITION BY account_id ORDER BY record_ms, arrival) AS session
              FROM (SELECT *, lag(record_ms) OVER (PARTITION BY account_id
                      ORDER BY record_ms, arrival) AS before FROM txn))
        GROUP BY account_id, session HAVING count(*) > 5""",
    "paged_index": """
        SELECT id, name, category, page FROM (
          SELECT p_partkey AS id, p_name AS name, p_type AS category,
                 (row_number() OVER (ORDER BY p_name, p_partkey) - 1) // 50 + 1 AS page,
                 (count(*) OVER () - 1) // 50 + 1 AS last_page FROM part)
        WHERE page = 3 OR page = last_page""",
    "paged_seek": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category
        FROM part, (SELECT p_name AS n, p_partkey AS k FROM part ORDER BY p_partkey DESC LIMIT 1)
        WHERE p_name < n OR (p_name = n AND p_partkey > k)
        ORDER BY p_name DESC, p_partkey LIMIT 50""",
    "products_by_category": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category,
               CAST(round(p_retailprice * 100) AS BIGINT) AS cents
        FROM part WHERE lower(p_type) = 'promo'""",
    "category_summary": """
        SELECT category, n AS product_count, CAST(total AS BIGINT) AS total_cents,
               CAST((2*total + n) // (2*n) AS BIGINT) AS average_cents
        FROM (SELECT p_type AS category, count(*) AS n, min(p_partkey) AS first_id,
                     sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS total
              FROM part GROUP BY ALL) ORDER BY total DESC, first_id""",
    "category_brand_summary": """
        SELECT category, brand, n AS product_count, CAST(total AS BIGINT) AS total_cents,
               CAST((2*total + n) // (2*n) AS BIGINT) AS average_cents
        FROM (SELECT p_type AS category, p_brand AS brand, count(*) AS n,
                     sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS total
              FROM part GROUP BY ALL)""",
    "inventory_report": """
        SELECT count(*) AS product_count,
               CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT) * p_size) AS BIGINT)
                 AS total_inventory_cents
        FROM part""",
    "paged_listing": """
        SELECT p_partkey AS id, p_name AS name, p_type AS category
        FROM part ORDER BY p_name, p_partkey LIMIT 50 OFFSET 100""",
    "unwrap_rows": _with(_TYPES) + f"""
        SELECT pos, row_index, {_alias(_D.TYPE_ID)} AS id, {_alias(_D.TYPE_NAME)} AS name
        FROM unwrapped""",
    "dedup_design_types": _with(_TYPES, _TYPE_PAIRS) + """
        SELECT id, name, pos, row_index FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos, row_index) AS rn FROM pairs)
        WHERE rn = 1""",
    "distinct_design_names": _with(_TYPES) + f"""
        SELECT name, pos, row_index FROM (
          SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos, row_index) AS rn
          FROM (SELECT pos, row_index, {_alias(_D.DESIGN_NAME)} AS name FROM unwrapped)
          WHERE trim(coalesce(name, '')) <> '')
        WHERE rn = 1""",
    "folder_search": _with(_FOLDERS, _FOLDER_TABLE) + """
        SELECT folder_id, folder_name FROM folders
        WHERE contains(lower(folder_name), 'group')""",
    "folder_mappings": f"""
        WITH folders AS ({_with(_FOLDERS, _FOLDER_TABLE)} SELECT * FROM folders),
        details AS ({_with(_MAPPINGS)}
          SELECT folder_id, coalesce({_alias(_D.MAPPING_NAME)}, '') AS design_name,
                 coalesce({_alias(_D.MAPPING_ABBREVIATION)}, '') AS abbreviation,
                 CASE WHEN {_alias(_D.MAPPING_MULTIPLE)} = 'true' THEN 'Yes' ELSE 'No' END
                   AS multiple_instance,
                 CASE WHEN {_alias(_D.MAPPING_INCLUDED)} = 'true' THEN 'Yes' ELSE 'No' END
                   AS include
          FROM unwrapped)
        SELECT folder_id, folder_name, design_name, abbreviation, multiple_instance, include
        FROM folders JOIN details USING (folder_id)""",
    "type_designs": """
        SELECT r_name AS type_name, n_name AS design_name, s_name AS version,
               ['active', 'draft', 'deprecated', 'other'][s_suppkey % 4 + 1] AS status_group
        FROM region JOIN nation ON n_regionkey = r_regionkey
          JOIN supplier ON s_nationkey = n_nationkey""",
    "grid_projection": _with(_GRID) + f"""
        SELECT formID, coalesce(formName, '') AS formName,
               coalesce(documentDesignName, '') AS documentDesignName,
               coalesce(versionNumber, '') AS versionNumber,
               {_date("effectiveDate", "%Y-%m-%d")} AS effectiveDate,
               coalesce(status, '') AS status, coalesce(addedBy, '') AS addedBy,
               {_date("compiledDate", "%Y-%m-%d %H:%M:%S")} AS compiledDate,
               coalesce(compiledStatus, '') AS compiledStatus,
               CASE WHEN compiledStatus IN ('Complete', 'Finalized') THEN 'success'
                    WHEN compiledStatus = 'Errored' THEN 'error'
                    WHEN compiledStatus = 'Queued' THEN 'pending' END AS compiledGroup,
               CASE WHEN errorMessage IS NOT NULL THEN 'Yes' ELSE 'No' END AS hasError
        FROM grid""",
    "grid_filter": _with(_GRID) + """
        SELECT formID, formName, documentDesignName, compiledStatus FROM grid
        WHERE contains(lower(coalesce(formName, '')), 'urg')
          AND contains(lower(coalesce(documentDesignName, '')), '_1')
          AND contains(lower(coalesce(addedBy, '')), 'clerk')
          AND contains(lower(coalesce(compiledDate, '')), 't23')
          AND contains(lower(trim(coalesce(compiledStatus, ''))), 'complete')""",
    "select_by_keys": _with(_GRID) + """
        SELECT formID, displayText FROM grid
        WHERE formID IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "sweep_grid": f"""
        SELECT CAST(c_custkey + 411001 AS VARCHAR) AS pincode, retailer, product, code
        FROM customer, (VALUES {_PRODUCT_ROWS}) AS pair(retailer, product, code, ordinal)""",
    "classify_availability": _with(_RESULTS) + """
        SELECT run_id, retailer, product, pincode, status FROM results""",
    "sweep_totals": _with(_RESULTS) + """
        SELECT run_id, count(*) AS n_checks,
               count(*) FILTER (status = 'IN STOCK') AS n_hits,
               count(*) FILTER (starts_with(status, 'ERROR')) AS n_errors
        FROM results GROUP BY run_id""",
    "new_hits": _with(_RESULTS) + f"""
        SELECT {_KEY} AS alert_key, retailer, product, pincode FROM results
        WHERE run_id = {derived.RUNS} AND status = 'IN STOCK' AND {_KEY} NOT IN (
          SELECT {_KEY} FROM results WHERE run_id = {derived.RUNS - 1} AND status = 'IN STOCK')""",
    "alert_state": _with(_RESULTS) + f"""
        SELECT DISTINCT {_KEY} AS alert_key FROM results
        WHERE run_id = {derived.RUNS} AND status = 'IN STOCK'""",
    "restock_transitions": _with(_RESULTS) + """
        SELECT run_id, retailer, product, pincode FROM (
          SELECT *, lag(status) OVER (PARTITION BY retailer, product, pincode
                                      ORDER BY run_id) AS before FROM results)
        WHERE status = 'IN STOCK' AND coalesce(before, '') <> 'IN STOCK'""",
}
