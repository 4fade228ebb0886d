"""SQL counterparts of the registered queries, over the same tables.

Times are BIGINT epoch milliseconds, cut off rather than rounded (``epoch_ms``
rounds), and sums are whole cents in both.
"""

from __future__ import annotations

_EVENTS = """ev AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ts_ms,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS k, props
  FROM events)"""

HOUR, DAY, MINUTE = 3_600_000, 86_400_000, 60_000


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join([_EVENTS, *ctes]) + "\n"


def _floor(ms: str, size: int) -> str:
    return f"({ms} - {ms} % {size})"


_WORDS = """words AS (
  SELECT doc_id, unnest(CASE WHEN line = '' THEN ['']
                             WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                             ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents))"""

_ARRIVED = """arrived AS (
  SELECT *, event_id + CASE WHEN event_id % 7 = 0 THEN 50 ELSE 0 END AS arrival FROM ev)"""

_FLAGGED = f"""flagged AS (
  SELECT *, coalesce(window_end <= seen, false) AS late FROM (
    SELECT *, {_floor('ts_ms', HOUR)} AS window_start,
           {_floor('ts_ms', HOUR)} + {HOUR} AS window_end,
           max(ts_ms) OVER (ORDER BY arrival, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM arrived))"""


def _running(key: str, out: str) -> str:
    return (
        _with()
        + f"""SELECT event_id, {key},
  CAST(sum(cents) OVER (PARTITION BY {key} ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS {out} FROM ev"""
    )


def _tumble(key: str, out: str = "total") -> str:
    start = _floor("ts_ms", HOUR)
    return (
        _with()
        + f"""SELECT {start} AS window_start, {start} + {HOUR} AS window_end, {key},
  CAST(sum(cents) AS BIGINT) AS {out} FROM ev GROUP BY ALL"""
    )


def _placed(extra: str = "") -> str:
    return f"SELECT event_id, event_type{extra} FROM events"


ORACLES: dict[str, str] = {
    "parse_delimited": _with()
    + "SELECT ts_ms AS ts, event_type AS word, CAST(cents AS INTEGER) AS n FROM ev",
    "map_upper": "SELECT event_id, upper(event_type) AS event_type FROM events",
    "custom_map_operator": "SELECT event_id, upper(event_type) AS event_type FROM events",
    "flatmap_words": f"WITH {_WORDS} SELECT doc_id, word FROM words",
    "word_count": f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word",
    "word_count_filtered": f"WITH {_WORDS} SELECT word, count(*) AS cnt FROM words "
    "WHERE word <> 'the' GROUP BY word",
    "filter_predicates": _with()
    + """SELECT event_id, event_type, k, 'not_error' AS predicate FROM ev WHERE event_type <> 'error'
UNION ALL SELECT event_id, event_type, k, 'not_prefixed' FROM ev WHERE NOT starts_with(event_type, 'err')
UNION ALL SELECT event_id, event_type, k, 'positive' FROM ev WHERE k > 0
UNION ALL SELECT event_id, event_type, k, 'not_positive' FROM ev WHERE k <= 0""",
    "validate_fail_fast": "SELECT event_id, event_type FROM events WHERE event_type <> 'error'",
    "json_skip_bad": _with() + "SELECT event_id, k FROM ev WHERE event_id % 10 <> 0",
    "side_output_routes": """SELECT event_id, value, unnest(['main', CASE
    WHEN event_id % 5 = 0 THEN 'text' WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END]) AS output
FROM (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN event_type
                            ELSE CAST(event_id AS VARCHAR) END AS value FROM events)""",
    "co_map_union": "SELECT c_name AS name FROM customer UNION ALL SELECT upper(s_name) FROM supplier",
    "union_all": """SELECT event_id, event_type FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'click'""",
    "union_filter_fail_fast": """SELECT event_id, event_type AS value FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type FROM events WHERE NOT starts_with(event_type, 'error')""",
    "scalar_functions": _with()
    + f"""SELECT event_id, 2 AS n_fields, upper(event_type) AS upper_type,
  starts_with(event_type, 'c') AS starts_c, event_type = 'view' AS is_view,
  CAST(user_id AS VARCHAR) || ' --> ' || event_type AS glued,
  k AS parsed_int, CAST(k + 0.5 AS DOUBLE) AS parsed_double,
  CAST(cents AS VARCHAR) AS cents_text, CAST(length(event_type) AS INTEGER) AS n_bytes,
  cents + k - 3 AS arithmetic, (k - 50) % 2 AS signed_remainder,
  {_floor('ts_ms', 10_000)} + 10000 AS boundary_ms,
  strftime(make_timestamp(ts_ms * 1000), '%Y%m%d-%H%M') AS minute,
  CASE WHEN k > 50 THEN k ELSE 0 END AS or_zero, least(k, 3) AS at_most_3,
  CASE WHEN event_type = 'view' THEN 2 ELSE 3 END AS set_size, cents + k AS map_total FROM ev""",
    "join_window_inner": _with()
    + f"""SELECT l.event_id AS left_id, l.user_id, l.cents, r.k AS click_k
FROM ev l JOIN ev r ON l.user_id = r.user_id AND l.ts_ms // {DAY} = r.ts_ms // {DAY}
WHERE l.event_type = 'purchase' AND r.event_type = 'click'""",
    "join_window_left_outer": _with("clicks AS (SELECT * FROM ev WHERE event_type = 'click')")
    + f"""SELECT l.event_id AS left_id, l.ts_ms AS left_ms, l.user_id, l.cents,
  r.ts_ms AS right_ms, r.k AS click_k
FROM ev l LEFT JOIN clicks r ON l.user_id = r.user_id AND l.ts_ms // {DAY} = r.ts_ms // {DAY}
WHERE l.event_type = 'purchase'""",
    "join_versioned_lookup": _with(
        """changes AS (
  SELECT event_id, user_id, CASE WHEN event_type = 'view' THEN CAST(k AS VARCHAR) END AS name
  FROM ev WHERE event_type IN ('view', 'signup'))""",
        "facts AS (SELECT * FROM ev WHERE event_type = 'purchase')",
    )
    + """SELECT f.event_id, f.user_id, f.cents, c.name
FROM facts f ASOF LEFT JOIN changes c ON f.user_id = c.user_id AND f.event_id >= c.event_id""",
    "broadcast_lookup": """SELECT c_custkey, n_name, r_name FROM customer
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "running_sum": _running("user_id", "total"),
    "running_reduce": _running("event_type", "reduced").replace("sum(cents)", "bit_or(cents)"),
    "window_reduce_fn": _tumble("event_type", "reduced").replace("sum(cents)", "bit_or(cents)"),
    "window_reduce_carry_fn": _with(
        f"""sums AS (SELECT {_floor('ts_ms', HOUR)} AS window_start, event_type, bit_or(cents) AS reduced
  FROM ev GROUP BY ALL)""",
        """states AS (SELECT *, bit_xor(reduced) OVER (PARTITION BY event_type ORDER BY window_start
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS odd FROM sums)""",
    )
    + "SELECT *, CAST(bit_count(odd) AS BIGINT) AS n_odd FROM states",
    "window_apply_fn": _with()
    + f"""SELECT {_floor('ts_ms', HOUR)} AS window_start, event_type, count(*) AS n,
  arg_max(cents, event_id) - arg_min(cents, event_id) AS change FROM ev GROUP BY ALL""",
    "cogroup_fn": _with(
        f"""d AS (SELECT event_id, user_id, event_type, {_floor('ts_ms', DAY)} AS window_start FROM ev
  WHERE event_type IN ('purchase', 'click'))""",
        """f AS (SELECT *, min(event_id) FILTER (event_type = 'click')
  OVER (PARTITION BY user_id, window_start) AS first FROM d)""",
    )
    + """SELECT window_start, user_id, count(*) FILTER (event_type = 'purchase') AS buys,
  count(*) FILTER (event_type = 'click') AS clicks,
  count(*) FILTER (event_type = 'purchase' AND event_id > first) AS later FROM f GROUP BY ALL""",
    "route_by_rules": _with()
    + """SELECT event_id, cents, 'large' AS tag FROM ev WHERE cents > 5000
UNION ALL SELECT event_id, cents, 'even' FROM ev WHERE cents % 2 = 0
UNION ALL SELECT event_id, cents, 'rest' FROM ev WHERE NOT (cents > 5000 OR cents % 2 = 0)""",
    "flat_map_fn": """SELECT doc_id, word FROM (
  SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE length(word) >= 12""",
    "value_state_total": _running("event_type", "total"),
    "running_sum_concat_key": _with(
        "keyed AS (SELECT *, CAST(user_id AS VARCHAR) || CAST(k AS VARCHAR) AS key FROM ev)"
    )
    + """SELECT event_id, first_value(user_id) OVER w AS user_id, first_value(k) OVER w AS k,
  CAST(sum(cents) OVER w AS BIGINT) AS total FROM keyed
WINDOW w AS (PARTITION BY key ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "ad_pv_uv_running": _with(
        """marked AS (SELECT *, CASE WHEN row_number() OVER (
    PARTITION BY k, event_type, user_id ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS fresh FROM ev)"""
    )
    + """SELECT event_id, k AS ad, event_type, CAST(count(*) OVER w AS BIGINT) AS pv,
  CAST(sum(fresh) OVER w AS BIGINT) AS uv FROM marked
WINDOW w AS (PARTITION BY k, event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "ad_pv_uv_total": _with()
    + "SELECT k AS ad, event_type, count(*) AS pv, count(DISTINCT user_id) AS uv FROM ev GROUP BY ALL",
    "income_province_city": _with()
    + """SELECT event_id, event_type AS province, user_id AS city,
  CAST(sum(cents) OVER (PARTITION BY event_type ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS outer_total,
  CAST(sum(cents) OVER (PARTITION BY event_type, user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS inner_total FROM ev""",
    "table_group_sum": _with()
    + "SELECT user_id AS id, CAST(sum(cents) AS BIGINT) AS cnt FROM ev GROUP BY user_id",
    "sql_group_sum": _with()
    + "SELECT event_type AS id, CAST(sum(cents) AS BIGINT) AS cnt FROM ev GROUP BY event_type",
    "retract_changelog": _with(
        """totals AS (SELECT *, CAST(sum(cents) OVER w AS BIGINT) AS total, row_number() OVER w AS nth
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
    )
    + """SELECT user_id, event_id, true AS is_add, total FROM totals
UNION ALL SELECT user_id, event_id, false, total - cents FROM totals WHERE nth > 1""",
    "upsert_latest": _with()
    + """SELECT user_id, max(event_id) AS event_id, CAST(sum(cents) AS BIGINT) AS total
FROM ev GROUP BY user_id""",
    "tumble_sum": _tumble("event_type"),
    "tumble_sum_by_time": _tumble("ts_ms"),
    "proc_tumble_reduce": _tumble("event_type", "reduced"),
    "window_all_sum": _with()
    + f"""SELECT {_floor('ts_ms', HOUR)} AS window_start, {_floor('ts_ms', HOUR)} + {HOUR} AS window_end,
  CAST(sum(cents) AS BIGINT) AS total FROM ev GROUP BY ALL""",
    "session_sum": _with(
        f"""marked AS (SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER w > {10 * MINUTE} THEN 1 ELSE 0 END AS fresh
  FROM ev WINDOW w AS (PARTITION BY event_type ORDER BY ts_ms, event_id))""",
        """numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY ts_ms, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM marked)""",
    )
    + f"""SELECT event_type, min(ts_ms) AS window_start, max(ts_ms) + {10 * MINUTE} AS window_end,
  CAST(sum(cents) AS BIGINT) AS total FROM numbered GROUP BY event_type, session""",
    "slide_sum": _with(
        f"""copies AS (SELECT *, {_floor('ts_ms', HOUR)} - i * {HOUR} AS window_start
  FROM ev, range(2) r(i))"""
    )
    + f"""SELECT window_start, window_start + {2 * HOUR} AS window_end, event_type,
  CAST(sum(cents) AS BIGINT) AS total FROM copies GROUP BY ALL""",
    "sql_hop_sum": _with(
        f"""copies AS (SELECT *, {_floor('ts_ms', HOUR)} - i * {HOUR} AS window_start
  FROM ev, range(5) r(i))"""
    )
    + """SELECT window_start, event_type AS uid, CAST(sum(cents) AS BIGINT) AS total_money
FROM copies GROUP BY ALL""",
    "sql_tumble_sum": _with()
    + f"""SELECT {_floor('ts_ms', HOUR)} AS window_start, event_type AS uid,
  CAST(sum(cents) AS BIGINT) AS total_money FROM ev GROUP BY ALL""",
    "window_top3": _with(
        f"""ranked AS (SELECT *, {_floor('ts_ms', HOUR)} AS window_start, row_number() OVER (
    PARTITION BY {_floor('ts_ms', HOUR)}, event_type ORDER BY cents DESC, event_id) AS rank FROM ev)"""
    )
    + """SELECT window_start, event_type, event_id, cents, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE rank <= 3""",
    "count_window_sum": _with(
        """nth AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i
  FROM ev)"""
    )
    + """SELECT i // 7 AS window_index, CAST(sum(cents) AS BIGINT) AS total
FROM nth GROUP BY i // 7 HAVING count(*) = 7""",
    "count_window_keyed": _with(
        """nth AS (SELECT user_id, cents,
  (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 5 AS window_index FROM ev)"""
    )
    + """SELECT user_id, window_index, CAST(sum(cents) AS BIGINT) AS total
FROM nth GROUP BY ALL HAVING count(*) = 5""",
    "window_cumulative": _with(
        f"""sums AS (SELECT {_floor('ts_ms', HOUR)} AS window_start, event_type, sum(cents) AS s
  FROM ev GROUP BY ALL)"""
    )
    + f"""SELECT window_start, window_start + {HOUR} AS window_end, event_type,
  CAST(sum(s) OVER (PARTITION BY event_type ORDER BY window_start
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM sums""",
    "late_side_output": _with(_ARRIVED, _FLAGGED)
    + "SELECT event_id, event_type, ts_ms, cents, arrival FROM flagged WHERE late",
    "late_window_sum": _with(_ARRIVED, _FLAGGED)
    + """SELECT window_start, window_end, event_type,
  first(ts_ms ORDER BY arrival, event_id) AS first_ts, CAST(sum(cents) AS BIGINT) AS total
FROM flagged WHERE NOT late GROUP BY window_start, window_end, event_type""",
    "value_state_ttl": _with(
        f"""marked AS (SELECT *, CASE WHEN ts_ms - lag(ts_ms) OVER w >= {6 * HOUR} THEN 1 ELSE 0 END AS fresh
  FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""",
        """runs AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked)""",
    )
    + """SELECT event_id, user_id, CAST(sum(cents) OVER (PARTITION BY user_id, run ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM runs""",
    "list_state_ttl": _with()
    + f"""SELECT a.event_id, a.user_id, b.event_id AS element_seq, b.event_type
FROM ev a JOIN ev b ON a.user_id = b.user_id AND b.event_id <= a.event_id
  AND a.ts_ms - b.ts_ms >= 0 AND a.ts_ms - b.ts_ms < {12 * HOUR}""",
    "minute_bucket_sum": _with()
    + f"""SELECT event_id, user_id, strftime(make_timestamp(ts_ms * 1000), '%Y%m%d-%H%M') AS minute,
  CAST(sum(cents) OVER (PARTITION BY user_id, ts_ms // {MINUTE} ORDER BY event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM ev""",
    "timer_flush_processing": _with()
    + f"""SELECT event_id, user_id, ts_ms, cents, {_floor('ts_ms', HOUR)} + {HOUR} AS flush_ms FROM ev""",
    "timer_flush_event": _with(
        _ARRIVED,
        """seen AS (SELECT *, max(ts_ms) OVER (ORDER BY arrival, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m FROM arrived)""",
    )
    + f"""SELECT event_id, user_id, ts_ms, cents, arrival, {_floor('m', HOUR)} + {HOUR} AS flush_ms
FROM seen""",
    "iterate_feedback": _with()
    + """SELECT event_id, CAST(CASE WHEN k > 0 THEN k - 3 * ceil(k / 3.0) ELSE k - 3 END AS BIGINT) AS v
FROM ev""",
    "partition_by_key": "SELECT event_type, count(*) AS n, 1 AS places FROM events GROUP BY event_type",
    "rebalance": "SELECT count(*) AS n, true AS all_places, true AS even FROM events",
    "shuffle_random": "SELECT count(*) AS n, true AS all_places, true AS even FROM events",
    "partition_custom": _placed(
        """, translate(event_type, 'cv', 'ab') AS word,
  CASE WHEN starts_with(event_type, 'c') THEN 1 WHEN starts_with(event_type, 'v') THEN 2
       ELSE 3 END AS instance"""
    ),
}
