"""The registered queries in SQL, written independently of the operators."""

from __future__ import annotations

_AVG = """
SELECT c_custkey, c_name, c_mktsegment, CAST(s AS DOUBLE) / n / 100 AS avg_price FROM (
  SELECT c_custkey, c_name, c_mktsegment, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS s, count(*) AS n
  FROM customer JOIN orders ON c_custkey = o_custkey
  WHERE c_acctbal {op} 1000 AND o_orderdate {op} TIMESTAMP '1995-01-01'
  GROUP BY c_custkey, c_name, c_mktsegment)
"""

_EDGES = """
SELECT DISTINCT CASE WHEN l_returnflag = 'N' THEN 2 * l_partkey ELSE 2 * l_orderkey + 1 END AS src,
       CASE WHEN l_returnflag = 'N' THEN 2 * l_orderkey + 1 ELSE 2 * l_partkey END AS dst
FROM lineitem
"""

_VERTICES = "SELECT src AS id FROM edges UNION SELECT dst FROM edges"

# every (vertex, hops) pair up to the bound; the least per vertex is the distance
_COSTS = f"""
WITH RECURSIVE edges AS ({_EDGES}), vertices AS ({_VERTICES}),
walk AS (
  SELECT CAST(0 AS BIGINT) AS id, 0 AS hops
  UNION
  SELECT e.dst, w.hops + 1 FROM walk w JOIN edges e ON e.src = w.id WHERE w.hops < 30),
cost AS (
  SELECT id, min(hops) AS hops FROM walk WHERE id IN (SELECT id FROM vertices) GROUP BY id)
"""

_PATHS = f"""{_COSTS},
parents AS (
  SELECT c.id, c.hops, min(p.id) AS parent
  FROM cost c JOIN edges e ON e.dst = c.id JOIN cost p ON p.id = e.src AND p.hops = c.hops - 1
  GROUP BY c.id, c.hops),
trail AS (
  SELECT id, hops, CAST(id AS VARCHAR) AS path FROM cost WHERE hops = 0
  UNION ALL
  SELECT p.id, p.hops, t.path || ', ' || p.id FROM trail t JOIN parents p ON p.parent = t.id AND p.hops = t.hops + 1)
"""

_POSITIONS = """
SELECT ts, event_id AS seq, event_type AS entity, value AS x,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y
FROM events
"""

_DAY = "time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01')"

_EXITS = """
WITH positions AS ({positions}),
flags AS (
  SELECT {day} AS window_start, ts, seq, entity,
         x > 50 AND x < 250 AND y > 50 AND y < 95 AS a, x > 50 AND x < 250 AND y > 5 AND y < 45 AS b
  FROM positions WHERE entity IN ('click', 'purchase', 'signup', 'view')),
steps AS (
  SELECT window_start, a, b, lag(a) OVER w AS a0, lag(b) OVER w AS b0
  FROM flags WINDOW w AS (PARTITION BY window_start{entity} ORDER BY ts, seq)),
counts AS (
  SELECT window_start, count(*) FILTER (WHERE a0 AND NOT a) AS a, count(*) FILTER (WHERE b0 AND NOT b) AS b
  FROM steps GROUP BY window_start),
exits AS (
  SELECT window_start, window_start + INTERVAL '1 day' AS window_end, 'A' AS zone, a AS exits FROM counts
  UNION ALL SELECT window_start, window_start + INTERVAL '1 day', 'B', b FROM counts)
"""
_EXITS_INTERLEAVED = _EXITS.format(positions=_POSITIONS, day=_DAY, entity="")
_EXITS_PER_ENTITY = _EXITS.format(positions=_POSITIONS, day=_DAY, entity=", entity")

_TOTAL = f"""{_EXITS_PER_ENTITY}
SELECT start AS window_start, start + INTERVAL '10 days' AS window_end, zone, sum(exits)::BIGINT AS exits
FROM (SELECT time_bucket(INTERVAL '10 days', window_end - INTERVAL '1 microsecond', TIMESTAMP '1970-01-01') AS start,
             zone, exits FROM exits)
GROUP BY start, zone
"""

_WINDOWS = f"""
WITH positions AS ({_POSITIONS}),
placed AS (
  SELECT ts, seq, x, y, {_DAY} - k * INTERVAL '1 day' AS window_start
  FROM positions, range(5) AS r(k) WHERE entity = 'error'),
steps AS (
  SELECT window_start,
         coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0) AS step
  FROM placed WINDOW w AS (PARTITION BY window_start ORDER BY ts, seq)),
windows AS (
  SELECT window_start, window_start + INTERVAL '5 days' AS window_end, sum(step) / count(*) AS avg_step
  FROM steps GROUP BY window_start),
best AS (
  SELECT window_start, window_end,
         max(avg_step) OVER (ORDER BY window_end) AS best_avg,
         arg_max(window_start, avg_step) OVER (ORDER BY window_end) AS best_start
  FROM windows)
"""

# positions as they come back from text: x in whole hundredths, ties in the order of the ids
_FILED = """
SELECT ts, CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id AS seq, event_type AS entity, round(value * 100) / 100 AS x,
       CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS y
FROM events
"""

# one in ten rows comes 15 days late and one in 97 is damaged; late rows count if their day was still open when nothing newer came
_SURVIVORS = f"""
WITH positions AS ({_FILED}),
readable AS (
  SELECT p.*, e.event_id % 10 = 3 AS lagged FROM positions p JOIN events e ON p.seq = CAST(epoch_us(e.ts) AS HUGEINT) * 1000000 + e.event_id
  WHERE entity IN ('click', 'purchase', 'signup', 'view') AND e.event_id % 97 <> 5),
last AS (SELECT time_bucket(INTERVAL '1 day', max(ts) - INTERVAL '2 days', TIMESTAMP '1970-01-01') AS closed_to FROM readable WHERE NOT lagged)
SELECT ts, seq, entity, x, y FROM readable, last WHERE NOT lagged OR ts >= closed_to
"""

_AVG_STEP = f"{_WINDOWS} SELECT window_start, window_end, round(avg_step, 6) AS avg_step FROM windows"
_BEST = (
    f"{_WINDOWS} SELECT window_start, window_end, best_start, best_start + INTERVAL '5 days' AS best_end, "
    "round(best_avg, 6) AS best_avg FROM best"
)


def oracle_sql() -> dict[str, str]:
    return {
        "q01_balance_filter": "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_acctbal > 1000",
        "q02_orders_since": (
            "SELECT o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1995-01-01'"
        ),
        "q03_orders_since_inclusive": (
            "SELECT o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01'"
        ),
        "q04_customer_orders": (
            "SELECT c_custkey, c_name, c_mktsegment, o_totalprice, o_orderdate "
            "FROM orders JOIN customer ON o_custkey = c_custkey "
            "WHERE c_acctbal > 1000 AND o_orderdate > TIMESTAMP '1995-01-01'"
        ),
        "q05_avg_order_value": _AVG.format(op=">"),
        "q06_avg_order_value_inclusive": _AVG.format(op=">="),
        "q07_avg_order_value_tagged": _AVG.format(op=">="),
        "q08_order_sum_count": (
            "SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents, "
            "count(*) AS orders FROM orders GROUP BY o_custkey"
        ),
        "q09_customers_without_orders": (
            "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS "
            "(SELECT 1 FROM events WHERE user_id = c_custkey)"
        ),
        "q10_order_existence": (
            "SELECT c_custkey, EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey) "
            "AS has_order FROM customer"
        ),
        "q11_graph_vertices": f"WITH edges AS ({_EDGES}) {_VERTICES}",
        "q12_graph_edges": _EDGES,
        "q13_frontier_messages": (
            f"WITH edges AS ({_EDGES}) SELECT b.dst, 2 AS hops, min(b.src) AS parent "
            "FROM edges a JOIN edges b ON b.src = a.dst WHERE a.src = 0 AND a.dst <> 0 GROUP BY b.dst"
        ),
        "q14_merge_state": f"""{_PATHS}
            SELECT v.id, CASE WHEN c.hops <= 2 THEN c.hops END AS hops, CASE WHEN c.hops <= 2 THEN p.parent END AS parent
            FROM vertices v LEFT JOIN cost c ON c.id = v.id LEFT JOIN parents p ON p.id = v.id""",
        "q15_sssp_costs": f"{_COSTS} SELECT v.id, c.hops FROM vertices v LEFT JOIN cost c ON c.id = v.id",
        "q16_sssp_paths": f"""{_PATHS}
            SELECT t.id, t.hops, p.parent, t.path FROM trail t LEFT JOIN parents p ON p.id = t.id""",
        "q17_sssp_report": f"""{_PATHS}
            SELECT CAST(0 AS BIGINT) AS source, v.id AS dest, coalesce(t.path, '') AS path,
                   coalesce(CAST(t.hops AS VARCHAR), 'Inf') AS cost
            FROM vertices v LEFT JOIN trail t ON t.id = v.id""",
        "q18_sssp_levels": f"""{_COSTS}
            SELECT c.hops, count(*) AS vertices FROM vertices v LEFT JOIN cost c ON c.id = v.id GROUP BY c.hops""",
        "q19_entity_in_list": (
            f"SELECT * FROM ({_POSITIONS}) WHERE entity IN ('click', 'purchase', 'signup', 'view')"
        ),
        "q20_zone_flags": f"""
            SELECT seq, x > 50 AND x < 250 AND y > 50 AND y < 95 AS "in_A",
                   x > 50 AND x < 250 AND y > 5 AND y < 45 AS "in_B" FROM ({_POSITIONS})""",
        "q21_zone_exits_interleaved": f"{_EXITS_INTERLEAVED} SELECT * FROM exits",
        "q22_zone_exits_per_entity": f"{_EXITS_PER_ENTITY} SELECT * FROM exits",
        "q23_zone_exits_total": _TOTAL,
        "q24_step_distances": f"""
            SELECT seq, ts, round(coalesce(sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2), 0), 6) AS step
            FROM ({_POSITIONS}) WHERE entity = 'error' WINDOW w AS (ORDER BY ts, seq)""",
        "q25_avg_step_sliding": _AVG_STEP,
        "q26_running_best": _BEST,
        "q27_best_window": f"""{_WINDOWS}
            SELECT window_start, window_end, round(avg_step, 6) AS avg_step FROM windows
            ORDER BY windows.avg_step DESC, window_start LIMIT 1""",
        "q28_best_since": f"{_BEST} WHERE window_end >= TIMESTAMP '2024-01-15'",
        "q29_stream_zone_exits": _TOTAL,
        "q30_stream_avg_step": _AVG_STEP,
        "q31_pico_event_time": """
            SELECT event_id, make_timestamp(
                     CAST((CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) // 1000000000 AS BIGINT) * 1000) AS event_time
            FROM events""",
        "q32_pipe_table_roundtrip": """
            SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS orderstatus, o_totalprice AS price,
                   CAST(o_orderdate AS DATE) AS orderdate, o_orderpriority AS orderpriority FROM orders""",
        "q33_edge_list_roundtrip": _EDGES,
        "q34_positions_roundtrip": """
            SELECT user_id AS sensor_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts,
                   CAST(round(value * 100) AS INTEGER) AS x,
                   CAST(json_extract_string(props, '$.k') AS INTEGER) AS y, CAST(0 AS INTEGER) AS z FROM events""",
        "q35_tagged_files": _AVG.format(op=">="),
        "q36_paths_report_file": f"""{_PATHS}
            SELECT CAST(0 AS BIGINT) AS source, v.id AS dest, coalesce(t.path, '') AS path,
                   coalesce(CAST(t.hops AS VARCHAR), 'Inf') AS cost
            FROM vertices v LEFT JOIN trail t ON t.id = v.id""",
        "q37_file_stream_exits_csv": _TOTAL.replace(_POSITIONS, _FILED),
        "q39_live_running_best": f"{_BEST.replace(_POSITIONS, _FILED)} WHERE window_end >= TIMESTAMP '2024-01-15'",
        "q40_late_rows": f"{_EXITS.format(positions=_SURVIVORS, day=_DAY, entity=', entity')} SELECT * FROM exits",
        "q41_stream_account": f"""
            WITH kept AS ({_SURVIVORS}), damaged AS (SELECT count(*) AS n FROM events WHERE event_id % 97 = 5),
            given AS (
              SELECT count(*) AS n FROM events
              WHERE event_type IN ('click', 'purchase', 'signup', 'view') AND event_id % 97 <> 5)
            SELECT given.n + damaged.n AS given, (SELECT count(*) FROM kept) AS kept, given.n - (SELECT count(*) FROM kept) AS late,
                   damaged.n AS bad FROM given, damaged""",
        "q44_zone_table_exits": f"""
            WITH positions AS ({_POSITIONS}),
            zones AS (
              SELECT DISTINCT i || '/' || j AS zone, i * 10 - 3 AS x_low, i * 10 + 13 AS x_high, j * 5 - 2 AS y_low, j * 5 + 7 AS y_high
              FROM (SELECT CAST(floor(x / 10) AS BIGINT) AS i, CAST(floor(y / 5) AS BIGINT) AS j FROM positions)),
            steps AS (
              SELECT {_DAY} AS window_start, x, y, lag(x) OVER w AS x0, lag(y) OVER w AS y0
              FROM positions WHERE entity IN ('click', 'purchase', 'signup', 'view')
              WINDOW w AS (PARTITION BY {_DAY}, entity ORDER BY ts, seq))
            SELECT window_start, window_start + INTERVAL '1 day' AS window_end, zone, count(*) AS exits
            FROM steps JOIN zones ON x0 > x_low AND x0 < x_high AND y0 > y_low AND y0 < y_high
            WHERE NOT (x > x_low AND x < x_high AND y > y_low AND y < y_high) GROUP BY window_start, zone""",
        "q45_text_order_rank": """
            SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY CAST(o_custkey AS VARCHAR), o_orderkey) AS rank
            FROM orders""",
        "q42_closed_zone_exits": _TOTAL.replace(_POSITIONS, _FILED),
        "q43_closed_avg_step": _AVG_STEP.replace(_POSITIONS, _FILED),
        "q38_live_best_window": f"""{_WINDOWS.replace(_POSITIONS, _FILED)}
            SELECT window_start, window_end, round(avg_step, 6) AS avg_step FROM windows
            ORDER BY windows.avg_step DESC, window_start LIMIT 1""",
    }
