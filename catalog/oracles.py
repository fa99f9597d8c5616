"""SQL that DuckDB runs on the same tables, one string per query it can express."""

TAPE = """
ev AS (
  SELECT event_id, upper(event_type) AS symbol, CAST(value AS DECIMAL(18,8)) AS price,
         CAST(json_extract_string(props, '$.k') AS DECIMAL(18,8)) AS quantity,
         date_trunc('millisecond', ts) AS trade_time,
         date_trunc('millisecond', ts) + to_milliseconds(20 + (event_id * 37) % 500) AS ingested_at
  FROM events),
history AS (
  SELECT symbol, CAST(row_number() OVER (PARTITION BY symbol ORDER BY event_id) AS BIGINT) AS trade_id,
         price, quantity, trade_time, ingested_at FROM ev),
live AS (SELECT * FROM history WHERE quantity >= 3 AND extract(hour FROM trade_time) <> 3),
dense AS (
  SELECT * FROM live UNION ALL
  SELECT symbol, trade_id, price, quantity, trade_time, ingested_at + INTERVAL 5 SECOND
  FROM live WHERE quantity >= 90),
numbered AS (
  SELECT symbol, event_id AS trade_id, price, quantity, trade_time, ingested_at FROM ev),
trades AS (
  SELECT * FROM numbered UNION ALL
  SELECT symbol, trade_id, price, quantity, trade_time, ingested_at + INTERVAL 5 SECOND
  FROM numbered WHERE quantity >= 90),
configured(symbol) AS (VALUES ('CLICK'), ('ERROR'), ('PURCHASE'), ('SIGNUP'), ('VIEW'), ('GHOST'))
"""

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
RECENT = "trade_time > TIMESTAMP '2024-01-28 00:00:00'"
WHOLE = "trade_time > TIMESTAMP '2023-12-31 00:00:00'"

HALF_HOURS = """
series AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, trade_time) AS time, symbol,
         CAST(sum(price) AS DOUBLE) / count(*) AS price
  FROM trades GROUP BY 1, 2)
"""


def minutes(unit):
    return f"""
buckets AS (
  SELECT date_trunc('{unit}', trade_time) AS time, symbol, CAST(sum(price) AS DOUBLE) / count(*) AS price
  FROM trades GROUP BY 1, 2)
"""


def rolling(n):
    frame = f"OVER (PARTITION BY symbol ORDER BY time ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    return f"round(avg(price) {frame} + 1e-11, 8)"


def lost_of(table, where="TRUE"):
    """Every id between a symbol's first and last that the table lacks."""
    return f"""
lost AS (
  SELECT symbol, unnest(generate_series(low, high)) AS trade_id
  FROM (SELECT symbol, min(trade_id) AS low, max(trade_id) AS high FROM {table} WHERE {where} GROUP BY symbol)
  EXCEPT SELECT symbol, trade_id FROM {table} WHERE {where})
"""


def gaps_of(table, where="TRUE"):
    """Lost ids next to each other make one gap: id minus its rank is the same for all of them."""
    return lost_of(table, where) + """,
gaps AS (
  SELECT symbol, min(trade_id) AS gap_start, max(trade_id) AS gap_end, count(*) AS missing
  FROM (SELECT *, trade_id - rank() OVER (PARTITION BY symbol ORDER BY trade_id) AS run FROM lost)
  GROUP BY symbol, run)
"""


def healed_of(history, gaps="gaps", where="TRUE"):
    return f"""
healed AS (
  SELECT h.* FROM {history} h JOIN {gaps} g
  ON h.symbol = g.symbol AND h.trade_id BETWEEN g.gap_start AND g.gap_end WHERE {where})
"""


def audit_of(where):
    return f"""
per_symbol AS (
  SELECT g.symbol, CAST(sum((SELECT count(*) FROM history h WHERE h.symbol = g.symbol
         AND h.trade_id BETWEEN g.gap_start AND g.gap_end)) AS DOUBLE) AS n
  FROM gaps g WHERE {where} GROUP BY g.symbol),
audit AS (
  SELECT 'backfill' AS check_name, 'ALL' AS symbol,
         CASE WHEN coalesce(sum(n), 0) > 0 THEN 'BACKFILLED' ELSE 'OK' END AS status,
         coalesce(sum(n), 0) AS value FROM per_symbol
  UNION ALL SELECT 'backfill', symbol, 'BACKFILLED', n FROM per_symbol)
"""


def stalls(table, threshold):
    return f"""
SELECT 'symbol_stall' AS check_name, c.symbol,
       CASE WHEN coalesce(age, 999999) > {threshold} THEN 'STALLED' ELSE 'OK' END AS status,
       CAST(coalesce(age, 999999) AS DOUBLE) AS value
FROM configured c LEFT JOIN (
  SELECT symbol, date_diff('second', max(trade_time), {NOW}) AS age FROM {table} GROUP BY symbol) USING (symbol)
"""


def freshness(table):
    return f"""
SELECT 'freshness' AS check_name, 'ALL' AS symbol,
       CASE WHEN coalesce(date_diff('second', max(trade_time), {NOW}), 999999) > 120 THEN 'STALE' ELSE 'OK' END AS status,
       CAST(coalesce(date_diff('second', max(trade_time), {NOW}), 999999) AS DOUBLE) AS value
FROM {table}
"""


def gap_check(where):
    return f"""
SELECT 'trade_gap' AS check_name, c.symbol,
       CASE WHEN count(l.trade_id) > 0 THEN 'GAP_DETECTED' ELSE 'OK' END AS status,
       CAST(count(l.trade_id) AS DOUBLE) AS value
FROM configured c LEFT JOIN ({select_lost(where)}) l USING (symbol) GROUP BY c.symbol
"""


def select_lost(where):
    return f"WITH {lost_of('dense', where)} SELECT * FROM lost"


HEALTH = f"{freshness('dense')} UNION ALL {stalls('dense', 3600)} UNION ALL {gap_check(WHOLE)}"

# Each cycle sees the tape up to its time: its checks, then what healing brought back.
CHECKS = """
cycles AS (
  SELECT unnest(generate_series(date_trunc('day', min(trade_time)) + INTERVAL 1 DAY, date_trunc('day', max(trade_time)) + INTERVAL 1 DAY,
         INTERVAL 1 DAY)) AS cyc FROM ev),
known AS (SELECT cyc, dense.* FROM cycles, dense WHERE trade_time <= cyc),
newest AS (SELECT cyc, symbol, max(trade_time) AS t FROM known GROUP BY 1, 2),
looked AS (SELECT * FROM known WHERE trade_time > cyc - INTERVAL 2 DAY),
absent AS (
  SELECT cyc, symbol, unnest(generate_series(low, high)) AS trade_id
  FROM (SELECT cyc, symbol, min(trade_id) AS low, max(trade_id) AS high FROM looked GROUP BY 1, 2)
  EXCEPT SELECT cyc, symbol, trade_id FROM looked),
counts AS (
  SELECT cyc, c.symbol, count(trade_id) AS missing, count(h) AS back
  FROM cycles CROSS JOIN configured c LEFT JOIN (
    SELECT absent.*, h.symbol AS h FROM absent LEFT JOIN history h USING (symbol, trade_id)) USING (cyc, symbol)
  GROUP BY 1, 2),
aged AS (
  SELECT cyc, c.symbol, coalesce(date_diff('second', t, cyc), 999999) AS age
  FROM cycles CROSS JOIN configured c LEFT JOIN newest USING (cyc, symbol)),
checks AS (
  SELECT 'freshness' AS check_name, 'ALL' AS symbol, CASE WHEN min(age) > 600 THEN 'STALE' ELSE 'OK' END AS status,
         CAST(min(age) AS DOUBLE) AS value, cyc AS checked_at FROM aged GROUP BY cyc
  UNION ALL SELECT 'symbol_stall', symbol, CASE WHEN age > 1800 THEN 'STALLED' ELSE 'OK' END, CAST(age AS DOUBLE), cyc FROM aged
  UNION ALL SELECT 'trade_gap', symbol, CASE WHEN missing > 0 THEN 'GAP_DETECTED' ELSE 'OK' END, CAST(missing AS DOUBLE), cyc FROM counts
  UNION ALL SELECT 'backfill', symbol, 'BACKFILLED', CAST(back AS DOUBLE), cyc FROM counts WHERE missing > 0
  UNION ALL SELECT 'backfill', 'ALL', CASE WHEN sum(back) > 0 THEN 'BACKFILLED' ELSE 'OK' END, CAST(sum(back) AS DOUBLE), cyc
  FROM counts GROUP BY cyc)
"""

# The last row of each check and symbol, as of the alert's half day and as of ever.
ALERTS = f"""
placed AS (
  SELECT *, checked_at > {NOW} - INTERVAL 12 HOUR AS is_now,
         row_number() OVER (PARTITION BY check_name, symbol ORDER BY checked_at DESC) AS nth FROM checks),
vals AS (
  SELECT rule AS uid, CAST(count(p.symbol) AS DOUBLE) AS value
  FROM (VALUES ('health-freshness-stale', 'freshness', 'STALE'), ('health-symbol-stalled', 'symbol_stall', 'STALLED'),
               ('health-trade-gap', 'trade_gap', 'GAP_DETECTED')) AS r(rule, name, bad)
  LEFT JOIN placed p ON p.check_name = r.name AND p.status = r.bad AND p.nth = 1 AND p.is_now
  GROUP BY rule
  UNION ALL
  SELECT 'health-monitor-heartbeat', CAST(date_diff('second', checked_at, {NOW}) AS DOUBLE)
  FROM placed WHERE check_name = 'freshness' AND nth = 1)
"""

DAILY = """
days AS (
  SELECT symbol, CAST(trade_time AS DATE) AS day, max(price * CAST('1.25' AS DECIMAL(4,2))) AS high
  FROM ev GROUP BY 1, 2),
seed AS (SELECT symbol, max(CAST(high AS DOUBLE)) AS peak FROM days GROUP BY symbol)
"""

ORDERS = """
lines AS (SELECT 'ORDERS' AS symbol, l_orderkey AS trade_id FROM lineitem),
fetched AS (
  SELECT 'ORDERS' AS symbol, o_orderkey AS trade_id, CAST(o_totalprice AS DECIMAL(18,8)) AS price,
         CAST(1 AS DECIMAL(18,8)) AS quantity, o_orderdate AS trade_time, o_orderdate AS ingested_at FROM orders)
"""

WINNERS = """
kept AS (
  SELECT symbol, trade_id, price, quantity, trade_time, ingested_at FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, trade_id ORDER BY ingested_at DESC) AS rn FROM trades)
  WHERE rn = 1)
"""

FIXED = """
fixed_buckets AS (
  SELECT date_trunc('{unit}', trade_time) AS time, symbol,
         CAST(sum(CASE WHEN quantity >= 50 THEN price + 1 ELSE price END) AS DOUBLE) / count(*) AS price
  FROM kept GROUP BY 1, 2)
"""

MESSAGES = """
msgs AS (
  SELECT symbol, trade_id, price, quantity, trade_time,
         CASE WHEN quantity = 0 THEN '01' ELSE '00' END AS magic,
         CASE WHEN symbol = 'ERROR' THEN 9 ELSE 7 END AS schema_id,
         '{"symbol":"' || symbol || '","trade_id":' || event_id || ',"price":"' || price || '","quantity":"'
           || quantity || '","trade_time":' || epoch_ms(trade_time) || '}' AS payload
  FROM (SELECT *, event_id AS trade_id FROM ev))
"""

# What becomes of each frame: NULL kind for one that is parsed.
FRAMES = """
framed AS (
  SELECT *, CASE WHEN quantity >= 5 THEN 'good' WHEN symbol = 'VIEW' THEN 'ignored'
                 WHEN symbol = 'ERROR' THEN 'not a JSON object' WHEN symbol = 'PURCHASE' THEN 'missing price'
                 WHEN symbol = 'CLICK' THEN 'bad price' ELSE 'good' END AS kind
  FROM ev)
"""


def sql(body, *ctes):
    return "WITH " + ",".join((TAPE, *ctes)) + body


ORACLES = {
    "symbol_summary": sql(
        "SELECT symbol, count(*) AS rows, max(price) AS max_price FROM trades GROUP BY symbol"),
    "symbols_list": sql("SELECT DISTINCT symbol FROM trades ORDER BY symbol"),
    "price_by_interval": sql("SELECT time, symbol, price FROM series", HALF_HOURS),
    "price_in_range": sql("""
        SELECT date_trunc('hour', trade_time) AS time, symbol, CAST(sum(price) AS DOUBLE) / count(*) AS price
        FROM trades WHERE trade_time BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'
        GROUP BY 1, 2"""),
    "minute_price": sql("SELECT time, symbol, price FROM buckets", minutes("minute")),
    "series_stats": sql("""
        SELECT symbol, arg_max(price, time) AS last, max(price) AS max, min(price) AS min
        FROM series GROUP BY symbol""", HALF_HOURS),
    "moving_average": sql(f"SELECT time, symbol, {rolling(60)} AS moving_avg FROM buckets", minutes("hour")),
    "moving_averages": sql(
        "SELECT time, symbol, price, " + ", ".join(f"{rolling(n)} AS ma_{n}" for n in (15, 60, 240, 720, 1440))
        + " FROM buckets", minutes("minute")),
    "latency_stats": sql("""
        SELECT count(*) AS events, round(quantile_cont(lat, 0.5) + 1e-11, 8) AS p50_ms, round(quantile_cont(lat, 0.95) + 1e-11, 8) AS p95_ms,
               round(quantile_cont(lat, 0.99) + 1e-11, 8) AS p99_ms, max(lat) AS max_ms
        FROM (SELECT epoch_ms(ingested_at) - epoch_ms(trade_time) AS lat FROM trades
              WHERE ingested_at > TIMESTAMP '2023-12-31 00:00:00')"""),
    "latency_display": sql("""
        SELECT count(*) AS events, round_even(quantile_cont(lat, 0.5), 1) AS p50_ms, round_even(quantile_cont(lat, 0.95), 1) AS p95_ms,
               round_even(quantile_cont(lat, 0.99), 1) AS p99_ms, max(lat) AS max_ms
        FROM (SELECT epoch_ms(ingested_at) - epoch_ms(trade_time) AS lat FROM trades
              WHERE ingested_at > TIMESTAMP '2023-12-31 00:00:00')"""),
    "throughput": sql("""
        SELECT count(*) AS rows, round_even(count(*) / (31 * 86400), 0) AS rows_per_sec
        FROM trades WHERE ingested_at > TIMESTAMP '2023-12-31 00:00:00'"""),

    "dedup_latest": sql("SELECT * FROM kept", WINNERS),
    "dedup_order_lines": """
        SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
          FROM lineitem) WHERE rn = 1""",
    "dedup_check": sql("""
        SELECT symbol, count(*) AS raw_rows, count(DISTINCT trade_id) AS unique_trades
        FROM trades GROUP BY symbol"""),
    "final_counts": sql("SELECT symbol, count(*) AS final_rows FROM kept GROUP BY symbol", WINNERS),
    "exact_count": sql("SELECT count(*) AS unique_trades FROM (SELECT DISTINCT symbol, trade_id FROM trades)"),
    "exact_volume": sql("""
        SELECT symbol, count(*) AS trades, sum(quantity) AS volume,
               CAST(sum(CAST(price AS DECIMAL(28,8)) * CAST(quantity AS DECIMAL(10,2))) AS DECIMAL(38,8)) AS turnover
        FROM kept GROUP BY symbol""", WINNERS),
    "merged_rows": sql("""
        SELECT symbol, trade_id, price, quantity, trade_time,
               CASE WHEN quantity >= 50 THEN ingested_at + INTERVAL 1 HOUR ELSE ingested_at END AS ingested_at
        FROM kept""", WINNERS),

    "missing_ids": sql("""
        SELECT s.symbol, CAST(coalesce(m, 0) AS BIGINT) AS missing FROM (SELECT DISTINCT symbol FROM dense) s
        LEFT JOIN (SELECT symbol, sum(missing) AS m FROM gaps GROUP BY symbol) USING (symbol)""", gaps_of("dense")),
    "gap_ranges": sql("SELECT * FROM gaps", gaps_of("dense")),
    "gap_ranges_recent": sql("SELECT * FROM gaps", gaps_of("dense", RECENT)),
    "order_gap_ranges": sql("SELECT * FROM gaps", ORDERS, gaps_of("lines")),
    "plan_heal": sql(
        "SELECT *, CASE WHEN missing > 5 THEN 'SKIPPED' ELSE 'HEAL' END AS action FROM gaps", gaps_of("dense")),
    "page_plan": sql("""
        SELECT symbol, gap_start, gap_end, unnest(generate_series(gap_start, gap_end, 2)) AS from_id FROM gaps""",
        gaps_of("dense")),
    "heal": sql("SELECT * FROM healed", gaps_of("dense"), healed_of("history")),
    "indexed_heal": sql("SELECT * FROM healed", gaps_of("dense"), healed_of("history")),
    "indexed_order_heal": sql("SELECT * EXCLUDE (ingested_at) FROM healed", ORDERS, gaps_of("lines"), healed_of("fetched")),
    "closed_batches": sql("""
        SELECT source, CAST(count(*) AS BIGINT) AS rows, TRUE AS closed_as_bound FROM trades, (VALUES ('fast'), ('slow')) s(source) GROUP BY 1"""),
    "latency_state": sql("""
        SELECT CAST(ingested_at AS DATE) AS day, count(*) AS events, max(epoch_ms(ingested_at) - epoch_ms(trade_time)) AS max_ms,
               TRUE AS p50_ms_holds, TRUE AS p95_ms_holds, TRUE AS p99_ms_holds
        FROM trades WHERE CAST(ingested_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27' GROUP BY 1"""),
    "order_heal": sql("SELECT * FROM healed", ORDERS, gaps_of("lines"), healed_of("fetched")),
    "heal_audit": sql("SELECT * FROM audit", gaps_of("dense"), audit_of("TRUE")),
    "heal_cycle": sql("SELECT * FROM audit", gaps_of("dense", WHOLE), audit_of("TRUE")),
    "healed_tape": sql("""
        SELECT symbol, max(trade_id) - min(trade_id) + 1 - count(DISTINCT trade_id) AS missing
        FROM (SELECT symbol, trade_id FROM dense UNION ALL SELECT symbol, trade_id FROM healed) GROUP BY symbol""",
        gaps_of("dense", WHOLE), healed_of("history")),

    "configured_symbols": sql("""
        SELECT symbol, count(*) AS rows, max(price) AS max_price FROM trades
        WHERE symbol IN ('CLICK', 'VIEW', 'GHOST') GROUP BY 1"""),
    "freshness": sql(freshness("trades")),
    "symbol_stalls": sql(stalls("trades", 3600)),
    "trade_gaps": sql(gap_check(RECENT)),
    "health_cycle": sql(HEALTH),
    "failing_checks": sql(f"SELECT * FROM ({HEALTH}) WHERE status <> 'OK'"),

    "candle_highs": sql("SELECT symbol, CAST(high AS DOUBLE) AS high FROM days", DAILY),
    "peak_seed": sql("SELECT symbol, peak FROM seed", DAILY),
    "peaks_merged": sql("""
        SELECT symbol, max(peak) AS peak FROM (
          SELECT * FROM seed UNION ALL SELECT symbol, CAST(max(price) AS DOUBLE) FROM trades GROUP BY symbol)
        GROUP BY symbol""", DAILY),
    "current_prices": sql(f"""
        SELECT symbol, arg_max(price, trade_time) AS current_price FROM trades WHERE {RECENT} GROUP BY symbol"""),
    "latest_price": sql("""
        SELECT symbol, arg_max(price, trade_time) AS price, arg_max(quantity, trade_time) AS quantity
        FROM trades GROUP BY symbol"""),
    "pct_of_peak": sql(f"""
        SELECT symbol, current_price, peak AS peak_price, CAST(current_price AS DOUBLE) / peak * 100 AS pct_of_peak
        FROM (SELECT symbol, arg_max(price, trade_time) AS current_price FROM trades WHERE {RECENT} GROUP BY symbol)
        JOIN seed USING (symbol)""", DAILY),
    "pct_display": sql(f"""
        SELECT symbol, CAST(round_even(current_price, 2) AS DECIMAL(13,2)) AS current_price, round_even(peak, 2) AS peak_price,
               round_even(CAST(current_price AS DOUBLE) / peak * 100, 2) AS pct_of_peak
        FROM (SELECT symbol, arg_max(price, trade_time) AS current_price FROM trades WHERE {RECENT} GROUP BY symbol)
        JOIN seed USING (symbol)""", DAILY),
    "pct_of_peak_one": sql(f"""
        SELECT CAST(arg_max(price, trade_time) AS DOUBLE)
               / (SELECT CAST(max(price) AS DOUBLE) FROM trades WHERE symbol = 'CLICK') * 100 AS pct_of_peak
        FROM trades WHERE symbol = 'CLICK' AND {RECENT}"""),
    "peak_bands": sql("""
        SELECT time, symbol, price / peak * 100 AS pct,
               CASE WHEN price / peak * 100 >= 100 THEN 'red' WHEN price / peak * 100 >= 95 THEN 'orange'
                    WHEN price / peak * 100 >= 80 THEN 'yellow' ELSE 'green' END AS colour
        FROM series JOIN (SELECT symbol, CAST(max(price) AS DOUBLE) AS peak FROM trades GROUP BY symbol)
        USING (symbol)""", HALF_HOURS),

    "check_log": sql("SELECT * FROM checks", CHECKS),
    "latest_status": sql("""
        SELECT symbol, arg_max(value, checked_at) AS age_s, arg_max(status, checked_at) AS status
        FROM checks WHERE check_name = 'symbol_stall' GROUP BY symbol""", CHECKS),
    "latest_freshness": sql("""
        SELECT value FROM checks WHERE check_name = 'freshness' ORDER BY checked_at DESC LIMIT 1""", CHECKS),
    "alert_values": sql("SELECT * FROM vals", CHECKS, ALERTS),
    "alert_eval": sql("""
        SELECT uid, severity, CAST(threshold AS DOUBLE) AS threshold, value,
               CASE WHEN value > threshold THEN 'FIRING' ELSE 'OK' END AS state
        FROM (VALUES ('health-freshness-stale', 'critical', 0), ('health-monitor-heartbeat', 'critical', 660),
                     ('health-symbol-stalled', 'warning', 0), ('health-trade-gap', 'warning', 0))
             AS rules(uid, severity, threshold) LEFT JOIN vals USING (uid)""", CHECKS, ALERTS),
    "gap_status": sql("""
        SELECT symbol,
               arg_max(value, checked_at) FILTER (check_name = 'trade_gap') AS missing_trades,
               arg_max(status, checked_at) FILTER (check_name = 'trade_gap') AS gap_status,
               arg_max(value, checked_at) FILTER (check_name = 'backfill') AS backfilled,
               arg_max(status, checked_at) FILTER (check_name = 'backfill') AS backfill_status
        FROM checks WHERE check_name IN ('trade_gap', 'backfill') GROUP BY symbol""", CHECKS),
    "check_series": sql("""
        SELECT checked_at AS time, symbol, value FROM checks WHERE check_name = 'trade_gap'
        AND checked_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 12:00:00'""", CHECKS),
    "retained_checks": sql("""
        SELECT * FROM checks WHERE checked_at > TIMESTAMP '2024-02-12 00:00:00' - INTERVAL 30 DAY""", CHECKS),
    "check_bands": sql("""
        SELECT check_name, symbol, checked_at, value, CASE
          WHEN check_name = 'freshness' THEN CASE WHEN value >= 120 THEN 'red' ELSE 'green' END
          WHEN check_name = 'symbol_stall' THEN CASE WHEN value >= 300 THEN 'red' ELSE 'green' END
          WHEN check_name = 'trade_gap' THEN
            CASE WHEN value >= 100 THEN 'red' WHEN value >= 1 THEN 'orange' ELSE 'green' END END AS colour
        FROM checks""", CHECKS),

    "parsed_frames": sql("""
        SELECT symbol, event_id AS trade_id, price, quantity, trade_time FROM framed WHERE kind = 'good'""", FRAMES),
    "quarantine": sql("""
        SELECT kind AS reason, count(*) AS rows FROM framed WHERE kind NOT IN ('good', 'ignored') GROUP BY kind""",
        FRAMES),
    "history_rows": """
        SELECT 'ORDERS' AS symbol, o_orderkey AS trade_id, CAST(o_totalprice AS DECIMAL(18,8)) AS price,
               CASE WHEN o_orderstatus <> 'P' THEN CAST('1.5' AS DECIMAL(18,8)) END AS quantity,
               o_orderdate AS trade_time, CASE WHEN o_orderstatus = 'P' THEN 'bad quantity' END AS reason
        FROM orders""",
    "contract": sql("""
        SELECT symbol, CASE WHEN quantity >= 5 THEN event_id END AS trade_id,
               CASE WHEN quantity < 95 THEN CAST(price AS VARCHAR) END AS price, '0' AS quantity,
               epoch_ms(trade_time) AS trade_time,
               CASE WHEN quantity < 5 THEN 'bad trade_id' WHEN quantity >= 95 THEN 'missing price' END AS reason
        FROM ev"""),
    "envelope": sql("""
        SELECT magic, CAST(schema_id AS BIGINT) AS schema_id, payload,
               CASE WHEN magic <> '00' THEN 'bad magic byte' END AS reason FROM msgs""", MESSAGES),
    "decoded_messages": sql("""
        SELECT CASE WHEN ok THEN symbol END AS symbol, CASE WHEN ok THEN trade_id END AS trade_id,
               CASE WHEN ok THEN price END AS price, CASE WHEN ok THEN quantity END AS quantity,
               CASE WHEN ok THEN trade_time END AS trade_time,
               CASE WHEN magic <> '00' THEN 'bad magic byte' WHEN NOT ok THEN 'unknown schema id' END AS reason
        FROM (SELECT *, magic = '00' AND schema_id = 7 AS ok FROM msgs)""", MESSAGES),
    "topic_rows": sql("SELECT symbol AS key, payload AS value FROM msgs", MESSAGES),

    "stream_write": sql("SELECT * FROM kept", WINNERS),
    "stream_peaks": sql("""
        SELECT symbol, max(peak) AS peak FROM (
          SELECT * FROM seed UNION ALL SELECT symbol, CAST(max(price) AS DOUBLE) FROM trades GROUP BY symbol)
        GROUP BY symbol""", DAILY),
    "stream_batches": sql(
        "SELECT CAST(1 AS BIGINT) AS writers, TRUE AS several_batches, count(*) AS rows FROM trades"),
    "two_streams": sql("SELECT * FROM kept", WINNERS),
    "compacted_then_streamed": sql("SELECT * FROM kept", WINNERS),
    "stored_heals": sql("""
        SELECT symbol, max(trade_id) - min(trade_id) + 1 - count(DISTINCT trade_id) AS missing
        FROM (SELECT symbol, trade_id FROM dense UNION ALL SELECT symbol, trade_id FROM healed) GROUP BY symbol""",
        gaps_of("dense", WHOLE), healed_of("history")),
    "healed_peaks": sql("""
        SELECT symbol, CAST(max(price) AS DOUBLE) AS peak FROM healed GROUP BY symbol""",
        gaps_of("dense", WHOLE), healed_of("history")),
    "reseeded_peaks": sql("SELECT symbol, peak FROM seed", DAILY),
    "stored_range": sql("""
        SELECT * FROM kept
        WHERE trade_time BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'""", WINNERS),
    "stored_default_times": sql("""
        SELECT TRUE AS recent, (SELECT count(*) FROM trades) + 1 + 2 * (SELECT count(*) FROM configured) AS rows"""),
    "stored_health": sql(f"{freshness('dense')} UNION ALL {stalls('dense', 3600)} UNION ALL {gap_check(RECENT)}"),
    "stream_dedup": sql("SELECT symbol, count(*) AS rows FROM kept GROUP BY symbol", WINNERS),
    "stored_scan": sql(f"SELECT * FROM trades WHERE {RECENT}"),
    "stored_checks": sql(f"SELECT *, {NOW} AS checked_at FROM ({HEALTH})"),
    "snapshot_reads": sql("""
        SELECT symbol, count(*) AS rows, step FROM trades JOIN (VALUES ('staged', 1), ('early', 1), ('committed', 2)) AS s(step, parts)
        ON trade_id % 2 < parts GROUP BY symbol, step"""),
    "indexed_range": sql("""
        SELECT * FROM kept
        WHERE trade_time BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'""", WINNERS),
    "merged_while_streaming": sql("SELECT * FROM kept", WINNERS),
    "expired_checks": sql("""
        SELECT * FROM checks WHERE CAST(checked_at AS DATE) >= CAST(TIMESTAMP '2024-02-12 00:00:00' - INTERVAL 30 DAY AS DATE)""", CHECKS),
    "run_state_gaps": sql("SELECT * FROM gaps", gaps_of("dense")),
    "run_state_healed": sql("""
        SELECT symbol, max(trade_id) - min(trade_id) + 1 - count(DISTINCT trade_id) AS missing
        FROM (SELECT symbol, trade_id FROM dense UNION ALL SELECT symbol, trade_id FROM healed) GROUP BY symbol""",
        gaps_of("dense"), healed_of("history")),
    "bucket_state_price": sql("SELECT time, symbol, price FROM fixed_buckets", WINNERS, FIXED.format(unit="minute")),
    "bucket_state_average": sql(
        f"SELECT time, symbol, {rolling(60)} AS moving_avg FROM fixed_buckets", WINNERS, FIXED.format(unit="hour")),
    "live_peaks": sql("""
        SELECT symbol, max(peak) AS peak FROM (
          SELECT * FROM seed UNION ALL SELECT symbol, CAST(max(price) AS DOUBLE) FROM trades GROUP BY symbol)
        GROUP BY symbol""", DAILY),
    "stream_progress": "SELECT CAST(1 AS BIGINT) AS queries, count(*) AS events, TRUE AS several_batches FROM events",
    "versioned_messages": sql("""
        SELECT CASE WHEN ok THEN symbol END AS symbol, CASE WHEN ok THEN event_id END AS trade_id, CASE WHEN ok THEN price END AS price,
               CASE WHEN ok THEN CASE WHEN symbol = 'SIGNUP' THEN 0 ELSE quantity END END AS quantity,
               CASE WHEN ok THEN trade_time END AS trade_time,
               CASE WHEN NOT ok THEN 'schema refused: trade_time is string instead of long' END AS reason
        FROM (SELECT *, symbol <> 'ERROR' AS ok FROM ev)"""),
}
