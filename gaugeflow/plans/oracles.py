"""The registered queries as plain SQL over the same tables."""

from gaugeflow.functions.scoring import FALLING, NEGATIVE_DECISION, POSITIVE_DECISION, RISING
from gaugeflow.plans.additive_sql import additive_sql
from gaugeflow.plans.queries import RANGE, SCORE_THRESHOLD

SECOND = "'%Y-%m-%dT%H:%M:%S'"
MINUTE = "'%Y-%m-%dT%H:%M'"
HOUR = "'%Y-%m-%dT%H'"
MICRO = "'%Y-%m-%d %H:%M:%S.%f'"


def _millis(column):
    # Whole microseconds first: a direct conversion would round, not cut.
    return f"epoch_us({column}) // 1000"


def _bucket(column):
    return f"time_bucket(INTERVAL 2 MINUTE, {column}, TIMESTAMP '1970-01-01')"


def _bounds(column):
    start = _bucket(column)
    return (
        f"strftime({start}, {SECOND}) AS window_start, "
        f"strftime({start} + INTERVAL 2 MINUTE, {SECOND}) AS window_end"
    )


def _mean(column):
    # The sum is rounded first, so the order of addition cannot move the mean.
    return f"round(round(sum({column}), 6) / count(*), 6)"


def _pairs(key_format, seconds):
    return f"""
        WITH e AS (SELECT strftime(ts, {key_format}) AS obs_key, ts, event_type, value FROM events),
        j AS (SELECT a.obs_key, a.ts AS t1, a.value AS v1, b.ts AS t2, b.value AS v2
              FROM e a JOIN e b
                ON a.event_type = 'click' AND b.event_type = 'view' AND a.obs_key = b.obs_key
               AND b.ts BETWEEN a.ts - INTERVAL {seconds} SECOND AND a.ts + INTERVAL {seconds} SECOND)
    """


_PAIR_COLUMNS = f"{_millis('t1')} AS t1, v1, {_millis('t2')} AS t2, v2"

_PAIR_WINDOWS = _pairs(HOUR, 300) + f"""
    SELECT {_bounds('t1')}, {_mean('v1')} AS avg_v1, {_mean('v2')} AS avg_v2,
           count(*) AS record_count, max(obs_key) AS avg_timestamp
    FROM j GROUP BY 1, 2
"""

# Which of the eight message shapes an event takes.
_SHAPE = "event_id % 8"

_USER_EVENTS = """
    SELECT event_id, CAST(user_id AS VARCHAR) AS series_key, ts AS ds, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx,
           count(*) OVER (PARTITION BY user_id) AS n
    FROM events
"""


def _by_size(small, medium, large):
    return f"CASE WHEN n < 20 THEN {small} WHEN n < 50 THEN {medium} ELSE {large} END"


_RATIO = _by_size("0.9::DOUBLE", "0.85::DOUBLE", "0.8::DOUBLE")
_TRAIN_SIZE = f"greatest(CAST(floor(n::DOUBLE * ({_RATIO})) AS BIGINT), least(10, n))"
_RELIABILITY = "CASE WHEN n < 20 THEN 'low' WHEN n < 30 THEN 'limited' ELSE 'normal' END"

# Daily means per user, the trend fitted on the leading rows, 30 further days.
_MODEL = f"""
    WITH d AS (SELECT CAST(user_id AS VARCHAR) AS series_key, date_trunc('day', ts)::TIMESTAMP AS ds,
                      avg(value) AS y FROM events GROUP BY 1, 2),
    i AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds) - 1 AS idx,
                 count(*) OVER (PARTITION BY series_key) AS n,
                 epoch_us(ds) / 86400000000.0::DOUBLE AS t FROM d),
    s AS (SELECT *, {_TRAIN_SIZE} AS train_size FROM i),
    m AS (SELECT series_key, coalesce(regr_slope(y, t) FILTER (WHERE idx < train_size), 0) AS slope,
                 avg(t) FILTER (WHERE idx < train_size) AS t_mean,
                 avg(y) FILTER (WHERE idx < train_size) AS y_mean,
                 max(ds) AS last_ds, max(ds) FILTER (WHERE idx < train_size) AS train_end, max(n) AS n
          FROM s GROUP BY 1)
"""


def _ahead(origin):
    return f"""
    , f AS (SELECT series_key, CAST(k AS INTEGER) AS step_no,
                   {origin} + to_days(CAST(k + 1 AS INTEGER)) AS ds,
                   y_mean + slope * (epoch_us({origin}) / 86400000000.0::DOUBLE + k + 1 - t_mean) AS yhat
            FROM m, generate_series(0, 29) AS g(k))
    """


def _whole_forecast(origin, history):
    return _MODEL + _ahead(origin) + f"""
    SELECT s.series_key, strftime(s.ds, {SECOND}) AS ds,
           round(y_mean + slope * (t - t_mean), 6) AS yhat, false AS is_future
    FROM s JOIN m USING (series_key) {history}
    UNION ALL
    SELECT series_key, strftime(ds, {SECOND}), round(yhat, 6), true FROM f
    """


_T = f"{SCORE_THRESHOLD}::DOUBLE"
_SCORE = f"""least(100.0::DOUBLE, greatest(0.0::DOUBLE,
              CASE WHEN p > {_T} THEN 40.0::DOUBLE WHEN p > {_T} * 0.7::DOUBLE THEN 25.0::DOUBLE
                   ELSE p / {_T} * 20 END
            + CASE WHEN q > {_T} * 1.5::DOUBLE THEN 30.0::DOUBLE WHEN q > {_T} THEN 20.0::DOUBLE
                   ELSE q / {_T} * 15 END
            + CASE WHEN r > 0.001::DOUBLE THEN 30.0::DOUBLE WHEN r > 0 THEN 15.0::DOUBLE
                   ELSE 0.0::DOUBLE END))"""

_ANALYSIS = _MODEL + _ahead("last_ds") + f"""
    , a AS (SELECT series_key, avg(yhat) AS p, max(yhat) AS q, regr_slope(yhat, step_no) AS r,
                   string_agg(printf('%.6f', yhat), ',' ORDER BY ds) AS predictions
            FROM f GROUP BY 1),
    z AS (SELECT *, {_SCORE} AS score,
          CASE WHEN r > 0 THEN '{RISING}' ELSE '{FALLING}' END AS trend_label FROM a),
    y AS (SELECT *, CASE WHEN score >= 55 THEN '{POSITIVE_DECISION}'
                         ELSE '{NEGATIVE_DECISION}' END AS decision FROM z)
"""


def _gaps(table, time, key, micros):
    return f"""
    WITH o AS (SELECT {key}, {time} AS t, lag({time}) OVER (PARTITION BY {key} ORDER BY {time}) AS b
               FROM {table})
    SELECT {key}, strftime(b, {MICRO}) AS gap_after, strftime(t, {MICRO}) AS resumed_at,
           (epoch_us(t) - epoch_us(b) + {micros} - 1) // {micros} - 1 AS missing
    FROM o WHERE epoch_us(t) - epoch_us(b) > {micros}
    """


def _described(table, columns):
    return [
        f"SELECT '{table}' AS table_name, '{name}' AS col_name, '{kind}' AS data_type, "
        f"count({name}) AS filled FROM {table}"
        for name, kind in columns.items()
    ]


_CATALOG = {
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
}

_MESSAGE_WINDOWS = _pairs(MINUTE, 5) + f"""
    SELECT {_bounds('t1')}, {_mean('v1')} AS avg_temperature,
           {_mean('v2')} AS avg_precipitation,
           count(*) AS record_count, max(obs_key) AS avg_timestamp
    FROM j GROUP BY 1, 2
"""

_WINDOWS_BY_TYPE = f"""
    SELECT event_type, {_bounds('ts')}, {_mean('value')} AS avg_v1, count(*) AS record_count,
           max(strftime(ts, {MINUTE})) AS avg_timestamp
    FROM events GROUP BY 1, 2, 3
"""

_RANGE_SQL = f"""
    WITH e AS (SELECT event_id, strftime(ts, {MINUTE}) AS avg_timestamp, value FROM events)
    SELECT * FROM e
    WHERE CAST(replace(avg_timestamp, 'T', ' ') AS TIMESTAMP) >= TIMESTAMP '{RANGE[0]}'
      AND CAST(replace(avg_timestamp, 'T', ' ') AS TIMESTAMP) <= TIMESTAMP '{RANGE[1]}'
"""

_ALL_EVENTS = f"SELECT event_id, strftime(ts, {MICRO}) AS ts, user_id, event_type, value, props FROM events"

_INDEX_SQL = f"SELECT event_id, series_key, idx, n FROM ({_USER_EVENTS})"

ORACLES = {
    "metric_split": f"""
        SELECT CASE event_type WHEN 'click' THEN 'temperature' ELSE 'precipitation' END AS metric,
               strftime(ts, {MINUTE}) AS obs_key, {_millis('ts')} AS arrival_ms, value
        FROM events WHERE event_type IN ('click', 'view')""",
    "unpivot_metrics": """
        SELECT l_orderkey, l_linenumber, 'l_quantity' AS metric, l_quantity AS value FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem""",
    "json_extract_props": """
        SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""",
    "json_encode": "SELECT event_id, event_type, value FROM events",
    "nested_response_readings": f"""
        SELECT strftime(ts, {MINUTE}) AS obs_key,
               CASE WHEN event_type <> 'error' THEN value END AS temperature,
               CAST(event_id AS DOUBLE) AS precipitation
        FROM events""",
    "topic_messages": f"""
        WITH e AS (SELECT strftime(ts, {MINUTE}) AS k, CAST(value AS VARCHAR) AS v, event_type FROM events)
        SELECT '{{"time":"' || k || '","temperature_2m":' || v || '}}' AS value, 0 AS partition FROM e
        UNION ALL
        SELECT '{{"time":"' || k || '","precipitation":'
               || CASE WHEN event_type <> 'error' THEN v ELSE 'null' END || '}}', 1 FROM e""",
    "parse_messages_strict": f"""
        SELECT event_id, strftime(ts, {MINUTE}) AS obs_key,
               CASE WHEN {_SHAPE} = 1 THEN {_millis("date_trunc('second', ts)")}
                    ELSE {_millis("date_trunc('minute', ts)")} END AS obs_ms,
               CASE WHEN {_SHAPE} IN (0, 6) THEN value END AS temperature,
               CASE WHEN {_SHAPE} = 1 THEN value END AS precipitation
        FROM events WHERE {_SHAPE} IN (0, 1, 6)""",
    "parse_messages_lenient": f"""
        SELECT event_id, strftime(ts, {MINUTE}) AS obs_key,
               CASE WHEN {_SHAPE} = 1 THEN {_millis("date_trunc('second', ts)")}
                    ELSE {_millis("date_trunc('minute', ts)")} END AS obs_ms,
               CASE WHEN {_SHAPE} IN (0, 6) THEN value WHEN {_SHAPE} = 2 THEN 0.0::DOUBLE END AS temperature,
               CASE WHEN {_SHAPE} = 1 THEN value WHEN {_SHAPE} = 7 THEN 1.0::DOUBLE END AS precipitation
        FROM events WHERE {_SHAPE} IN (0, 1, 2, 6, 7)""",
    "dead_letter_counts": f"""
        SELECT CASE {_SHAPE} WHEN 3 THEN 'no_time' WHEN 4 THEN 'bad_json' WHEN 5 THEN 'bad_time'
                    ELSE 'no_metric' END AS reason, count(*) AS messages
        FROM events WHERE {_SHAPE} IN (2, 3, 4, 5, 7) GROUP BY 1""",
    "timestamp_multi_format": f"""
        SELECT event_id, strftime(ts, {MINUTE}) AS obs_key,
               CASE WHEN event_id % 2 = 0 THEN {_millis("date_trunc('minute', ts)")}
                    ELSE {_millis("date_trunc('second', ts)")} END AS obs_ms
        FROM events""",
    "interval_join_pairs": _pairs(HOUR, 300) + f"SELECT obs_key, {_PAIR_COLUMNS} FROM j",
    "interval_join_narrow": _pairs(MINUTE, 5) + f"SELECT obs_key, {_PAIR_COLUMNS} FROM j",
    "interval_join_by_entity": f"""
        WITH j AS (SELECT a.user_id, a.ts AS t1, a.value AS v1, b.ts AS t2, b.value AS v2
                   FROM events a JOIN events b
                     ON a.event_type = 'click' AND b.event_type = 'view' AND a.user_id = b.user_id
                    AND b.ts BETWEEN a.ts - INTERVAL 6 HOUR AND a.ts + INTERVAL 6 HOUR)
        SELECT user_id, {_PAIR_COLUMNS} FROM j""",
    "tumbling_window_agg": _PAIR_WINDOWS,
    "tumbling_window_of_pairs": _PAIR_WINDOWS,
    "tumbling_window_by_sums": _PAIR_WINDOWS,
    "stream_window_agg": _PAIR_WINDOWS,
    "stream_message_windows": _MESSAGE_WINDOWS,
    "stream_late_repair": _MESSAGE_WINDOWS,
    "stream_one_pass_pairs": _pairs(HOUR, 300) + f"SELECT obs_key, {_PAIR_COLUMNS} FROM j",
    "keyed_store_upserts": _WINDOWS_BY_TYPE,
    "wallclock_closed_windows": f"""
        SELECT event_type, CAST(count(*) AS BIGINT) AS record_count, {_mean('value')} AS avg_value
        FROM events GROUP BY 1""",
    "window_quantiles": """
        SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(value) AS n,
               round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95
        FROM events WHERE value IS NOT NULL GROUP BY 1, 2
        UNION ALL
        SELECT 'all', 'all', count(value), round(quantile_cont(value, 0.5), 6), round(quantile_cont(value, 0.95), 6)
        FROM events WHERE value IS NOT NULL""",
    "tumbling_window_by_key": _WINDOWS_BY_TYPE,
    "window_mean_timestamp": f"""
        SELECT {_bounds('ts')}, {_mean('value')} AS avg_v1, count(*) AS record_count,
               CAST(sum({_millis('ts')}) // count(*) AS BIGINT) AS mean_obs
        FROM events GROUP BY 1, 2""",
    "wallclock_window_agg": f"""
        SELECT event_type, CAST(count(*) AS BIGINT) AS record_count, {_mean('value')} AS avg_value
        FROM events GROUP BY 1""",
    "stream_live_scores": f"""
        WITH i AS (SELECT event_type, value AS y,
                          row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS i
                   FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
        a AS (SELECT event_type, count(*) AS n, avg(y) AS p, max(y) AS q, coalesce(regr_slope(y, -i), 0) AS r
              FROM i WHERE i <= 30 GROUP BY 1),
        z AS (SELECT *, {_SCORE} AS score FROM a)
        SELECT event_type, CAST(n AS INTEGER) AS n, round(p, 6) AS mean, round(q, 6) AS peak, round(r, 6) AS trend,
               round(score, 6) AS score,
               CASE WHEN score >= 55 THEN '{POSITIVE_DECISION}' ELSE '{NEGATIVE_DECISION}' END AS decision
        FROM z""",
    "stream_live_gaps": _gaps("events", "ts", "user_id", 43_200_000_000),
    "gap_detection": _gaps("events", "ts", "user_id", 43_200_000_000),
    "gap_detection_orders": _gaps("orders", "o_orderdate", "o_orderpriority", 86_400_000_000),
    "group_mean_by_dim": f"""
        SELECT o_orderpriority, {_mean("CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)")} AS avg_price,
               count(*) AS record_count
        FROM orders GROUP BY 1""",
    "group_mean_by_segment": f"""
        SELECT c_mktsegment, {_mean("c_acctbal")} AS avg_balance, {_mean("c_nationkey")} AS avg_nation, count(*) AS record_count
        FROM customer GROUP BY 1""",
    "topk_latest": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS ordered, o_totalprice
        FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10""",
    "range_extract": _RANGE_SQL,
    "range_extract_text": _RANGE_SQL,
    "full_extract": _ALL_EVENTS,
    "csv_roundtrip": _ALL_EVENTS,
    "window_store_extract": f"""
        SELECT * FROM ({_WINDOWS_BY_TYPE})
        WHERE CAST(window_start AS TIMESTAMP) >= TIMESTAMP '{RANGE[0]}'
          AND CAST(window_start AS TIMESTAMP) < TIMESTAMP '{RANGE[1]}' + INTERVAL 1 MINUTE""",
    "continuity_summary": f"""
        SELECT count(*) AS total_records, min(strftime(ts, {MINUTE})) AS earliest_record,
               max(strftime(ts, {MINUTE})) AS latest_record
        FROM events""",
    "catalog_describe": " UNION ALL ".join(
        sum((_described(table, columns) for table, columns in _CATALOG.items()), [])
    ),
    "series_clean": f"""
        SELECT event_type AS series_key, event_id, strftime(ts, {SECOND}) AS ds, value AS y, value AS x
        FROM events WHERE event_id % 7 NOT IN (0, 1, 2, 3)""",
    "series_index": _INDEX_SQL,
    "series_index_ranged": _INDEX_SQL,
    "train_split": f"""
        SELECT event_id, idx, n, {_by_size(1, 2, 5)} AS changepoints, n >= 50 AS daily,
               {_TRAIN_SIZE} AS train_size, idx < {_TRAIN_SIZE} AS is_train,
               {_RELIABILITY} AS reliability
        FROM ({_USER_EVENTS})""",
    "fit_config": f"""
        SELECT o_custkey, n, {_by_size(1, 2, 5)} AS changepoints, {_by_size(30, 50, 100)} AS epochs,
               CAST({_by_size('least(8, n)', 16, 32)} AS INTEGER) AS batch_size,
               {_RATIO} AS train_ratio, n >= 50 AS daily, {_TRAIN_SIZE} AS train_size,
               {_RELIABILITY} AS reliability
        FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""",
    "regressor_gate": """
        SELECT CAST(l_partkey AS VARCHAR) AS series_key, round(stddev_samp(l_quantity), 6) AS x_std,
               coalesce(stddev_samp(l_quantity) > 0.01, false) AS use_regressor,
               'quantity' AS regressor
        FROM lineitem GROUP BY 1
        UNION ALL
        SELECT CAST(l_partkey AS VARCHAR), round(stddev_samp(8.5::DOUBLE), 6),
               coalesce(stddev_samp(8.5::DOUBLE) > 0.01, false), 'constant'
        FROM lineitem GROUP BY 1""",
    "last_value_per_series": f"""
        SELECT series_key, strftime(ds, {MICRO}) AS ds, value FROM ({_USER_EVENTS}) WHERE idx = n - 1""",
    "last_n_per_series": """
        SELECT event_type AS series_key, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 30""",
    "every_kth": """
        WITH l AS (SELECT event_type, event_id, ts FROM events
                   QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 30),
        i AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS p FROM l)
        SELECT event_type AS series_key, event_id, CAST((p + 1) * 2 AS INTEGER) AS minutes
        FROM i WHERE p % 5 = 0""",
    "future_frame": f"""
        SELECT event_type, CAST(k AS INTEGER) AS step_no,
               strftime(last_ds + to_minutes(CAST(2 * (k + 1) AS BIGINT)), {MICRO}) AS ds
        FROM (SELECT event_type, max(ts) AS last_ds FROM events GROUP BY 1),
             generate_series(0, 29) AS g(k)""",
    "forecast_linear": _whole_forecast("last_ds", ""),
    "forecast_linear_train_end": _whole_forecast("train_end", "WHERE idx < train_size"),
    "holdout_metrics": _MODEL + """
        SELECT series_key, count(*) AS held_out,
               round(avg(abs(y - (y_mean + slope * (t - t_mean)))), 6) AS mae,
               round(sqrt(avg((y - (y_mean + slope * (t - t_mean))) ** 2)), 6) AS rmse
        FROM s JOIN m USING (series_key) WHERE idx >= train_size GROUP BY 1""",
    "backtest_linear": """
        WITH d AS (SELECT event_type AS series_key, date_trunc('hour', ts)::TIMESTAMP AS ds, avg(value) AS y FROM events GROUP BY 1, 2),
        t AS (SELECT *, epoch_us(ds) / 3600000000.0::DOUBLE AS t,
                     row_number() OVER (PARTITION BY series_key ORDER BY ds) AS i FROM d),
        o AS (SELECT series_key, i AS trained FROM t WHERE i >= 24 AND (i - 24) % 12 = 0),
        m AS (SELECT series_key, trained, coalesce(regr_slope(y, t), 0) AS slope, avg(t) AS t_mean, avg(y) AS y_mean
              FROM o JOIN t USING (series_key) WHERE i <= trained GROUP BY 1, 2)
        SELECT series_key, trained, count(*) AS held_out,
               round(avg(abs(y - (y_mean + slope * (t - t_mean)))), 6) AS mae,
               round(sqrt(avg((y - (y_mean + slope * (t - t_mean))) ** 2)), 6) AS rmse
        FROM m JOIN t USING (series_key) WHERE i > trained AND i <= trained + 24 GROUP BY 1, 2""",
    "trend_slope": """
        WITH d AS (SELECT CAST(user_id AS VARCHAR) AS series_key, date_trunc('day', ts)::TIMESTAMP AS ds,
                          avg(value) AS y FROM events GROUP BY 1, 2),
        m AS (SELECT series_key, count(*) AS n,
                     coalesce(regr_slope(y, epoch_us(ds) / 86400000000.0::DOUBLE), 0) AS slope
              FROM d GROUP BY 1)
        SELECT series_key, n, round(slope, 6) AS slope,
               CASE WHEN slope > 0 THEN 'Rising' ELSE 'Falling' END AS trend_label
        FROM m""",
    "predictions_array": _ANALYSIS + "SELECT series_key, predictions FROM y",
    "exceedance_score": _ANALYSIS + """
        SELECT series_key, round(p, 6) AS avg_predicted, round(q, 6) AS max_predicted,
               round(r, 6) AS trend, round(score, 6) AS score FROM y""",
    "forecast_from_csv": _ANALYSIS + "SELECT series_key, round(score, 6) AS score, decision FROM y",
    "prepare_series": f"""
        WITH o AS (SELECT o_orderpriority AS series_key, strftime(o_orderdate, {SECOND}) AS ds, o_totalprice AS y,
                          CASE WHEN o_orderpriority LIKE '1%' THEN 8.5::DOUBLE ELSE CAST(o_custkey AS DOUBLE) END AS x
                   FROM orders),
        g AS (SELECT series_key, coalesce(stddev_samp(x) > 0.01, false) AS use_regressor FROM o GROUP BY 1)
        SELECT series_key, ds, y, CASE WHEN use_regressor THEN x END AS x, use_regressor
        FROM o JOIN g USING (series_key)""",
    "decision": _ANALYSIS + "SELECT series_key, decision, trend_label FROM y",
    "forecast_report": _ANALYSIS + f"""
        SELECT series_key, n, {_RELIABILITY} AS reliability, printf('%.1f%%', score) AS probability,
               printf('%.4f', p) AS avg_predicted, printf('%.4f', q) AS max_predicted,
               printf('%s (%.6f)', trend_label, r) AS trend, decision
        FROM y JOIN m USING (series_key)""",
    "report_breakdown": _MODEL + _ahead("last_ds") + """
        SELECT series_key, CAST((step_no + 1) * 2 AS INTEGER) AS minutes, round(yhat, 6) AS yhat
        FROM f WHERE step_no % 5 = 0""",
}


def _series(key, unit):
    return f"""
        SELECT CAST({key} AS VARCHAR) AS series_key, date_trunc('{unit}', ts)::TIMESTAMP AS ds, avg(value) AS y,
               avg(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS x
        FROM events GROUP BY 1, 2"""


def _null_windows(way):
    return f"""
        SELECT {_bounds("t1")}, '{way}' AS way,
               round(round(sum(v1), 6) / count(v1), 6) AS avg_v1, round(round(sum(v2), 6) / count(v2), 6) AS avg_v2,
               count(*) AS record_count, max(obs_key) AS avg_timestamp
        FROM j GROUP BY ALL"""


_HOURS = additive_sql(_series("event_type", "hour"), 3_600_000_000)
_INDEXED = """
    SELECT event_id, series_key, row_number() OVER (PARTITION BY series_key ORDER BY ts, event_id) - 1 AS idx,
           count(*) OVER (PARTITION BY series_key) AS n
    FROM (SELECT event_id, ts, CASE WHEN event_id % 3 <> 0 THEN event_type END AS series_key FROM events)"""

ORACLES |= {
    "forecast_additive": additive_sql(_series("user_id", "day"), 86_400_000_000),
    "forecast_additive_hours": _HOURS,
    "forecast_from_csv_additive": f"""
        WITH h AS ({_HOURS}), c AS (SELECT event_type AS series_key, count(DISTINCT date_trunc('hour', ts)) AS n
                                    FROM events GROUP BY 1)
        SELECT series_key, ds, yhat, is_future, n, {_RELIABILITY} AS reliability
        FROM h JOIN c USING (series_key) WHERE is_future""",
    "tumbling_window_nulls": """
        WITH e AS (SELECT CASE WHEN event_id % 5 <> 0 THEN strftime(ts, """ + HOUR + """) END AS obs_key, ts, event_type,
                          CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events),
        j AS (SELECT a.obs_key, a.ts AS t1, a.value AS v1, b.value AS v2 FROM e a JOIN e b
              ON a.event_type = 'click' AND b.event_type = 'view' AND a.obs_key = b.obs_key
             AND b.ts BETWEEN a.ts - INTERVAL 300 SECOND AND a.ts + INTERVAL 300 SECOND)
        """ + " UNION ALL ".join(_null_windows(way) for way in ("pairs", "sums", "slices")),
    "series_index_nulls": f"SELECT i.*, c.crowded FROM ({_INDEXED}) AS i, (VALUES (true), (false)) AS c(crowded)",
    "wallclock_join_windows": _pairs(HOUR, 300) + f"""
        , w AS (SELECT *, greatest(t1, t2) AS formed FROM j)
        SELECT {_bounds("formed")}, {_mean("v1")} AS avg_v1, {_mean("v2")} AS avg_v2,
               count(*) AS record_count, max(obs_key) AS avg_timestamp
        FROM w GROUP BY ALL""",
    "store_of_two_runs": """
        SELECT event_id, event_type, value, strftime(ts, '%Y-%m-%d') AS window_date FROM events
        WHERE event_type IN ('click', 'view', 'error', 'purchase', 'signup')""",
    "csv_mixed_files": """
        SELECT event_id, ' say "é", ' || event_type || chr(10) || 'next "' || event_id AS note, value FROM events""",
    "dead_letters_raw": f"""
        SELECT CASE {_SHAPE} WHEN 3 THEN 'no_time' WHEN 4 THEN 'bad_json' WHEN 5 THEN 'bad_time'
                    ELSE 'no_metric' END AS reason,
               CASE {_SHAPE} WHEN 2 THEN '{{"time":"' || strftime(ts, {MINUTE}) || '","temperature_2m":null}}'
                    WHEN 3 THEN '{{"temperature_2m":' || CAST(value AS VARCHAR) || '}}'
                    WHEN 4 THEN '{{"time":"' || strftime(ts, {MINUTE}) || '","temperature_2m":'
                    WHEN 5 THEN '{{"time":"' || strftime(ts, {SECOND}) || '.5","precipitation":' || CAST(value AS VARCHAR) || '}}'
                    ELSE '{{"time":"' || strftime(ts, {MINUTE}) || '","precipitation":true}}' END AS raw
        FROM events WHERE {_SHAPE} IN (2, 3, 4, 5, 7)""",
    "catalog_tables": """
        SELECT 'nation' AS table_name, count(*) AS rows FROM nation UNION ALL
        SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier""",
    "fan_out_sinks": """
        SELECT event_id, value, 'store' AS sink FROM events UNION ALL SELECT event_id, value, 'plain' FROM events""",
}
