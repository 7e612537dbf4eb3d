"""DuckDB SQL for the registered queries, built from shared views of the given tables."""

from __future__ import annotations

# Records derived from the given tables, in the same way as ``sources.testdata``.
VIEWS = {
    "ev": """
        SELECT *, epoch_us(ts) // 1000 AS ts_ms, user_id % 10 < 3 AS ios FROM events""",
    "startup": """
        SELECT 'mid_' || user_id AS mid, user_id::VARCHAR AS uid, 'app' AS appid,
               'area_' || (user_id % 10) AS area,
               CASE WHEN ios THEN 'ios' ELSE 'andriod' END AS os,
               CASE WHEN ios THEN 'appstore' ELSE 'ch_' || (user_id % 7) END AS ch,
               'startup' AS type, '1.' || (user_id % 3) AS vs,
               strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour, ts_ms AS ts
        FROM ev WHERE event_type = 'signup'""",
    "logev": """
        SELECT (user_id % 10)::VARCHAR AS mid, user_id::VARCHAR AS uid, 'app' AS appid,
               'area_' || (user_id % 10) AS area,
               CASE WHEN ios THEN 'ios' ELSE 'andriod' END AS os,
               NULL::VARCHAR AS ch, 'event' AS type,
               CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
                    ELSE event_type END AS evid,
               (event_id % 50 + 1)::VARCHAR AS pgid, (event_id % 50 + 1)::VARCHAR AS npgid,
               json_extract_string(props, '$.k') AS itemid,
               strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour, ts_ms AS ts
        FROM ev""",
    "ord": """
        SELECT o_orderkey::VARCHAR AS id, c_nationkey::VARCHAR AS province_id,
               c_name AS consignee, NULL::VARCHAR AS order_comment,
               '138' || lpad(o_custkey::VARCHAR, 8, '0') AS consignee_tel,
               o_orderstatus AS order_status, o_orderpriority AS payment_way,
               o_custkey::VARCHAR AS user_id, NULL::VARCHAR AS img_url,
               o_totalprice AS total_amount, NULL::VARCHAR AS expire_time,
               NULL::VARCHAR AS delivery_address,
               strftime(placed, '%Y-%m-%d %H:%M:%S') AS create_time, NULL::VARCHAR AS operate_time,
               NULL::VARCHAR AS tracking_no, NULL::VARCHAR AS parent_order_id,
               NULL::VARCHAR AS out_trade_no, NULL::VARCHAR AS trade_body,
               strftime(placed, '%Y-%m-%d') AS create_date, strftime(placed, '%H') AS create_hour,
               placed AS arrival
        FROM (SELECT *, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS placed FROM orders)
        JOIN customer ON o_custkey = c_custkey""",
    "det": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         round(l_extendedprice * 100)::BIGINT) AS id,
               l_orderkey::VARCHAR AS order_id, p_name AS sku_name, l_partkey::VARCHAR AS sku_id,
               p_retailprice::VARCHAR AS order_price, NULL::VARCHAR AS img_url,
               l_quantity::VARCHAR AS sku_num,
               o_orderdate + to_seconds(o_orderkey * 7919 % 86400)
                 + to_seconds((l_partkey * 7 + l_linenumber * 131) % 1201 - 600) AS arrival
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "usr": """
        SELECT c_custkey::VARCHAR AS id, c_name AS login_name,
               CASE WHEN v = 'old' THEN 'OLD' ELSE c_mktsegment END AS user_level,
               strftime(DATE '1950-01-01' + (c_custkey * 37 % 20000)::INTEGER, '%Y-%m-%d') AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, v
        FROM customer, (VALUES ('old'), ('new')) t(v)
        WHERE c_custkey % 10 <> 0 AND (v = 'new' OR c_custkey % 3 = 0)""",
    "dau": """
        SELECT * EXCLUDE rn FROM (
          SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid) AS rn
          FROM startup) WHERE rn = 1""",
    "sale": """
        SELECT det.id AS order_detail_id, ord.id AS order_id, order_status, create_time, user_id,
               sku_id, order_price::DOUBLE AS sku_price, sku_name, create_date AS dt
        FROM ord JOIN det ON det.order_id = ord.id
         AND det.arrival BETWEEN ord.arrival - INTERVAL 300 SECOND
                             AND ord.arrival + INTERVAL 300 SECOND""",
    "snap": """
        SELECT id, login_name, user_level, birthday, gender FROM usr WHERE v = 'new'""",
    "sale_user": """
        SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id,
               gender AS user_gender,
               coalesce((date_diff('day', birthday::DATE, DATE '2024-01-01') // 365)::INTEGER, 0)
                 AS user_age,
               user_level, sku_price, sku_name, dt, order_id || '-' || order_detail_id AS doc_id
        FROM sale LEFT JOIN snap ON user_id = snap.id""",
    "rawlog": """
        SELECT event_type, ts,
               CASE WHEN event_type = 'signup' THEN json_object(
                   'mid', 'mid_' || user_id, 'uid', user_id::VARCHAR, 'appid', 'app',
                   'area', 'area_' || (user_id % 10),
                   'os', CASE WHEN ios THEN 'ios' ELSE 'andriod' END,
                   'ch', CASE WHEN ios THEN 'appstore' ELSE 'ch_' || (user_id % 7) END,
                   'type', 'startup', 'vs', '1.' || (user_id % 3), 'ts', ts_ms)
               ELSE json_object(
                   'mid', (user_id % 10)::VARCHAR, 'uid', user_id::VARCHAR, 'appid', 'app',
                   'area', 'area_' || (user_id % 10),
                   'os', CASE WHEN ios THEN 'ios' ELSE 'andriod' END,
                   'type', 'event',
                   'evid', CASE event_type WHEN 'purchase' THEN 'coupon'
                                WHEN 'click' THEN 'clickItem' ELSE event_type END,
                   'pgid', event_id % 50 + 1, 'npgid', event_id % 50 + 1,
                   'itemid', json_extract_string(props, '$.k')::INTEGER, 'ts', ts_ms) END AS value
        FROM ev""",
    "damaged": """
        SELECT event_type, CASE WHEN event_type = 'error' THEN left(whole, length(whole) - 1) ELSE whole END AS value
        FROM (SELECT event_type, '{' || CASE WHEN event_type = 'view' THEN ''
                  ELSE '"mid":"' || (user_id % 10) || '",' END || '"uid":"' || user_id
                || '","appid":"app","area":"area_' || (user_id % 10) || '","os":"'
                || CASE WHEN ios THEN 'ios' ELSE 'andriod' END || '","type":"event","evid":"'
                || CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
                   ELSE event_type END
                || '","pgid":' || (event_id % 50 + 1) || ',"npgid":' || (event_id % 50 + 1)
                || ',"itemid":' || json_extract_string(props, '$.k') || ',"ts":' || ts_ms || '}' AS whole
              FROM ev)""",
    "broken": """
        SELECT CASE o_orderkey % 4 WHEN 0 THEN 'oops ' || o_orderkey
                 WHEN 1 THEN '{"entry_type":"ROWDATA","table_name":"' || o_orderkey
                 WHEN 2 THEN '{"table_name":"' || o_orderkey || '"}'
                 ELSE '{"entry_type":"ROWDATA","table_name":"' || o_orderkey || '"}' END AS value,
               CASE o_orderkey % 4 WHEN 2 THEN 'missing key' WHEN 3 THEN 'no rows'
                 ELSE 'malformed' END AS reason
        FROM orders""",
    "repeats": """
        SELECT * EXCLUDE (arrival, later) REPLACE (
                 substr(consignee_tel, 1, 4) || '*******' AS consignee_tel,
                 CASE WHEN id::BIGINT % 3 = 0 THEN 'A again' ELSE order_status END AS order_status,
                 strftime(later, '%Y-%m-%d %H:%M:%S') AS create_time,
                 strftime(later, '%Y-%m-%d') AS create_date)
        FROM (SELECT *, CASE WHEN id::BIGINT % 9 = 0 THEN arrival + INTERVAL 3 DAY ELSE arrival END AS later
              FROM ord)""",
    "sale_repeats": """
        SELECT * EXCLUDE (rn, again, gap) REPLACE (
                 CASE WHEN again THEN 'A again' ELSE order_status END AS order_status)
        FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id, order_detail_id ORDER BY again) AS rn
          FROM (
            SELECT det.id AS order_detail_id, ord.id AS order_id, order_status, create_time, user_id,
                   sku_id, gender AS user_gender,
                   coalesce((date_diff('day', birthday::DATE, DATE '2024-01-01') // 365)::INTEGER, 0)
                     AS user_age,
                   user_level, order_price::DOUBLE AS sku_price, sku_name, create_date AS dt,
                   ord.id || '-' || det.id AS doc_id, again,
                   epoch(det.arrival) - epoch(ord.arrival) - CASE WHEN again THEN 100 ELSE 0 END AS gap
            FROM ord CROSS JOIN (VALUES (false), (true)) v(again)
            JOIN det ON det.order_id = ord.id LEFT JOIN snap ON user_id = snap.id
            WHERE NOT again OR ord.id::BIGINT % 3 = 0)
          WHERE gap BETWEEN -300 AND 300)
        WHERE rn = 1""",
    "startup_zone": """
        SELECT * REPLACE (strftime(ts_at, '%Y-%m-%d') AS log_date, strftime(ts_at, '%H') AS log_hour)
        FROM (SELECT startup.*, make_timestamp(ts * 1000) + INTERVAL 8 HOUR AS ts_at FROM startup)""",
    "alert": """
        SELECT mid, string_agg(DISTINCT uid, ',' ORDER BY uid) FILTER (evid = 'coupon') AS uids,
               string_agg(DISTINCT itemid, ',' ORDER BY itemid) FILTER (evid = 'coupon') AS itemIds,
               string_agg(DISTINCT evid, ',' ORDER BY evid) AS events,
               start_ms + 7200000 AS ts
        FROM (SELECT *, unnest([ts // 1800000 * 1800000 - 1800000 * i FOR i IN range(4)]) AS start_ms
              FROM logev)
        GROUP BY mid, start_ms
        HAVING count(DISTINCT uid) FILTER (evid = 'coupon') >= 3
           AND NOT bool_or(evid = 'clickItem')""",
}

# Which views each view reads.
NEEDS = {
    "startup": ("ev",), "logev": ("ev",), "rawlog": ("ev",),
    "damaged": ("ev",), "repeats": ("ord",), "sale_repeats": ("ord", "det", "usr", "snap"),
    "startup_zone": ("ev", "startup"), "dau": ("ev", "startup"), "sale": ("ord", "det"), "snap": ("usr",),
    "sale_user": ("ord", "det", "sale", "usr", "snap"), "alert": ("ev", "logev"),
}


def _sql(body: str, *views: str) -> str:
    wanted: list[str] = []
    for view in views:
        for name in (*NEEDS.get(view, ()), view):
            if name not in wanted:
                wanted.append(name)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    return f"WITH {ctes}\n{body}"


DAY = "2024-01-15"
BEFORE = "2024-01-14"

_ORDER_FIELDS = "* EXCLUDE (arrival)"
_MASKED = "* EXCLUDE (arrival) REPLACE (substr(consignee_tel, 1, 4) || '*******' AS consignee_tel)"

_HOURS = """
    SELECT string_agg('"' || log_hour || '":' || n, ',' ORDER BY log_hour)
    FROM (SELECT log_hour, count(*) AS n FROM dau WHERE log_date = '{day}' GROUP BY log_hour)"""

_NEW = f"""
    SELECT count(*) FROM (SELECT mid, min(log_date) AS d FROM dau GROUP BY mid) WHERE d = '{DAY}'"""


def all_sql() -> dict[str, str]:
    dau_rows = _sql("SELECT * FROM dau", "dau")
    sales = _sql("SELECT * FROM sale_user", "sale_user")
    found = _sql("SELECT * FROM alert", "alert")
    orders = _sql(f"SELECT {_MASKED} FROM ord", "ord")
    snapshot = _sql("SELECT * FROM snap", "snap")
    routed = _sql(
    """SELECT 'order_info' AS topic,
              json_object('id', id, 'province_id', province_id, 'consignee', consignee,
                'consignee_tel', consignee_tel, 'order_status', order_status,
                'payment_way', payment_way, 'user_id', user_id,
                'total_amount', total_amount::VARCHAR, 'create_time', create_time)::VARCHAR AS value
       FROM ord WHERE id::BIGINT % 11 <> 0 AND id::BIGINT % 5 NOT IN (0, 1)
       UNION ALL
       SELECT 'order_detail', json_object('id', id, 'order_id', order_id,
                'sku_name', sku_name, 'sku_id', sku_id, 'order_price', order_price,
                'sku_num', sku_num)::VARCHAR FROM det
       UNION ALL
       SELECT 'user_info', json_object('id', id, 'login_name', login_name,
                'user_level', user_level, 'birthday', birthday, 'gender', gender)::VARCHAR
       FROM usr""",
    "ord", "det", "usr",
)
    total = _sql(
        f"""SELECT '[{{"id":"dau","name":"新增日活","value":' || count(*)
                || '}},{{"id":"new_mid","name":"新增设备","value":' || ({_NEW}) || '}}]' AS json
            FROM dau WHERE log_date = '{DAY}'""",
        "dau",
    )
    hours = _sql(
        f"""SELECT '{{"yesterday":{{' || coalesce(({_HOURS.format(day=BEFORE)}), '')
                || '}},"today":{{' || coalesce(({_HOURS.format(day=DAY)}), '') || '}}}}' AS json""",
        "dau",
    )
    lone_details = _sql(
        """SELECT id AS order_detail_id, order_id, sku_id, sku_name,
                  order_price::DOUBLE AS sku_price
           FROM det WHERE NOT EXISTS (SELECT 1 FROM ord WHERE ord.id = det.order_id
             AND det.arrival BETWEEN ord.arrival - INTERVAL 300 SECOND
                                 AND ord.arrival + INTERVAL 300 SECOND)""",
        "ord", "det",
    )
    lone_orders = _sql(
        """SELECT id AS order_id, order_status, create_time, create_date AS dt, user_id
           FROM ord WHERE NOT EXISTS (SELECT 1 FROM det WHERE ord.id = det.order_id
             AND det.arrival BETWEEN ord.arrival - INTERVAL 300 SECOND
                                 AND ord.arrival + INTERVAL 300 SECOND)""",
        "ord", "det",
    )
    return {
        "parse_startup": _sql("SELECT * FROM startup", "startup"),
        "parse_event": _sql("SELECT * FROM logev", "logev"),
        "parse_order": _sql(f"SELECT {_ORDER_FIELDS} FROM ord", "ord"),
        "parse_detail": _sql("SELECT * EXCLUDE (arrival) FROM det", "det"),
        "parse_user": _sql("SELECT * EXCLUDE (v) FROM usr", "usr"),
        "record_to_json": _sql(
            """SELECT 'user_info' AS topic, json_object('id', id, 'login_name', login_name,
                      'user_level', user_level, 'birthday', birthday, 'gender', gender)::VARCHAR AS value
               FROM usr""",
            "usr",
        ),
        "bad_rows": _sql(
            """SELECT 'event' AS topic, value,
                      CASE event_type WHEN 'error' THEN 'malformed' ELSE 'missing key' END AS reason
               FROM damaged WHERE event_type IN ('error', 'view')""",
            "damaged",
        ),
        "good_rows": _sql(
            "SELECT * EXCLUDE (log_date, log_hour) FROM logev WHERE evid NOT IN ('error', 'view')", "logev"
        ),
        "mask_phone": _sql(
            "SELECT id, substr(consignee_tel, 1, 4) || '*******' AS consignee_tel FROM ord", "ord"
        ),
        "order_facts": orders,
        "stamp_and_route_logs": _sql(
            """SELECT CASE WHEN event_type = 'signup' THEN 'start' ELSE 'event' END AS topic,
                      value::VARCHAR AS value, strftime(ts, '%Y-%m-%d') AS log_date
               FROM rawlog""",
            "rawlog",
        ),
        "stream_ingest_outputs": _sql(
            """SELECT CASE WHEN event_type = 'signup' THEN 'start' ELSE 'event' END AS output, value::VARCHAR AS value
               FROM rawlog
               UNION ALL SELECT 'archive ' || strftime(ts, '%Y-%m-%d'), value::VARCHAR FROM rawlog
               UNION ALL SELECT 'rejects logs malformed', value FROM damaged WHERE event_type = 'error'""",
            "rawlog", "damaged",
        ),
        "raw_text_intake": _sql(
            """SELECT 'start' AS topic, mid, uid, type, area, true AS stamped FROM startup
               UNION ALL SELECT 'event', mid, uid, type, area, true FROM logev
               WHERE evid <> 'signup'""",
            "startup", "logev",
        ),
        "rejected_logs": _sql(
            "SELECT 'event' AS topic, value FROM damaged WHERE event_type = 'error'", "damaged"
        ),
        "cdc_route": routed,
        "cdc_intake": routed,
        "stream_ingest_changes": routed,
        "bad_changes": _sql("SELECT value, reason FROM broken", "broken"),
        "topic_files": """
            SELECT CASE WHEN event_type = 'signup' THEN 'startup' ELSE 'event' END AS type,
                   CASE WHEN event_type = 'signup' THEN 'mid_' || user_id
                        ELSE (user_id % 10)::VARCHAR END AS mid, epoch_us(ts) // 1000 AS ts
            FROM events""",
        "log_archive": _sql(
            "SELECT strftime(ts, '%Y-%m-%d') AS log_date, value::VARCHAR AS value FROM rawlog", "rawlog"
        ),
        "dau_first_start": dau_rows,
        "dau_from_messages": dau_rows,
        "dau_top_n_starts": _sql(
            """SELECT * EXCLUDE rn FROM (
                 SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid) AS rn
                 FROM startup) WHERE rn <= 3""",
            "startup",
        ),
        "dau_cross_batch": _sql(
            """, late AS (
                 SELECT * EXCLUDE rn FROM (
                   SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid) AS rn
                   FROM startup WHERE ts >= 1705320000000) WHERE rn = 1),
               early AS (
                 SELECT * EXCLUDE rn FROM (
                   SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid) AS rn
                   FROM startup WHERE ts < 1705320000000) WHERE rn = 1)
               SELECT * FROM early
               UNION ALL
               SELECT * FROM late WHERE NOT EXISTS (
                 SELECT 1 FROM early WHERE early.log_date = late.log_date AND early.mid = late.mid)""",
            "startup",
        ),
        "dau_table": dau_rows,
        "dau_total": _sql(f"SELECT count(*) AS total FROM dau WHERE log_date = '{DAY}'", "dau"),
        "dau_hourly": _sql(
            f"SELECT log_hour, count(*) AS ct FROM dau WHERE log_date = '{DAY}' GROUP BY log_hour", "dau"
        ),
        "dau_hourly_all_days": _sql(
            "SELECT log_date, log_hour, count(*) AS ct FROM dau GROUP BY log_date, log_hour", "dau"
        ),
        "dau_hour_map": _sql(
            f"""SELECT coalesce(string_agg(log_hour || ':' || n, ',' ORDER BY log_hour), '') AS hours
                FROM (SELECT log_hour, count(*) AS n FROM dau WHERE log_date = '{DAY}'
                      GROUP BY log_hour)""",
            "dau",
        ),
        "new_devices": _sql(f"SELECT ({_NEW}) AS new_mids", "dau"),
        "realtime_total": total,
        "stored_realtime_total": total,
        "stream_late_rows": _sql(
            """SELECT 'start' AS topic, 'late' AS reason, mid, uid, ts
               FROM (SELECT *, max(ts) OVER (ORDER BY part RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
                     FROM (SELECT *, (SELECT count(*) FROM range(1, 5) t(i) WHERE came >= low + (high - low) * i // 5) AS part
                           FROM (SELECT *, min(came) OVER () AS low, max(came) OVER () AS high
                                 FROM (SELECT *, (ts + CASE WHEN uid::BIGINT % 7 = 0 THEN 518400000 ELSE 0 END) * 1000 AS came
                                       FROM startup))))
               WHERE ts < before - 86400000""",
            "startup",
        ),
        "stream_held_values": _sql(
            """SELECT key, probe, asked, CASE WHEN asked - last <= 259200000 THEN item END AS value
               FROM (SELECT mid AS key, concat_ws('-', uid, pgid) AS probe, ts AS asked,
                            (SELECT max(w.ts) FROM logev w WHERE w.mid = c.mid AND w.evid = 'coupon' AND w.ts < c.ts) AS last,
                            (SELECT max(coalesce(w.itemid, '')) FROM logev w WHERE w.mid = c.mid AND w.evid = 'coupon'
                             AND w.ts = (SELECT max(v.ts) FROM logev v WHERE v.mid = c.mid AND v.evid = 'coupon'
                                         AND v.ts < c.ts)) AS item
                     FROM logev c WHERE evid = 'clickItem')""",
            "logev",
        ),
        "stored_new_devices": _sql(f"SELECT ({_NEW}) AS new_mids", "dau"),
        "stored_first_days": _sql(
            """SELECT first_day, count(*) AS new_mids
               FROM (SELECT mid, min(log_date) AS first_day FROM dau GROUP BY mid) GROUP BY first_day""",
            "dau",
        ),
        "hours_today_yesterday": _sql(
            f"""SELECT coalesce(a.log_hour, b.log_hour) AS log_hour,
                       coalesce(a.n, 0) AS yesterday, coalesce(b.n, 0) AS today
                FROM (SELECT log_hour, count(*) AS n FROM dau WHERE log_date = '{BEFORE}'
                      GROUP BY log_hour) a
                FULL JOIN (SELECT log_hour, count(*) AS n FROM dau WHERE log_date = '{DAY}'
                           GROUP BY log_hour) b ON a.log_hour = b.log_hour""",
            "dau",
        ),
        "realtime_hours": hours,
        "stored_realtime_hours": hours,
        "order_detail_full_outer": _sql(
            """SELECT coalesce(ord.id, order_id) AS order_id, order_status, create_time,
                      create_date AS dt, user_id, det.id AS order_detail_id, sku_id, sku_name,
                      order_price::DOUBLE AS sku_price
               FROM ord FULL JOIN det ON det.order_id = ord.id""",
            "ord", "det",
        ),
        "sale_interval_join": _sql("SELECT * FROM sale", "sale"),
        "unmatched_details": lone_details,
        "stream_unmatched_details": lone_details,
        "unmatched_orders": lone_orders,
        "stream_unmatched_orders": lone_orders,
        "user_snapshot": snapshot,
        "sale_detail": sales,
        "first_sales": _sql("SELECT * FROM sale_user ORDER BY doc_id LIMIT 100", "sale_user"),
        "order_table": orders,
        "sale_table": sales,
        "coupon_alert": found,
        "coupon_alert_messages": found,
        "alert_table": found,
        "stream_ingest_logs": dau_rows,
        "stream_dau": dau_rows,
        "stream_dau_zone": _sql(
            """SELECT * EXCLUDE (rn, ts_at) FROM (
                 SELECT *, row_number() OVER (PARTITION BY log_date, mid ORDER BY ts, uid) AS rn
                 FROM startup_zone) WHERE rn = 1""",
            "startup_zone",
        ),
        "compacted_dau": dau_rows,
        "order_table_repeats": _sql("SELECT * FROM repeats", "repeats"),
        "order_table_day": _sql("SELECT * FROM repeats WHERE create_date = '1995-06-15'", "repeats"),
        "stream_sale_detail_repeats": _sql("SELECT * FROM sale_repeats", "sale_repeats"),
        "stream_order_facts": orders,
        "stream_users": snapshot,
        "stream_sale_detail": sales,
        "stream_coupon_alert": found,
    }
