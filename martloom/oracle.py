"""The registered queries in SQL, for DuckDB over the same parquet tables.

Written from the definitions of the marts, not from the Spark plans: plain
windows, joins and distinct counts stand where Spark uses another route.
"""

from __future__ import annotations

from martloom.catalog import FRIEND_TIMES, PAGE_ROWS, PROMO_NOW, STATUS_SINCE, FIRST_LOAD, SECOND_LOAD, TOP_DISHES
from martloom.standins import EVENT_TYPES, WIDE_DIMS, WIDE_MEASURES

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
EVENTS = f"ev AS (SELECT event_id, ts, user_id, event_type, {K} AS k FROM events)"
ORDERS = """o AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date FROM orders)"""


def _key(cols: list[str]) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in cols)
    return f"sha256(concat_ws(chr(31), {parts}))"


def _profile() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
        f"count(DISTINCT {c}) AS distinct_values, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM orders" for c in cols
    )


_MEASURES = f"""{ORDERS},
m AS (SELECT u.c_custkey AS user_id, max(o.order_date) AS last_order, count(o.order_id) AS orders,
    coalesce(sum(o.amount), 0) AS spend
  FROM customer u LEFT JOIN o ON o.user_id = u.c_custkey AND o.status = 'F' GROUP BY 1),
s AS (SELECT *, ntile(5) OVER (ORDER BY last_order ASC NULLS FIRST, user_id) AS recency,
    ntile(5) OVER (ORDER BY orders, user_id) AS frequency,
    ntile(5) OVER (ORDER BY spend, user_id) AS monetary FROM m),
seg AS (SELECT *, concat(recency, frequency, monetary) AS segment FROM s)"""

_WIDE = """w AS (SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
    CAST(l_linenumber AS BIGINT) AS line_no, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price, c_custkey AS customer_id, c_name AS customer_name,
    c_mktsegment AS customer_segment, n_name AS customer_country, p_partkey AS dish_id, p_name AS dish_name,
    p_type AS dish_category, s_suppkey AS vendor_id, s_name AS vendor_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey)"""


def _split_dims() -> str:
    return f"WITH {_WIDE} " + " UNION ALL ".join(
        f"SELECT DISTINCT '{d}' AS dim, {_key(c)} AS dim_key, {c[0]} AS natural_id, {c[1]} AS name FROM w"
        for d, c in WIDE_DIMS.items()
    )


def _split_lossless() -> str:
    dims = ", ".join(
        f"d_{d} AS (SELECT DISTINCT {_key(c)} AS sk, {', '.join(c)} FROM w)" for d, c in WIDE_DIMS.items())
    keys = ", ".join(f"{_key(c)} AS {d}_sk" for d, c in WIDE_DIMS.items())
    joins = " ".join(f"JOIN d_{d} ON f.{d}_sk = d_{d}.sk" for d in WIDE_DIMS)
    cols = ", ".join([*(c for cs in WIDE_DIMS.values() for c in cs), *WIDE_MEASURES])
    return f"""WITH {_WIDE}, {dims}, f AS (SELECT {keys}, {', '.join(WIDE_MEASURES)} FROM w),
      r AS (SELECT {cols} FROM f {joins}), a AS (SELECT {cols} FROM w)
      SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM r)) AS lost_rows,
             (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM a)) AS invented_rows"""


def _group(member: str, name: str) -> str:
    return (f"CAST(count(*) FILTER (WHERE {member}) AS BIGINT) AS {name}_customers, "
            f"CAST(coalesce(sum(revenue) FILTER (WHERE {member}), 0) AS DOUBLE) AS {name}_revenue")


_COURIER = """WITH share AS (SELECT l_orderkey, l_suppkey,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
    CAST(sum(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS tips,
    min(CAST(5 - 20 * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(4,2))) AS rate
  FROM lineitem GROUP BY 1, 2),
d AS (SELECT s.*, year(o_orderdate) AS y, month(o_orderdate) AS mo FROM share s JOIN orders ON l_orderkey = o_orderkey),
rated AS (SELECT l_suppkey, y, mo, sum(rate) AS rate_sum, count(*) AS n FROM d GROUP BY 1, 2, 3),
card(lo, hi, pct, floor_sum) AS (VALUES
  (CAST(0 AS DECIMAL(4,2)), CAST(3.9 AS DECIMAL(4,2)), CAST(0.04 AS DECIMAL(4,2)), CAST(50 AS DECIMAL(18,2))),
  (3.9, 4.1, 0.06, 80), (4.1, 99, 0.09, 120)),
tiered AS (SELECT r.*, pct, floor_sum FROM rated r LEFT JOIN card ON rate_sum >= lo * n AND rate_sum < hi * n),
ledger AS (SELECT d.l_suppkey, d.y, d.mo, any_value(t.n) AS n, any_value(t.rate_sum) AS rate_sum, sum(amount) AS amount,
    sum(tips) AS tips, sum(greatest(round(pct * amount, 2), floor_sum)) AS payout
  FROM d JOIN tiered t ON d.l_suppkey = t.l_suppkey AND d.y = t.y AND d.mo = t.mo GROUP BY 1, 2, 3)
SELECT l_suppkey AS courier_id, y AS settlement_year, mo AS settlement_month, n AS orders_count,
  CAST(amount AS DOUBLE) AS orders_total, CAST(rate_sum AS DOUBLE) / CAST(n AS DOUBLE) AS mean_rate,
  CAST(tips AS DOUBLE) AS tips_total, CAST(payout AS DOUBLE) AS payout,
  CAST(payout + round(tips * CAST(0.95 AS DECIMAL(4,2)), 2) AS DOUBLE) AS reward
FROM ledger"""


def _zone_mart() -> str:
    weekly = ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS week_{t}" for t in EVENT_TYPES)
    monthly = ", ".join(
        f"CAST(sum(week_{t}) OVER (PARTITION BY zone_id, month) AS BIGINT) AS month_{t}" for t in EVENT_TYPES)
    kept = ", ".join(f"week_{t}" for t in EVENT_TYPES)
    return f"""WITH {EVENTS}, z AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, CAST(n_nationkey AS BIGINT) AS zone_id, {weekly}
      FROM ev LEFT JOIN nation ON n_nationkey = k // 4 GROUP BY 1, 2),
    zm AS (SELECT *, CAST(date_trunc('month', week) AS DATE) AS month FROM z)
    SELECT CAST(week AS VARCHAR) AS week, zone_id, CAST(month AS VARCHAR) AS month, {kept}, {monthly} FROM zm"""


def _user_mart() -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}_events" for t in EVENT_TYPES)
    return f"""WITH {EVENTS}, e AS (SELECT event_id, ts, user_id, event_type, n_nationkey AS zone_id
      FROM ev LEFT JOIN nation ON n_nationkey = k // 4),
    last AS (SELECT user_id, zone_id FROM e WHERE zone_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, zone_id) = 1),
    modal AS (SELECT user_id, zone_id FROM (SELECT user_id, zone_id, count(*) AS n FROM e
        WHERE zone_id IS NOT NULL GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, zone_id) = 1),
    u AS (SELECT user_id, min(ts) AS first_activity, max(ts) AS last_activity, {counts} FROM e GROUP BY 1)
    SELECT u.*, CAST(last.zone_id AS BIGINT) AS last_zone, CAST(modal.zone_id AS BIGINT) AS modal_zone
    FROM u LEFT JOIN last USING (user_id) LEFT JOIN modal USING (user_id)"""


_SHARED = f"""{EVENTS},
member AS (SELECT DISTINCT c_nationkey AS zone_id, user_id, k FROM ev JOIN customer ON user_id = c_custkey
  WHERE event_type = 'view'),
contact AS (SELECT DISTINCT user_id AS a, user_id + k AS b FROM ev WHERE event_type IN ('click', 'signup') AND k <> 0),
w AS (SELECT zone_id, k, count(*) AS n, 1000000 // count(*) AS w FROM member GROUP BY 1, 2),
least_weight AS (SELECT zone_id, greatest(1, {FRIEND_TIMES} * (sum(w * n * (n - 1)) // greatest(1, sum(n * (n - 1))))) AS least
  FROM w GROUP BY 1),
pair AS (SELECT x.zone_id, x.user_id AS a, y.user_id AS b, count(*) AS shared, CAST(sum(w) AS BIGINT) AS weight
  FROM member x JOIN member y ON x.zone_id = y.zone_id AND x.k = y.k AND x.user_id < y.user_id
  JOIN w ON w.zone_id = x.zone_id AND w.k = x.k GROUP BY 1, 2, 3)"""

_NOTIFY = f"""{EVENTS},
sub AS (SELECT DISTINCT user_id, k FROM ev WHERE event_type = 'view'),
fav AS (SELECT user_id, string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) AS favourites FROM sub GROUP BY 1),
promo AS (SELECT event_id AS promo_id, k, ts AS promo_start FROM ev WHERE event_type = 'purchase'
  AND event_id % 50 <> 0 AND ts <= TIMESTAMP '{PROMO_NOW}' AND TIMESTAMP '{PROMO_NOW}' < ts + INTERVAL 1 DAY)"""

_POPULAR = """pop AS (SELECT l_partkey AS dish_id, count(DISTINCT o_orderkey) AS orders, count(DISTINCT o_custkey) AS users
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
ranked AS (SELECT dish_id, p_name AS dish_name, p_type AS category, orders, users,
    dense_rank() OVER (ORDER BY orders DESC) AS rank_overall,
    dense_rank() OVER (PARTITION BY p_type ORDER BY orders DESC) AS rank_in_category
  FROM pop LEFT JOIN part ON dish_id = p_partkey)"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"sin(radians({lat2} - {lat1}) / 2) ** 2 + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* sin(radians({lon2} - {lon1}) / 2) ** 2")
    return f"2 * 6371.0 * asin(sqrt(least({h}, 1.0)))"


ORACLE: dict[str, str] = {
    "source_profile": _profile(),
    "orphan_orders": """SELECT count(*) AS orphans FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "duplicate_keys": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "segment_scores": f"""WITH {_MEASURES} SELECT user_id, CAST(last_order AS VARCHAR) AS last_order, orders,
        CAST(spend AS DOUBLE) AS spend, recency, frequency, monetary, segment FROM seg""",
    "segment_scores_approx": """SELECT c_custkey AS user_id, true AS recency_ok, true AS frequency_ok, true AS monetary_ok
        FROM customer""",
    "segment_summary": f"""WITH {_MEASURES} SELECT segment, count(*) AS users, CAST(sum(orders) AS BIGINT) AS orders,
        CAST(sum(spend) AS DOUBLE) AS spend FROM seg GROUP BY 1""",
    "wide_split_dims": _split_dims(),
    "wide_split_lossless": _split_lossless(),
    "wide_view": f"""WITH {_WIDE} SELECT customer_country, dish_category, count(*) AS line_count,
        CAST(sum(price) AS DOUBLE) AS revenue, CAST(min(order_date) AS VARCHAR) AS first_order FROM w GROUP BY 1, 2""",
    "weekly_retention": f"""WITH {ORDERS},
        pc AS (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, user_id,
            count(*) FILTER (WHERE status <> 'P') AS bought, count(*) FILTER (WHERE status = 'P') AS gave_back,
            sum(CASE WHEN status = 'P' THEN -amount ELSE amount END) AS revenue
          FROM o WHERE status IN ('F', 'O', 'P') GROUP BY 1, 2)
        SELECT CAST(week AS VARCHAR) AS week, {_group('bought = 1', 'new')}, {_group('bought > 1', 'returning')},
          {_group('gave_back > 0', 'refunded')} FROM pc GROUP BY 1""",
    "cohort_retention": f"""WITH {ORDERS},
        act AS (SELECT user_id, CAST(date_trunc('week', order_date) AS DATE) AS week FROM o),
        co AS (SELECT user_id, min(week) AS cohort_week FROM act GROUP BY 1)
        SELECT CAST(cohort_week AS VARCHAR) AS cohort_week,
          CAST((week - cohort_week) // 7 AS BIGINT) AS weeks_since, count(DISTINCT act.user_id) AS customers
        FROM act JOIN co USING (user_id) GROUP BY 1, 2""",
    "status_backfill": f"""WITH {ORDERS},
        h AS (SELECT * REPLACE (CASE WHEN order_date >= DATE '{STATUS_SINCE}' THEN status ELSE 'F' END AS status) FROM o)
        SELECT order_id, user_id, status, CAST(CASE WHEN status = 'P' THEN -amount ELSE amount END AS DOUBLE)
          AS signed_amount, CAST(order_date AS VARCHAR) AS order_date FROM h""",
    "courier_ledger": _COURIER,
    "upsert_counters": """SELECT o_custkey AS user_id, CASE WHEN o_orderstatus <> 'P' THEN year(o_orderdate) END AS order_year,
        count(*) AS orders, CAST(CASE WHEN order_year >= 1998 OR order_year IS NULL AND o_custkey % 2 = 1 THEN 2 ELSE 1 END
        AS BIGINT) AS version FROM orders GROUP BY 1, 2""",
    "paged_extract": f"""WITH {EVENTS}, n AS (SELECT greatest(8, -(-count(*) // {PAGE_ROWS})) AS n FROM ev)
        SELECT event_id, user_id, event_type, k AS group_id, CAST(NULL AS BIGINT) AS cut_page FROM ev, n WHERE event_id % n <> 3
        UNION ALL SELECT NULL, NULL, NULL, NULL, 3 WHERE EXISTS (SELECT 1 FROM ev, n WHERE event_id % n = 3)""",
    "document_landing": f"""WITH {EVENTS} SELECT event_id, user_id, event_type, k AS group_id, 'landed' AS state
        FROM ev WHERE event_type <> 'error' UNION ALL
        SELECT count(*), 0, '', 0, 'set aside' FROM ev WHERE event_type = 'error'""",
    "raw_increment": f"""WITH e AS (SELECT * REPLACE (CASE WHEN event_id % 11 <> 0 THEN ts END AS ts) FROM events),
        s AS (SELECT *, CASE WHEN ts < TIMESTAMP '{FIRST_LOAD}' THEN
              CASE WHEN event_id % 7 = 0 AND ts >= TIMESTAMP '{FIRST_LOAD}' - INTERVAL 1 DAY THEN 1 ELSE 0 END
            WHEN ts IS NULL AND event_id % 2 = 0 THEN 0 ELSE 2 END AS seq FROM e),
        v AS (SELECT seq, event_id, user_id, event_type, ts, 'events' AS load_source FROM s
          UNION ALL SELECT 2, event_id, user_id, 'edited', TIMESTAMP '{FIRST_LOAD}' - INTERVAL 1 HOUR, 'events' FROM e
            WHERE event_id % 13 = 0 AND ts < TIMESTAMP '{FIRST_LOAD}'
          UNION ALL SELECT CASE WHEN event_id % 2 = 0 THEN 0 ELSE 2 END, event_id, user_id, event_type, NULL, 'untimed' FROM events)
        SELECT CASE WHEN seq < 2 THEN '{FIRST_LOAD}' ELSE '{SECOND_LOAD}' END AS load_date, CAST(seq AS BIGINT) AS load_seq,
          event_id, user_id, event_type, ts, load_source FROM v""",
    "change_capture": """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_totalprice AS p FROM orders),
        v AS (SELECT CASE WHEN k % 2 = 0 THEN 0 ELSE 1 END AS load_seq, 'new' AS change, k, c, s, p FROM o
          UNION ALL SELECT 2, 'changed', k, c, 'X', p FROM o WHERE k % 7 <> 0 AND k % 5 = 0 AND s <> 'X'
          UNION ALL SELECT 2, 'gone', k, NULL, NULL, 0 FROM o WHERE k % 7 = 0
          UNION ALL SELECT 2, 'new', NULL, c, s, p FROM o WHERE k = 7)
        SELECT CAST(load_seq AS BIGINT) AS load_seq, change, k AS o_orderkey, c AS o_custkey, s AS o_orderstatus, p AS o_totalprice FROM v""",
    "insert_new_keys": f"""WITH {EVENTS} SELECT nullif(k, 0) AS group_id, user_id, event_id, event_type AS event, ts FROM ev
        QUALIFY row_number() OVER (PARTITION BY nullif(k, 0), user_id ORDER BY ts, event_id) = 1""",
    "promote_weeks": f"""SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, event_type, count(*) AS events,
        CAST(sum(user_id) AS BIGINT) AS user_sum FROM events
        WHERE ts < TIMESTAMP '{FIRST_LOAD}' OR event_type <> 'error' GROUP BY ALL""",
    "community_conversion": f"""WITH {EVENTS},
        old AS (SELECT k, min(ts) AS first_ts FROM ev GROUP BY 1 ORDER BY 2, 1 LIMIT 10),
        j AS (SELECT DISTINCT k, user_id FROM ev WHERE event_type = 'signup'),
        w AS (SELECT * FROM j WHERE EXISTS (SELECT 1 FROM ev WHERE ev.k IS NOT DISTINCT FROM j.k AND ev.user_id = j.user_id
          AND event_type = 'purchase')),
        c AS (SELECT k AS group_id, first_ts, (SELECT count(*) FROM j WHERE j.k IS NOT DISTINCT FROM old.k) AS joined_users,
          (SELECT count(*) FROM w WHERE w.k IS NOT DISTINCT FROM old.k) AS writers FROM old)
        SELECT *, CAST(writers AS DOUBLE) / nullif(CAST(joined_users AS DOUBLE), 0) AS conversion FROM c""",
    "current_members": f"""WITH {EVENTS}, last AS (SELECT * FROM ev WHERE event_type IN ('signup', 'error')
          QUALIFY row_number() OVER (PARTITION BY k, user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT k AS group_id, user_id, ts AS member_since FROM last WHERE event_type = 'signup'""",
    "lake_compaction": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS events,
        CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(sum(user_id) AS BIGINT) AS user_sum, 1::BIGINT AS files_after,
        count(DISTINCT event_id % 4) > 1 AS was_crowded FROM events GROUP BY 1""",
    "clustered_activity": f"""WITH {EVENTS}, s AS (SELECT DISTINCT user_id, k FROM ev WHERE event_type = 'view')
        SELECT ev.user_id, count(*) AS events, count(s.k) AS liked, min(event_id) FILTER (s.k IS NOT NULL) AS first_liked
        FROM ev LEFT JOIN s ON s.user_id = ev.user_id AND s.k = ev.k WHERE ev.user_id IN (SELECT user_id FROM s) GROUP BY 1""",
    "open_fields": f"""WITH {EVENTS}, d AS (SELECT * FROM ev WHERE event_id % 13 <> 0),
        f AS (SELECT '$[''k'']' AS path, CASE WHEN event_id % 11 = 0 THEN 'VOID' WHEN event_id % 3 = 0 THEN 'STRING' ELSE 'BIGINT' END AS kind,
            CASE WHEN event_id % 11 <> 0 THEN CAST(k AS VARCHAR) END AS v FROM d WHERE event_id % 5 <> 0
          UNION ALL SELECT '$[''who''][''id'']', 'BIGINT', CAST(user_id AS VARCHAR) FROM d
          UNION ALL SELECT '$[''who''][''the type'']', 'STRING', event_type FROM d),
        p AS (SELECT path, count(DISTINCT v) AS distinct_values, CAST(coalesce(sum(TRY_CAST(v AS BIGINT)), 0) AS BIGINT) AS number_sum
          FROM f GROUP BY 1)
        SELECT path, kind, count(*) AS docs, distinct_values, number_sum FROM f JOIN p USING (path) GROUP BY ALL""",
    "lake_relayout": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type, count(*) AS events,
        count(DISTINCT user_id) AS users, min(event_id) AS first_event, max(event_id) AS last_event FROM events
        GROUP BY 1, 2""",
    "user_mart": _user_mart(),
    "zone_mart": _zone_mart(),
    "rerun_safe_mart": _zone_mart(),
    "nearest_zone": f"""WITH u AS (SELECT c_custkey AS user_id, CAST(c_custkey * 37 % 180 - 90 AS DOUBLE) AS lat,
          CAST(c_custkey * 73 % 360 - 180 AS DOUBLE) AS lon FROM customer),
        z AS (SELECT CAST(n_nationkey AS BIGINT) AS zone_id, CAST(n_nationkey * 11 % 170 - 85 AS DOUBLE) AS zlat,
          CAST(n_nationkey * 29 % 350 - 175 AS DOUBLE) AS zlon FROM nation),
        d AS (SELECT user_id, zone_id, round({_km('lat', 'lon', 'zlat', 'zlon')}, 3) AS distance_km FROM u, z)
        SELECT user_id, zone_id, distance_km FROM d
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY distance_km, zone_id) = 1""",
    "friend_recommendations": f"""WITH {_SHARED} SELECT CAST(zone_id AS BIGINT) AS zone_id, a, b, shared, weight FROM pair JOIN least_weight USING (zone_id)
        WHERE weight >= least AND NOT EXISTS (SELECT 1 FROM contact c WHERE c.a = pair.a AND c.b = pair.b)""",
    "stream_notifications": f"""WITH {_NOTIFY} SELECT promo_id, k AS restaurant_id, user_id, promo_start, favourites,
        {_key(['promo_id', 'user_id'])} AS message_id FROM promo JOIN sub USING (k) JOIN fav USING (user_id)""",
    "stream_feedback": f"""WITH {_NOTIFY} SELECT promo_id, k AS restaurant_id, user_id, {_key(['promo_id', 'user_id'])} AS message_id,
        'none' AS feedback FROM promo JOIN sub USING (k)""",
    "stream_rejects": """SELECT event_id AS promo_id, 'promotions' AS topic, ts AS sent, CAST(1 AS BIGINT) AS has_text FROM events
        WHERE event_type = 'purchase' AND event_id % 50 = 0""",
    "stream_layers": """SELECT o_custkey AS user_id, 'dish' AS kind, CAST(l_partkey AS VARCHAR) AS item,
          count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 3
        UNION ALL SELECT o_custkey, 'category', p_type, count(DISTINCT o_orderkey)
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 3""",
    "dish_popularity": f"WITH {_POPULAR} SELECT * FROM ranked",
    "top_dishes": f"WITH {_POPULAR} SELECT * FROM ranked ORDER BY orders DESC, dish_id LIMIT {TOP_DISHES}",
    "user_dish_counts": """SELECT o_custkey AS user_id, 'dish' AS kind, CAST(l_partkey AS VARCHAR) AS item,
          count(DISTINCT o_orderkey) AS orders
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 3
        UNION ALL SELECT o_custkey, 'category', p_type, count(DISTINCT o_orderkey)
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 3""",
}

# A mart that is kept up to date equals one that is computed at once.
ORACLE["refresh_changed"] = ORACLE["weekly_retention"]
