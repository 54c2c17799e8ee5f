"""Independent ANSI SQL (DuckDB dialect) for every registered query, over the
driver's tables.  Written with plain windows/joins – not a transcription of
the Spark plans (e.g. the Spark side uses max_by aggregates, a segmented
neighbour lookup and a left-join MERGE) – so it checks the semantics."""

from __future__ import annotations

STATUSES = "('PLACED', 'PAID', 'SHIPPED', 'CANCELLED', 'REFUNDED')"
NOT_REVENUE = "('CANCELLED', 'REFUNDED')"

ORDER_EVENTS = """
geo AS (
  SELECT n.n_nationkey, r.r_name, r2.r_name AS r2_name
  FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN region r2 ON r2.r_regionkey = (r.r_regionkey + 1) % 5
),
ev AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
    CASE WHEN (l.l_orderkey + l.l_linenumber) % 197 = 0 THEN NULL
         ELSE 'O' || CAST(o.o_orderkey AS VARCHAR) END AS order_id,
    CASE WHEN (l.l_orderkey + l.l_linenumber) % 211 = 0 THEN NULL
         ELSE 'C' || CAST(c.c_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN c.c_custkey % 11 = 0 AND o.o_orderdate >= TIMESTAMP '1999-01-01'
         THEN c.c_name || ' II' ELSE c.c_name END AS customer_name,
    CASE WHEN c.c_custkey % 7 = 0 AND o.o_orderdate >= TIMESTAMP '1998-07-01'
         THEN g.r2_name ELSE g.r_name END AS customer_region,
    'P' || CAST(p.p_partkey AS VARCHAR) AS product_id,
    p.p_name AS product_name,
    p.p_type AS product_category,
    p.p_retailprice AS unit_price,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CASE WHEN (l.l_orderkey * 7 + l.l_suppkey) % 101 = 0 THEN -l.l_extendedprice
         ELSE l.l_extendedprice END AS order_total,
    CASE WHEN o.o_orderkey % 89 = 0 THEN 'TEST'
         WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'REFUNDED'
         WHEN l.l_returnflag = 'R' THEN 'CANCELLED'
         WHEN l.l_returnflag = 'A' THEN 'SHIPPED'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'PAID'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'PLACED' END AS status,
    o.o_orderdate AS event_ts,
    'checkout-service-v2' AS ingest_source,
    l.l_shipdate AS _ingested_at
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
),
ev1 AS (SELECT * FROM ev WHERE event_ts < TIMESTAMP '1998-01-01')"""

EV_COLS = ("event_id, order_id, customer_id, customer_name, customer_region, product_id, "
           "product_name, product_category, unit_price, quantity, order_total, status, "
           "event_ts, ingest_source")
BRONZE_COLS = EV_COLS + ", _ingested_at"


def _dedup(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT {BRONZE_COLS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_id
      ORDER BY _ingested_at DESC NULLS LAST, event_ts DESC NULLS LAST,
               product_id DESC NULLS LAST, quantity DESC NULLS LAST,
               order_total DESC NULLS LAST, status DESC NULLS LAST,
               order_id DESC NULLS LAST, customer_id DESC NULLS LAST,
               customer_name DESC NULLS LAST, customer_region DESC NULLS LAST,
               product_name DESC NULLS LAST, product_category DESC NULLS LAST,
               unit_price DESC NULLS LAST, ingest_source DESC NULLS LAST) AS rn
    FROM {src}) WHERE rn = 1
)"""


def _silver(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * FROM {src} WHERE order_total > 0 AND status IN {STATUSES}
)"""


def _latest(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT customer_id, customer_name, customer_region,
         CAST(event_ts AS DATE) AS effective_date, first_seen_date
  FROM (
    SELECT *,
      row_number() OVER (PARTITION BY customer_id
                         ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn,
      min(CAST(event_ts AS DATE)) OVER (PARTITION BY customer_id) AS first_seen_date
    FROM {src} WHERE customer_id IS NOT NULL) WHERE rn = 1
)"""


BASE = ("WITH " + ORDER_EVENTS + "," + _dedup("ev", "dd") + "," + _silver("dd", "silver")
        + "," + _dedup("ev1", "dd1") + "," + _silver("dd1", "silver1")
        + "," + _latest("silver", "latest") + "," + _latest("silver1", "latest1") + """,
dim_init AS (
  SELECT md5(customer_id) AS customer_key, customer_id, customer_name, customer_region,
         first_seen_date AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
  FROM latest1
),
changes AS (
  SELECT l.* FROM latest l
  JOIN dim_init d ON l.customer_id = d.customer_id AND d.is_current
  WHERE l.customer_region <> d.customer_region OR l.customer_name <> d.customer_name
),
dim AS (
  SELECT customer_key, customer_id, customer_name, customer_region, start_date, end_date, is_current
  FROM dim_init WHERE NOT is_current
  UNION ALL
  SELECT d.customer_key, d.customer_id, d.customer_name, d.customer_region, d.start_date,
         CASE WHEN c.customer_id IS NOT NULL THEN c.effective_date ELSE d.end_date END,
         CASE WHEN c.customer_id IS NOT NULL THEN false ELSE d.is_current END
  FROM dim_init d LEFT JOIN changes c ON d.customer_id = c.customer_id
  WHERE d.is_current
  UNION ALL
  SELECT md5(customer_id || '|' || CAST(effective_date AS VARCHAR)), customer_id, customer_name,
         customer_region, effective_date, CAST(NULL AS DATE), true
  FROM changes
),
dim_product AS (
  SELECT md5(product_id) AS product_key, product_id, product_name, product_category FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id
                                 ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM silver) WHERE rn = 1
),
fact AS (
  SELECT s.order_id, s.event_id, dc.customer_key, dp.product_key,
         CAST(strftime(s.event_ts, '%Y%m%d') AS INTEGER) AS date_key,
         s.quantity, s.unit_price, s.order_total, s.status, s.event_ts
  FROM silver s
  JOIN dim dc ON s.customer_id = dc.customer_id
             AND CAST(s.event_ts AS DATE) >= dc.start_date
             AND (dc.end_date IS NULL OR CAST(s.event_ts AS DATE) < dc.end_date)
  JOIN dim_product dp ON s.product_id = dp.product_id
),
hist_ev AS (
  SELECT customer_id, event_ts, event_id, customer_name, customer_region,
         row_number() OVER w AS rn,
         lag(customer_name) OVER w AS prev_name,
         lag(customer_region) OVER w AS prev_region
  FROM silver WHERE customer_id IS NOT NULL
  WINDOW w AS (PARTITION BY customer_id ORDER BY event_ts ASC NULLS FIRST, event_id ASC NULLS FIRST)
),
hist_start AS (
  SELECT *, CAST(event_ts AS DATE) AS start_date FROM hist_ev
  WHERE rn = 1 OR customer_name IS DISTINCT FROM prev_name
        OR customer_region IS DISTINCT FROM prev_region
),
history AS (
  SELECT CASE WHEN rn = 1 THEN md5(customer_id)
              ELSE md5(customer_id || '|' || CAST(start_date AS VARCHAR) || '|' || event_id) END
           AS customer_key,
         customer_id, customer_name, customer_region, start_date,
         lead(start_date) OVER w2 AS end_date,
         lead(rn) OVER w2 IS NULL AS is_current
  FROM hist_start
  WINDOW w2 AS (PARTITION BY customer_id ORDER BY event_ts ASC NULLS FIRST, event_id ASC NULLS FIRST)
)
""")

MONEY_SUM = "ROUND(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE), 2)"


def _mart(current_only: bool, count_name: str, extra_where: str = "", limit: str = "") -> str:
    cur = " AND dc.is_current" if current_only else ""
    return BASE + f"""
SELECT dc.customer_region, dp.product_category,
       {MONEY_SUM.format(c='f.order_total')} AS revenue,
       COUNT(*) AS {count_name}
FROM fact f
JOIN dim dc ON f.customer_key = dc.customer_key{cur}
JOIN dim_product dp ON f.product_key = dp.product_key
WHERE f.status NOT IN {NOT_REVENUE}{extra_where}
GROUP BY dc.customer_region, dp.product_category
ORDER BY revenue DESC, dc.customer_region, dp.product_category {limit}
"""


SQL: dict[str, str] = {
    "order_events": BASE + f"SELECT {BRONZE_COLS} FROM ev",
    "dedup_latest": BASE + "SELECT * FROM dd",
    "silver_orders": BASE + "SELECT * FROM silver",
    "quarantine_split": BASE + f"""
SELECT *, CASE WHEN NOT COALESCE(order_total > 0, false) THEN 'bad_total'
               WHEN NOT COALESCE(status IN {STATUSES}, false) THEN 'bad_status' END AS reject_reason
FROM dd
WHERE NOT COALESCE(order_total > 0 AND status IN {STATUSES}, false)""",
    "quality_gate": BASE + """,
m AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL) AS nulls,
         count(*) FILTER (WHERE order_total <= 0) AS bad_totals
  FROM ev
),
t AS (SELECT CAST(x AS DOUBLE) AS threshold FROM (VALUES (0.02), (0.005)) v(x))
SELECT t.threshold, m.total, m.nulls, m.bad_totals,
       CASE WHEN m.total > 0 THEN m.nulls / m.total ELSE 1.0 END AS null_rate,
       CASE WHEN (CASE WHEN m.total > 0 THEN m.nulls / m.total ELSE 1.0 END) > t.threshold
                 OR m.bad_totals > m.total * t.threshold
            THEN 'quarantine' ELSE 'proceed' END AS decision
FROM t JOIN m ON true""",
    "dim_product": BASE + "SELECT * FROM dim_product",
    "dim_date": BASE + """,
days AS (
  SELECT CAST(unnest(generate_series(CAST(min(CAST(event_ts AS DATE)) AS TIMESTAMP),
                                     CAST(max(CAST(event_ts AS DATE)) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM silver
)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_of_week,
       dayofweek(d) IN (0, 6) AS is_weekend, CAST(weekofyear(d) AS INTEGER) AS week_of_year
FROM days""",
    "customer_latest": BASE + "SELECT * FROM latest",
    "scd2_init": BASE + "SELECT * FROM dim_init",
    "scd2_changes": BASE + "SELECT * FROM changes",
    "scd2_apply": BASE + "SELECT * FROM dim",
    "scd2_apply_with_new": BASE + """
SELECT * FROM dim
UNION ALL
SELECT md5(l.customer_id), l.customer_id, l.customer_name, l.customer_region,
       l.first_seen_date, CAST(NULL AS DATE), true
FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM dim_init d WHERE d.customer_id = l.customer_id AND d.is_current)""",
    "merge_upsert": BASE + """
SELECT d.customer_key, d.customer_id, d.customer_name, d.customer_region, d.start_date,
       CASE WHEN l.customer_id IS NOT NULL AND l.customer_region <> d.customer_region
            THEN l.effective_date ELSE d.end_date END AS end_date,
       CASE WHEN l.customer_id IS NOT NULL AND l.customer_region <> d.customer_region
            THEN false ELSE d.is_current END AS is_current
FROM dim_init d LEFT JOIN latest l ON d.customer_id = l.customer_id AND d.is_current
UNION ALL
SELECT md5(l.customer_id), l.customer_id, l.customer_name, l.customer_region,
       l.effective_date, CAST(NULL AS DATE), true
FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM dim_init d WHERE d.customer_id = l.customer_id AND d.is_current)""",
    "scd2_full_history": BASE + "SELECT * FROM history",
    "dim_customer_as_of": BASE + """
SELECT * FROM history
WHERE start_date <= DATE '1998-12-31' AND (end_date IS NULL OR DATE '1998-12-31' < end_date)""",
    "fact_orders": BASE + "SELECT * FROM fact",
    "revenue_top10": _mart(True, "orders", limit="LIMIT 10"),
    "revenue_top10_sql": _mart(True, "orders", limit="LIMIT 10"),
    "sales_summary": _mart(True, "order_count"),
    "sales_summary_by_region": _mart(True, "order_count", " AND dc.customer_region = 'EUROPE'"),
    "customer_ltv": BASE + f"""
SELECT 'C7' AS customer_id,
       CAST(COALESCE(SUM(CAST(f.order_total AS DECIMAL(18,2))), 0) AS DOUBLE) AS ltv
FROM fact f JOIN dim dc ON f.customer_key = dc.customer_key
WHERE dc.customer_id = 'C7' AND f.status NOT IN {NOT_REVENUE}""",
    "customer_ltv_all": BASE + f""",
per_key AS (
  SELECT customer_key, SUM(CAST(order_total AS DECIMAL(18,2))) AS s
  FROM fact WHERE status NOT IN {NOT_REVENUE} GROUP BY customer_key
)
SELECT d.customer_id, CAST(COALESCE(SUM(p.s), 0) AS DOUBLE) AS ltv
FROM dim d LEFT JOIN per_key p ON d.customer_key = p.customer_key
GROUP BY d.customer_id""",
    "revenue_as_was": _mart(False, "order_count"),
    "bronze_parse_json": BASE + f"SELECT {EV_COLS} FROM ev",
    "kafka_records": BASE + f"SELECT customer_id AS key, {EV_COLS} FROM ev",
    "fact_by_status": BASE + f"""
SELECT status, COUNT(*) AS rows, {MONEY_SUM.format(c='order_total')} AS amount
FROM fact GROUP BY status""",
    "fact_by_day": BASE + f"""
SELECT CAST(event_ts AS DATE) AS event_day, COUNT(*) AS rows,
       {MONEY_SUM.format(c='order_total')} AS amount
FROM fact
WHERE CAST(event_ts AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'
GROUP BY CAST(event_ts AS DATE)""",
}

_REGION_TOTALS = BASE + f"""
SELECT customer_region, COUNT(*) AS events, {MONEY_SUM.format(c='order_total')} AS order_total_sum,
       COUNT(*) FILTER (WHERE event_ts IS NULL) AS null_event_ts
FROM ev GROUP BY customer_region"""
SQL["silver_stream_merge"] = BASE + "SELECT * FROM silver"
SQL["silver_stream"] = BASE + f""",
feed AS (
  SELECT *, least(year(event_ts) - 1995 + (month(_ingested_at) - 1) % 4, 4) AS load FROM ev
),
marks AS (
  SELECT load, max(newest) OVER (ORDER BY load ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
               - INTERVAL 400 DAY AS watermark
  FROM (SELECT load, max(event_ts) AS newest FROM feed GROUP BY load)
),
told AS (
  SELECT f.*, coalesce(f.event_ts < m.watermark, false) AS late FROM feed f JOIN marks m ON f.load = m.load
)
SELECT {BRONZE_COLS},
       CASE WHEN late THEN 'late'
            WHEN row_number() OVER (PARTITION BY event_id, late
                   ORDER BY load, _ingested_at DESC NULLS LAST, event_ts DESC NULLS LAST, product_id DESC NULLS LAST,
                            quantity DESC NULLS LAST, order_total DESC NULLS LAST, status DESC NULLS LAST) = 1 THEN 'accepted'
            ELSE 'duplicate' END AS delivery
FROM told"""
SQL["load_audit"] = BASE + """
SELECT CAST(split_part(event_id, '-', 1) AS BIGINT) % 6 AS version, 'WRITE' AS operation, COUNT(*) AS rows
FROM ev GROUP BY 1 HAVING CAST(split_part(any_value(event_id), '-', 1) AS BIGINT) % 6 > 0"""
SQL["dim_customer_time_travel"] = BASE + "SELECT * FROM dim_init"
SQL["bronze_batch"] = _REGION_TOTALS
SQL["bronze_stream"] = _REGION_TOTALS
SQL["silver_bucketed"] = BASE + "SELECT * FROM silver"
SQL["customer_latest_incremental"] = BASE + "SELECT * FROM latest"
SQL["fact_interval_sweep"] = BASE + "SELECT * FROM fact"


def _merged_dim(before: str, latest: str, name: str) -> str:
    """Dimension ``name`` after the changes of ``latest`` against ``before``."""
    return f"""
{name}_changes AS (
  SELECT l.* FROM {latest} l JOIN {before} d ON l.customer_id = d.customer_id AND d.is_current
  WHERE l.customer_region <> d.customer_region OR l.customer_name <> d.customer_name
),
{name} AS (
  SELECT d.customer_key, d.customer_id, d.customer_name, d.customer_region, d.start_date,
         CASE WHEN d.is_current AND c.customer_id IS NOT NULL THEN c.effective_date ELSE d.end_date END AS end_date,
         d.is_current AND c.customer_id IS NULL AS is_current
  FROM {before} d LEFT JOIN {name}_changes c ON d.customer_id = c.customer_id
  UNION ALL
  SELECT md5(customer_id || '|' || CAST(effective_date AS VARCHAR)), customer_id, customer_name,
         customer_region, effective_date, CAST(NULL AS DATE), true
  FROM {name}_changes
)"""


_FED = """
fed AS (
  SELECT *, CASE WHEN CAST(split_part(event_id, '-', 1) AS BIGINT) % 10 = 3 THEN 3
                 WHEN CAST(split_part(event_id, '-', 1) AS BIGINT) % 10 = 4 AND _ingested_at < TIMESTAMP '2000-07-01' THEN 2
                 WHEN _ingested_at < TIMESTAMP '1998-01-01' THEN 1
                 WHEN _ingested_at < TIMESTAMP '2000-07-01' THEN 2 ELSE 3 END AS load
  FROM ev
),
fed1 AS (SELECT * FROM fed WHERE load <= 1),
fed2 AS (SELECT * FROM fed WHERE load <= 2)"""

SQL["sales_summary_incremental"] = BASE + "," + ",".join([
    _FED, _dedup("fed1", "won1"), _silver("won1", "valid1"), _latest("valid1", "newest1"),
    _dedup("fed2", "won2"), _silver("won2", "valid2"), _latest("valid2", "newest2"), """
dim_of1 AS (
  SELECT md5(customer_id) AS customer_key, customer_id, customer_name, customer_region,
         first_seen_date AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
  FROM newest1
)""", _merged_dim("dim_of1", "newest2", "dim_of2"), _merged_dim("dim_of2", "latest", "dim_of3")]) + f"""
SELECT d.customer_region, p.product_category, {MONEY_SUM.format(c='s.order_total')} AS revenue, COUNT(*) AS order_count
FROM silver s
JOIN dim_of3 d ON s.customer_id = d.customer_id AND d.is_current AND CAST(s.event_ts AS DATE) >= d.start_date
              AND (d.end_date IS NULL OR CAST(s.event_ts AS DATE) < d.end_date)
JOIN dim_product p ON s.product_id = p.product_id
WHERE s.status NOT IN {NOT_REVENUE}
GROUP BY d.customer_region, p.product_category"""

SQL["bronze_corrupt"] = BASE + """,
numbered AS (SELECT event_id, CAST(split_part(event_id, '-', 1) AS BIGINT) AS n FROM ev)
SELECT CASE WHEN n % 97 = 0 THEN '{"event_id":"' || event_id || '","order_id":"O'
            WHEN n % 83 = 0 THEN '{"event_id":"' || event_id || '","quantity":"many"}'
            ELSE 'event ' || event_id END AS raw,
       CAST(n % 6 AS INTEGER) AS folder,
       CASE WHEN n % 97 <> 0 AND n % 83 = 0 THEN 'bad_field' ELSE 'not_json' END AS reason
FROM numbered WHERE n % 97 = 0 OR n % 83 = 0 OR n % 89 = 0"""
SQL["revenue_by_region_bucketed"] = BASE + f"""
SELECT d.customer_region, {MONEY_SUM.format(c='f.order_total')} AS revenue, COUNT(*) AS order_count,
       COUNT(DISTINCT f.customer_key) AS customers
FROM fact f JOIN dim d ON f.customer_key = d.customer_key AND d.is_current
WHERE f.status NOT IN {NOT_REVENUE}
GROUP BY d.customer_region"""
SQL["revenue_by_week"] = BASE + f"""
SELECT CAST(year(event_ts) AS INTEGER) AS year, CAST(weekofyear(event_ts) AS INTEGER) AS week_of_year,
       {MONEY_SUM.format(c='order_total')} AS revenue, COUNT(*) AS order_count,
       COUNT(*) FILTER (dayofweek(event_ts) IN (0, 6)) AS weekend_orders
FROM fact WHERE status NOT IN {NOT_REVENUE} AND year(event_ts) = 1998
GROUP BY 1, 2"""
