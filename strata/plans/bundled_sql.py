"""Oracle SQL for the bundled queries (DuckDB dialect, same parquet tables).

Column names equal the Spark query's output names. The derived dirt uses the
same CASE expressions as ``strata.plans.bundled``.
"""
from __future__ import annotations

def _dec(col: str, scale: int = 2) -> str:
    return f"CAST({col} AS DECIMAL(18,{scale}))"


def _xsum(col: str, scale: int = 2) -> str:
    """Exact sum of a decimal measure, rounded to 2 digits, as DOUBLE."""
    return f"CAST(round(sum({_dec(col, scale)}), 2) AS DOUBLE)"


def _xavg(col: str, scale: int = 2) -> str:
    """Exact mean rounded HALF_UP to 2 digits: integer arithmetic on the
    input's smallest unit (10^-scale)."""
    units = f"CAST(sum({_dec(col, scale)}) * {10 ** scale} AS HUGEINT)"
    n = f"(count({col}) * {10 ** (scale - 2)})"
    return f"(CAST(sign({units}) * ((2 * abs({units}) + {n}) // (2 * {n})) AS DOUBLE) / 100)"


def _xext(fn: str, col: str, scale: int = 2) -> str:
    return f"CAST(round({fn}({_dec(col, scale)}), 2) AS DOUBLE)"


_RAW_ORDERS = """
raw AS (
  SELECT
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
         WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') THEN CAST(o_orderkey AS VARCHAR)
    END AS raw_key,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'not-a-date'
         ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS raw_date,
    CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) || '.25' END AS raw_amount,
    CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' ELSE 'maybe' END AS raw_flag
  FROM orders
)"""

_ORDER_FLAGS = """
flags AS (
  SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END AS fulfilled,
         o_totalprice > 300000 AS large
  FROM orders
),
rate AS (
  SELECT order_date, o_orderpriority,
         COUNT(*) AS order_count,
         CAST(SUM(CAST(fulfilled AS INTEGER)) AS BIGINT) AS fulfilled_count,
         CAST(SUM(CAST(large AS INTEGER)) AS BIGINT) AS large_count
  FROM flags GROUP BY order_date, o_orderpriority
)"""

_DQ_TAGGED = """
dq_in AS (
  SELECT *, CASE WHEN c_nationkey < 20 THEN c_nationkey END AS nation_hint FROM customer
),
tagged AS (
  SELECT *,
    list_concat(
      CASE WHEN c_custkey IS NULL OR nation_hint IS NULL
           THEN ['not_null(c_custkey,nation_hint)'] ELSE [] END,
      CASE WHEN COALESCE(c_acctbal IS NOT NULL AND NOT (c_acctbal BETWEEN 0 AND 9500), FALSE)
           THEN ['between(c_acctbal,0,9500)'] ELSE [] END,
      CASE WHEN COALESCE(c_mktsegment IS NOT NULL AND c_mktsegment NOT IN
             ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'), FALSE)
           THEN ['values_in(c_mktsegment)'] ELSE [] END
    ) AS f
  FROM dq_in
)"""


def _snapshot(name: str, start: str | None, end: str) -> str:
    lower = f"AND o_orderdate >= TIMESTAMP '{start}'" if start else ""
    return f"""
{name} AS (
  SELECT o_custkey, o_orderstatus, o_orderpriority, TIMESTAMP '{end}' AS effective_from
  FROM orders
  WHERE o_orderdate < TIMESTAMP '{end}' {lower}
  QUALIFY row_number() OVER (PARTITION BY o_custkey
                             ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1
)"""


def _merge(name: str, target: str, updates: str, key: str = "o_custkey",
           tracked: tuple[str, ...] = ("o_orderstatus", "o_orderpriority")) -> str:
    """One SCD2 step as SQL: history + expanded full outer join."""
    cols = [key, *tracked]
    t_cols = ", ".join(f"t.{c} AS t_{c}" for c in cols)
    u_cols = ", ".join(f"u.{c} AS u_{c}" for c in cols)
    differs = " OR ".join(f"t.{c} IS DISTINCT FROM u.{c}" for c in tracked)
    t_sel = ", ".join(f"t_{c}" for c in cols)
    u_sel = ", ".join(f"u_{c}" for c in cols)
    return f"""
{name}_j AS (
  SELECT {t_cols}, t.effective_from AS t_from, {u_cols}, u.effective_from AS u_from,
         (t.{key} IS NOT NULL AND u.{key} IS NOT NULL AND ({differs})) AS changed
  FROM (SELECT * FROM {target} WHERE is_current) t
  FULL OUTER JOIN {updates} u ON t.{key} = u.{key}
),
{name} AS (
  SELECT {", ".join(cols)}, effective_from, effective_to, is_current
  FROM {target} WHERE NOT is_current
  UNION ALL
  SELECT {t_sel}, t_from, CASE WHEN changed THEN u_from END, NOT changed
  FROM {name}_j WHERE t_{key} IS NOT NULL
  UNION ALL
  SELECT {u_sel}, u_from, CAST(NULL AS TIMESTAMP), TRUE
  FROM {name}_j WHERE u_{key} IS NOT NULL AND (t_{key} IS NULL OR changed)
)"""


_SCD2_BASE = ",".join(
    [
        _snapshot("snap0", None, "1996-01-01"),
        """
dim0 AS (
  SELECT *, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM snap0
)""",
        _snapshot("snap1", "1996-01-01", "1999-01-01"),
        _merge("dim1", "dim0", "snap1"),
        _snapshot("snap2", "1999-01-01", "2002-01-01"),
        _merge("dim2", "dim1", "snap2"),
        _snapshot("snap_all", None, "2002-01-01"),
        _snapshot("snap_rest", "1996-01-01", "2002-01-01"),
        _merge("dim_rest", "dim0", "snap_rest"),
    ]
)

_UNKEYED = "* REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey)"
_SCD2_NULLS = ",".join(
    [
        _SCD2_BASE,
        f"""
null_dim AS (SELECT {_UNKEYED} FROM dim0),
null_new AS (SELECT {_UNKEYED} FROM snap_rest)""",
        _merge("null_merged", "(SELECT * FROM null_dim WHERE o_custkey IS NOT NULL)",
               "(SELECT * FROM null_new WHERE o_custkey IS NOT NULL)"),
    ]
)


ORACLE_SQL: dict[str, str] = {
    "bronze_stamp": """
SELECT *, 'orders' AS _source_system, 'orders-2024-01-01' AS _batch_id,
       'landing/orders/ingest_date=2024-01-01' AS _source_file,
       '2024-01-01' AS _ingest_date
FROM orders""",
    "lenient_typing": f"""
WITH {_RAW_ORDERS}
SELECT upper(trim(raw_key)) AS order_key,
       try_cast(raw_date AS TIMESTAMP) AS ordered_at,
       CAST(try_cast(raw_date AS TIMESTAMP) AS DATE) AS order_date,
       try_cast(raw_amount AS DOUBLE) AS amount,
       try_cast(raw_flag AS BOOLEAN) AS fulfilled
FROM raw
WHERE raw_key IS NOT NULL AND raw_date IS NOT NULL""",
    "normalise_keys": """
SELECT c_custkey,
       upper(trim('  ' || lower(c_mktsegment) || ' ')) AS segment,
       upper(trim(lower(c_name) || '   ')) AS name
FROM customer""",
    "null_out_of_range": """
SELECT c_custkey,
       CASE WHEN c_acctbal BETWEEN 0.0 AND 9000.0 THEN c_acctbal END AS acctbal,
       CASE WHEN c_nationkey BETWEEN 0 AND 20 THEN c_nationkey END AS nationkey
FROM customer""",
    "dedupe_latest": """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST) = 1""",
    "dedupe_latest_ties": """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) = 1""",
    "flatten_columnar": """
WITH p AS (
  SELECT vec_id, label, embedding, embedding[1:label * 10] AS head FROM embeddings
),
x AS (
  SELECT vec_id, label, embedding, head, unnest(generate_series(1, len(embedding))) AS i FROM p
)
SELECT vec_id, label, CAST(i - 1 AS INTEGER) AS dim, embedding[i] AS value,
       CASE WHEN i <= len(head) THEN head[i] END AS head
FROM x""",
    "gold_daily": f"""
WITH s AS (
  SELECT event_type, CAST(ts AS DATE) AS event_date,
         CASE WHEN value BETWEEN 0.0 AND 400.0 THEN value END AS value
  FROM events
)
SELECT event_type, event_date,
       {_xext('min', 'value')} AS value_min, {_xext('max', 'value')} AS value_max,
       {_xavg('value')} AS value_avg, {_xsum('value')} AS value_total,
       COUNT(*) AS n_events
FROM s GROUP BY event_type, event_date""",
    "gold_rate": f"""
WITH {_ORDER_FLAGS}
SELECT *, round(fulfilled_count / order_count, 4) AS fulfilled_rate FROM rate""",
    "cross_mart": f"""
WITH {_ORDER_FLAGS},
li AS (
  SELECT l_returnflag, CAST(l_shipdate AS DATE) AS ship_date,
         {_xsum('l_discount')} AS disc_total, {_xsum('l_quantity')} AS qty_total
  FROM lineitem GROUP BY l_returnflag, CAST(l_shipdate AS DATE)
)
SELECT r.order_date, CAST(SUM(r.order_count) AS BIGINT) AS orders,
       ANY_VALUE(w.disc_total) AS disc_total, ANY_VALUE(w.qty_total) AS qty_total
FROM rate r
LEFT JOIN li w ON w.l_returnflag = 'R' AND w.ship_date = r.order_date
GROUP BY r.order_date""",
    "windows_batch": """
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
       time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end,
       event_type, COUNT(*) AS event_count
FROM events GROUP BY 1, 2, 3""",
    "dq_good": f"""
WITH {_DQ_TAGGED}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, nation_hint
FROM tagged WHERE len(f) = 0""",
    "dq_quarantine": f"""
WITH {_DQ_TAGGED}
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, nation_hint,
       array_to_string(f, '|') AS dq_reasons
FROM tagged WHERE len(f) > 0""",
    "dq_summary": f"""
WITH {_DQ_TAGGED},
m AS (
  SELECT COUNT(*) AS total_rows,
         COUNT(*) FILTER (WHERE len(f) = 0) AS passed_rows,
         COUNT(*) FILTER (WHERE list_contains(f, 'not_null(c_custkey,nation_hint)')) AS f0,
         COUNT(*) FILTER (WHERE list_contains(f, 'between(c_acctbal,0,9500)')) AS f1,
         COUNT(*) FILTER (WHERE list_contains(f, 'values_in(c_mktsegment)')) AS f2
  FROM tagged
)
SELECT 'not_null(c_custkey,nation_hint)' AS check_name, f0 AS failed_rows, total_rows, passed_rows FROM m
UNION ALL SELECT 'between(c_acctbal,0,9500)', f1, total_rows, passed_rows FROM m
UNION ALL SELECT 'values_in(c_mktsegment)', f2, total_rows, passed_rows FROM m""",
    "dq_duplicates": """
SELECT l_orderkey, l_linenumber, COUNT(*) AS dup_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "scd2_initial": f"""
WITH {_SCD2_BASE}
SELECT *, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM snap_all""",
    "scd2_upsert": f"""
WITH {_SCD2_BASE}
SELECT * FROM dim_rest""",
    "scd2_null_keys": f"""
WITH {_SCD2_NULLS}
SELECT * FROM null_merged
UNION ALL BY NAME
SELECT * FROM null_dim WHERE o_custkey IS NULL
UNION ALL BY NAME
SELECT *, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM null_new WHERE o_custkey IS NULL""",
    "scd2_history": f"""
WITH {_SCD2_BASE}
SELECT * FROM dim2""",
    "medallion_e2e": f"""
WITH delivered AS (
  SELECT event_id, ts, user_id, event_type, value, 1 AS delivery FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value + 1, 2 FROM events WHERE event_type = 'click'
),
latest AS (
  SELECT * FROM delivered WHERE user_id IS NOT NULL AND ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY delivery DESC) = 1
),
s AS (
  SELECT upper(trim(event_type)) AS event_type,
         CAST(try_cast(CAST(ts AS VARCHAR) AS TIMESTAMP) AS DATE) AS event_date,
         CASE WHEN value BETWEEN 0.0 AND 400.0 THEN value END AS value
  FROM latest
),
good AS (
  SELECT * FROM s WHERE COALESCE(value IS NOT NULL AND NOT (value BETWEEN 0.0 AND 350.0), FALSE) = FALSE
)
SELECT event_type, event_date, {_xavg('value')} AS value_avg,
       {_xext('max', 'value')} AS value_max, COUNT(*) AS n_events
FROM good GROUP BY event_type, event_date""",
}


_YEAR_SLICE = "CAST(year(o_orderdate) AS VARCHAR) || '-01-01'"

ORACLE_SQL.update({
    "landing_bronze": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       'b0001' AS batch_id, 'orders' AS _source_system, 'orders-2024-01-01' AS _batch_id,
       '2024-01-01' AS _ingest_date, TRUE AS from_landed_file
FROM orders""",
    "replace_slice": f"""
WITH s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_YEAR_SLICE} AS _ingest_date
  FROM orders
)
SELECT * FROM s
WHERE _ingest_date NOT IN ('1997-01-01', '1998-01-01')
   OR (_ingest_date = '1997-01-01' AND o_orderstatus = 'F')""",
    "schema_evolution": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus,
       CASE WHEN year(o_orderdate) > 1997 THEN o_orderpriority END AS o_orderpriority,
       {_YEAR_SLICE} AS _ingest_date
FROM orders""",
    "incremental_cursor": """
SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00'""",
    "incremental_hwm": """
SELECT max(o_orderdate) AS new_hwm FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00'""",
    "incremental_window": """
SELECT * FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1998-01-01'""",
    "paged_read": """
WITH n AS (
  SELECT o_orderkey, o_orderdate, o_custkey,
         row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_ordinal
  FROM orders
)
SELECT *, row_ordinal // 1000 AS page_no FROM n""",
    "keyset_page": """
SELECT o_orderkey, o_orderdate, o_custkey FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'
   OR (o_orderdate = TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey > 0)
ORDER BY o_orderdate, o_orderkey
LIMIT 1000""",
    "windows_stream": """
WITH w AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type, COUNT(*) AS event_count
  FROM events WHERE event_id IS NOT NULL AND ts IS NOT NULL
  GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, event_type, event_count
FROM w
WHERE window_start + INTERVAL '10 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '15 minutes'""",
})


# -- domain pipelines over derived feeds (strata.plans.bundled_domain) -------

_DAY_L = "CAST(CAST(l_shipdate AS DATE) AS VARCHAR)"
_PAD = "lpad(CAST({0} AS VARCHAR), CAST(greatest(length(CAST({0} AS VARCHAR)), {1}) AS INTEGER), '0')"

_WEATHER_FLAT = f"""
wli AS (
  SELECT *,
    CASE WHEN l_returnflag = 'R' THEN 'chicago' WHEN l_returnflag = 'A' THEN 'new_york'
         ELSE 'seattle' END AS city,
    'weather-' || {_DAY_L} || '-' || {_PAD.format('l_orderkey', 10)} || '-'
      || {_PAD.format('l_partkey', 8)} || '-' || {_PAD.format('l_suppkey', 6)} || '-'
      || CAST(l_linenumber AS VARCHAR) AS _source_file
  FROM lineitem
),
wflat AS (
  SELECT city, _source_file,
    {_DAY_L} || 'T' || {_PAD.format('h', 2)} || ':00' AS observed_at_s,
    CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + h * INTERVAL 1 HOUR AS observed_at,
    CASE WHEN l_quantity > 48 THEN CAST(999.0 AS DOUBLE) ELSE l_quantity - 20 + h END AS temperature_2m,
    round(l_tax * 1000) + h * 10 AS relative_humidity_2m,
    CASE WHEN h < l_linenumber - 1 THEN l_discount END AS precipitation,
    l_quantity + h AS wind_speed_10m
  FROM (SELECT *, unnest(range(l_linenumber)) AS h FROM wli)
),
wsilver AS (
  SELECT city, observed_at, _source_file,
    CASE WHEN temperature_2m BETWEEN -60.0 AND 60.0 THEN temperature_2m END AS temperature_2m,
    CASE WHEN relative_humidity_2m BETWEEN 0.0 AND 100.0 THEN relative_humidity_2m END AS relative_humidity_2m,
    precipitation, wind_speed_10m,
    'weather' AS _source_system, 'weather-2024-01-01' AS _batch_id, '2024-01-01' AS _ingest_date,
    CAST(observed_at AS DATE) AS observed_date
  FROM wflat
  QUALIFY row_number() OVER (PARTITION BY city, observed_at ORDER BY _source_file DESC) = 1
),
wgold AS (
  SELECT city, observed_date,
    {_xext('min', 'temperature_2m', 4)} AS temp_min_c,
    {_xext('max', 'temperature_2m', 4)} AS temp_max_c,
    {_xavg('temperature_2m', 4)} AS temp_avg_c,
    {_xsum('precipitation', 4)} AS precip_total_mm,
    {_xavg('relative_humidity_2m', 4)} AS humidity_avg_pct,
    {_xext('max', 'wind_speed_10m', 4)} AS wind_max_kmh,
    COUNT(*) AS hours_observed
  FROM wsilver GROUP BY city, observed_date
)"""

_DAY_O = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"

_CRIMES = f"""
cb AS (
  SELECT
    CASE WHEN o_orderstatus = 'O' THEN 'hy' ELSE 'HY' END || CAST(o_custkey AS VARCHAR) AS case_number,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'unknown'
         ELSE {_DAY_O} || 'T10:00' END AS date,
    {_DAY_O} || 'T00:00' AS updated_on,
    ' ' || lower(o_orderpriority) AS primary_type,
    CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'false' ELSE 'maybe' END AS arrest,
    CASE WHEN o_totalprice > 250000 THEN 'true' ELSE 'false' END AS domestic,
    '41.' || {_PAD.format('o_orderkey % 1000', 3)} AS latitude,
    '-87.' || {_PAD.format('o_custkey % 1000', 3)} AS longitude,
    {_PAD.format('o_custkey % 40', 4)} AS iucr,
    o_orderpriority || ' / ' || o_orderstatus AS description,
    'crimes-' || {_PAD.format('o_orderkey', 10)} AS _source_file
  FROM orders
),
csilver AS (
  SELECT upper(trim(case_number)) AS case_number, date,
    try_cast(date AS TIMESTAMP) AS occurred_at,
    try_cast(updated_on AS TIMESTAMP) AS updated_on,
    upper(trim(primary_type)) AS primary_type,
    try_cast(arrest AS BOOLEAN) AS arrest,
    try_cast(domestic AS BOOLEAN) AS domestic,
    CASE WHEN try_cast(latitude AS DOUBLE) BETWEEN 41.6 AND 42.1 THEN try_cast(latitude AS DOUBLE) END AS latitude,
    CASE WHEN try_cast(longitude AS DOUBLE) BETWEEN -87.95 AND -87.5 THEN try_cast(longitude AS DOUBLE) END AS longitude,
    iucr, description, _source_file,
    'crimes' AS _source_system, 'crimes-2024-01-01' AS _batch_id, '2024-01-01' AS _ingest_date,
    CAST(try_cast(date AS TIMESTAMP) AS DATE) AS occurred_date
  FROM cb
  WHERE case_number IS NOT NULL AND date IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY upper(trim(case_number))
                             ORDER BY try_cast(updated_on AS TIMESTAMP) DESC NULLS LAST,
                                      _source_file DESC) = 1
),
cgood AS (
  SELECT * FROM csilver WHERE case_number IS NOT NULL AND occurred_at IS NOT NULL
),
cgold AS (
  SELECT occurred_date, primary_type, COUNT(*) AS incident_count,
    CAST(SUM(CAST(arrest AS INTEGER)) AS BIGINT) AS arrest_count,
    CAST(SUM(CAST(domestic AS INTEGER)) AS BIGINT) AS domestic_count
  FROM cgood GROUP BY occurred_date, primary_type
)"""


def _iucr_updates(name: str, cond: str, start: str) -> str:
    return f"""
{name} AS (
  SELECT iucr, primary_type, description, TIMESTAMP '{start}' AS effective_from
  FROM cgood WHERE iucr IS NOT NULL AND {cond}
  QUALIFY row_number() OVER (PARTITION BY iucr
                             ORDER BY updated_on DESC NULLS LAST, case_number DESC NULLS LAST) = 1
)"""


_IUCR = ",".join(
    [
        _iucr_updates("iu0", "occurred_date < DATE '1998-01-01'", "1998-01-01 00:00:00"),
        """
idim0 AS (
  SELECT *, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current FROM iu0
)""",
        _iucr_updates("iu1", "TRUE", "2002-01-01 00:00:00"),
        _merge("idim1", "idim0", "iu1", "iucr", ("primary_type", "description")),
    ]
)

_CSILVER_COLS = """case_number, date, occurred_at, updated_on, primary_type, arrest, domestic,
       latitude, longitude, iucr, description, _source_file, _source_system, _batch_id,
       _ingest_date, occurred_date"""

ORACLE_SQL.update({
    "weather_flatten": f"""
WITH {_WEATHER_FLAT}
SELECT city, observed_at_s AS observed_at, temperature_2m, relative_humidity_2m,
       precipitation, wind_speed_10m
FROM wflat""",
    "weather_silver": f"""
WITH {_WEATHER_FLAT}
SELECT * FROM wsilver""",
    "weather_gold_daily": f"""
WITH {_WEATHER_FLAT}
SELECT * FROM wgold""",
    "crimes_silver": f"""
WITH {_CRIMES}
SELECT {_CSILVER_COLS} FROM csilver""",
    "crimes_quarantine": f"""
WITH {_CRIMES}
SELECT {_CSILVER_COLS}, 'not_null(case_number,occurred_at)' AS dq_reasons
FROM csilver WHERE case_number IS NULL OR occurred_at IS NULL""",
    "crimes_gold_daily": f"""
WITH {_CRIMES}
SELECT *, round(arrest_count / incident_count, 4) AS arrest_rate FROM cgold""",
    "crimes_weather_mart": f"""
WITH {_CRIMES}, {_WEATHER_FLAT}
SELECT c.occurred_date, CAST(SUM(c.incident_count) AS BIGINT) AS incidents,
       ANY_VALUE(w.temp_avg_c) AS temp_avg_c, ANY_VALUE(w.precip_total_mm) AS precip_total_mm
FROM cgold c
LEFT JOIN wgold w ON w.city = 'chicago' AND w.observed_date = c.occurred_date
GROUP BY c.occurred_date""",
    "iucr_dimension": f"""
WITH {_CRIMES}, {_IUCR}
SELECT * FROM idim1""",
    "station_windows": """
WITH ev AS (
  SELECT 'S' || lpad(CAST(user_id AS VARCHAR), CAST(greatest(length(CAST(user_id AS VARCHAR)), 4) AS INTEGER), '0') AS station_id, event_type, ts FROM events
),
w AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, station_id, event_type,
         COUNT(*) AS event_count
  FROM ev GROUP BY 1, 2, 3
)
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, station_id, event_type,
       event_count
FROM w
WHERE window_start + INTERVAL '10 minutes' <= (SELECT max(ts) FROM events) - INTERVAL '15 minutes'""",
})


ORACLE_SQL["windows_stream_late"] = """
WITH marks AS (
  SELECT (SELECT max(ts) FROM events WHERE event_type <> 'click') - INTERVAL '15 minutes' AS w1,
         greatest((SELECT max(ts) FROM events WHERE event_type <> 'click'),
                  (SELECT max(ts) FROM events)) - INTERVAL '15 minutes' AS w2
),
b AS (
  SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, event_type FROM events
  WHERE event_id IS NOT NULL AND ts IS NOT NULL
),
accepted AS (
  SELECT b.* FROM b, marks
  WHERE b.event_type <> 'click' OR b.window_start + INTERVAL '10 minutes' > marks.w1
),
w AS (
  SELECT window_start, event_type, COUNT(*) AS event_count FROM accepted GROUP BY 1, 2
)
SELECT window_start, window_start + INTERVAL '10 minutes' AS window_end, event_type, event_count
FROM w, marks
WHERE window_start + INTERVAL '10 minutes' <= marks.w2"""


ORACLE_SQL["crimes_silver_published"] = f"""
WITH {_CRIMES}
SELECT {_CSILVER_COLS} FROM cgood"""

ORACLE_SQL["weather_silver_published"] = f"""
WITH {_WEATHER_FLAT}
SELECT * FROM wsilver"""

ORACLE_SQL["crimes_weather_mart_published"] = ORACLE_SQL["crimes_weather_mart"]

ORACLE_SQL["replace_slice_table"] = ORACLE_SQL["replace_slice"]

ORACLE_SQL["page_by_number"] = """
WITH n AS (
  SELECT o_orderkey, o_orderdate, o_custkey,
         row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_ordinal
  FROM orders
)
SELECT *, row_ordinal // 1000 AS page_no FROM n WHERE row_ordinal // 1000 = 3"""

ORACLE_SQL["quarantine_sink"] = f"""
SELECT q.*, r._run_id FROM ({ORACLE_SQL["dq_quarantine"]}) q, (VALUES ('run-a'), ('run-b')) r(_run_id)"""

ORACLE_SQL["quality_gates"] = f"""
WITH m AS (SELECT max(total_rows) AS total, max(passed_rows) AS passed FROM ({ORACLE_SQL["dq_summary"]})),
lines AS (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'pass_rate_95' AS gate, CASE WHEN passed >= 0.95 * total THEN 'open' ELSE 'shut' END AS outcome FROM m
UNION ALL SELECT 'pass_rate_50', CASE WHEN passed >= 0.5 * total THEN 'open' ELSE 'shut' END FROM m
UNION ALL SELECT 'unique_lines', CASE WHEN max(n) = 1 THEN 'open' ELSE 'shut' END FROM lines
UNION ALL SELECT 'unique_orders', CASE WHEN count(DISTINCT l_orderkey) = count(*) THEN 'open' ELSE 'shut' END FROM lineitem"""

ORACLE_SQL["landing_arrays"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(s_nationkey AS VARCHAR) || '-' || CAST(s_suppkey // 1000 AS VARCHAR) AS batch_id, '2024-01-01' AS _ingest_date
FROM supplier"""

ORACLE_SQL["incremental_window_load"] = """
SELECT o_orderkey, o_custkey, o_orderdate, CAST(CAST(DATE '1998-01-02' AS DATE) AS VARCHAR) AS mark
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-06-01' AND DATE '1998-01-01'"""

ORACLE_SQL["stream_schema_drift"] = """
WITH e AS (
  SELECT *, event_type = 'click' AS late,
         coalesce(event_type = 'click' AND value < 50, FALSE) AS broken,
         coalesce(event_type = 'click' AND value >= 350, FALSE) AS undated
  FROM events
)
SELECT event_id, CASE WHEN NOT broken THEN event_type END AS event_type,
       CASE WHEN late AND NOT broken THEN 'new' END AS bike,
       CASE WHEN NOT broken AND NOT undated THEN ts END AS ts,
       broken OR undated AS rescued
FROM e"""
