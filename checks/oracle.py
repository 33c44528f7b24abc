"""DuckDB statements that the registered queries must agree with, row for row."""

from __future__ import annotations

from checks.views import ACCOUNTS, AS_OF, AS_OF_INSIDE, CUT_HOURS, CUT_START, CUTS, YEAR_STATUS
from tallyshelf.columns import INVENTORY_REPORT, ORDERS_REPORT

AMOUNT = "DECIMAL(18,4)"
ACCOUNT_ROWS = "(VALUES " + ", ".join(f"('{a}')" for a in ACCOUNTS) + ") AS accounts(account_name)"
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey"
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: str) -> str:
    """Text to amount: missing is 0, other text that is no number is NULL."""
    return (
        f"CASE WHEN {c} IS NULL OR {c} IN ('', 'nan') THEN 0 "
        f"WHEN regexp_matches({c}, '{NUMBER}') THEN CAST(TRY_CAST(trim({c}) AS DOUBLE) AS {AMOUNT}) END"
    )


ORDERS = f"""
o AS (
  SELECT c_mktsegment AS account_name, l_orderkey AS order_id, 'SKU-' || l_partkey AS sku, p_name AS product_name,
         CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) AS instant,
         CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS {AMOUNT}) AS item_price,
         CAST(l_quantity AS {AMOUNT}) AS quantity
  FROM {LINES}
)"""

SMALL = f"""
o AS (
  SELECT 'ord-' || l_orderkey AS account_name, 'SKU-' || l_partkey AS sku, p_name AS product_name,
         CAST(l_shipdate AS DATE) AS day,
         CAST(CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN -l_extendedprice ELSE l_extendedprice END AS {AMOUNT}) AS item_price,
         CAST(l_quantity AS {AMOUNT}) AS quantity
  FROM {LINES}
)"""

STOCK = f"""
stock AS (
  SELECT account_name, 'SKU-' || p_partkey AS sku, 'B' || p_partkey AS asin, p_name AS product_name,
         CAST(CASE WHEN p_size < 10 THEN 0 ELSE p_size + length(account_name) END AS {AMOUNT}) AS qty
  FROM part CROSS JOIN {ACCOUNT_ROWS} WHERE p_type <> 'PROMO'
)"""

REPEATED = STOCK.replace("stock AS", "once AS", 1) + """,
stock AS (
  SELECT * FROM once UNION ALL SELECT * FROM once
  UNION ALL SELECT account_name, sku, asin, product_name, qty + 1 FROM once
)"""

HOT = STOCK.replace("stock AS", "once AS", 1) + f""",
stock AS (
  SELECT * FROM once
  UNION ALL
  SELECT c_mktsegment, 'SKU-' || hot, 'B' || hot, 'hot', CAST(l_orderkey * 8 + l_linenumber AS {AMOUNT})
  FROM {LINES} CROSS JOIN (SELECT min(p_partkey) AS hot FROM part)
)"""

SUMMED = REPEATED.replace("\nstock AS", "\nthrice AS") + """,
stock AS (SELECT account_name, sku, sum(qty) AS qty FROM thrice GROUP BY ALL)"""

SMALL_STOCK = STOCK.replace("stock AS", "each_account AS", 1) + """,
stock AS (SELECT sku, qty FROM each_account)"""

DIRTY_TEXT = f"""
d AS (
  SELECT c_mktsegment AS account_name, l_orderkey AS order_id, l_linenumber AS line,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE '00' || l_partkey END AS sku,
         CASE WHEN l_linenumber = 5 THEN NULL ELSE p_name END AS product_name,
         CASE l_linenumber WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:59:00-08:00' WHEN 2 THEN 'junk'
              WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T07:59:00+00:00' END AS purchase_date,
         CASE l_linenumber WHEN 1 THEN ' ' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || ' '
              WHEN 2 THEN 'abc' WHEN 3 THEN 'nan' WHEN 4 THEN NULL WHEN 5 THEN '1,234' WHEN 6 THEN '1e3'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_text,
         CASE l_linenumber WHEN 1 THEN '5d' WHEN 2 THEN '-' || CAST(CAST(l_quantity AS INT) AS VARCHAR) WHEN 3 THEN '.5'
              WHEN 4 THEN '' WHEN 6 THEN '1e5d' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity_text
  FROM {LINES}
),
o AS (
  SELECT *, TRY_CAST(split_part(purchase_date, 'T', 1) AS DATE) AS day,
         {number("price_text")} AS item_price, {number("quantity_text")} AS quantity
  FROM d
)"""


ODD = f"""
o AS (
  SELECT c_mktsegment AS account_name, l_orderkey AS order_id, l_linenumber AS line, 'SKU-' || l_partkey AS sku, p_name AS product_name,
         CASE WHEN l_linenumber NOT IN (3, 4) THEN CAST(o_orderdate AS DATE) END AS day,
         CASE l_linenumber WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1890 MINUTES WHEN 2 THEN CAST(o_orderdate AS TIMESTAMP)
              WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN CAST(o_orderdate AS TIMESTAMP)
              ELSE CAST(o_orderdate AS TIMESTAMP) - INTERVAL 510 MINUTES END AS instant,
         CASE l_linenumber WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00-08:00' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T99:00'
              WHEN 3 THEN 'junk' WHEN 4 THEN NULL WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d') || 'Tx'
              ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:30:00+09:00' END AS purchase_date,
         CASE l_linenumber WHEN 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) || '9999999' WHEN 3 THEN '123456789012345.25'
              WHEN 4 THEN '0.000000001' END AS price_text,
         CAST(CASE l_linenumber WHEN 1 THEN CAST('0.00001' AS DECIMAL(27,8))
              WHEN 2 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(27,8)) + CAST('0.01' AS DECIMAL(27,8))
              WHEN 3 THEN CAST('123456789012345.25' AS DECIMAL(27,8)) WHEN 4 THEN CAST('0.00000001' AS DECIMAL(27,8))
              WHEN 5 THEN CAST('-0.00001' AS DECIMAL(27,8)) WHEN 6 THEN CAST('0.00001' AS DECIMAL(27,8))
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(27,8)) END AS DECIMAL(27,8)) AS item_price,
         CAST(l_quantity AS INT) AS quantity
  FROM {LINES}
)"""


def pieces(by: str = "account_name", stock_by: str = "account_name") -> str:
    """Sums, joined rows, totals and statuses of the sales report over `o` and `stock`."""
    on_stock = " AND ".join(f"s.{k} = stock.{k}" for k in [*filter(None, stock_by.split(", ")), "sku"])
    same = " AND ".join(f"r.{k} = g.{k}" for k in by.split(", "))
    return f"""
sums AS (
  SELECT {by}, sku, product_name, coalesce(sum(quantity), 0) AS units, coalesce(sum(item_price), 0) AS revenue
  FROM o WHERE item_price > 0 AND sku IS NOT NULL AND product_name IS NOT NULL GROUP BY ALL
),
gate AS (
  SELECT {by}, min(day) AS first_day, max(day) AS last_day, date_diff('day', min(day), max(day)) AS days,
         CASE WHEN coalesce(sum(item_price), 0) = 0 THEN 'ZERO_REVENUE'
              WHEN count(CASE WHEN item_price > 0 AND sku IS NOT NULL AND product_name IS NOT NULL THEN 1 END) = 0
              THEN 'NO_POSITIVE_SALES' ELSE 'OK' END AS status
  FROM o GROUP BY ALL
),
joined AS (
  SELECT {', '.join('s.' + k for k in by.split(', '))}, s.sku, s.product_name, s.units, s.revenue, coalesce(stock.qty, 0) AS remaining
  FROM sums s LEFT JOIN stock ON {on_stock}
),
fine AS (SELECT r.* FROM joined r JOIN gate g ON {same} WHERE g.status = 'OK'),
totals AS (SELECT {by}, sum(units) AS units, sum(revenue) AS revenue FROM fine GROUP BY ALL)"""


def summary(by: str = "account_name", shown: str | None = None) -> str:
    shown = shown or by
    return f"""
SELECT {shown}, sku, product_name, CAST(units AS DOUBLE) AS units_sold, CAST(revenue AS DOUBLE) AS revenue,
       CAST(remaining AS DOUBLE) AS remaining_units, FALSE AS is_total,
       1 + row_number() OVER (PARTITION BY {by} ORDER BY units DESC, product_name, sku, remaining) AS report_rank
FROM fine
UNION ALL
SELECT {shown}, 'Grand Total', '', CAST(units AS DOUBLE), CAST(revenue AS DOUBLE), NULL, TRUE, 1 FROM totals"""


def index(by: str = "account_name", shown: str | None = None) -> str:
    shown = shown or ", ".join(f"g.{k}" for k in by.split(", "))
    same = " AND ".join(f"t.{k} = g.{k}" for k in by.split(", "))
    units = "CASE WHEN t.units = floor(t.units) THEN CAST(CAST(t.units AS BIGINT) AS VARCHAR) ELSE CAST(CAST(t.units AS DOUBLE) AS VARCHAR) END"
    return f"""
SELECT {shown}, CAST(first_day AS VARCHAR) AS start_date, CAST(last_day AS VARCHAR) AS end_date, CAST(days AS BIGINT) AS days,
       CAST(t.units AS DOUBLE) AS units_sold, CAST(t.revenue AS DOUBLE) AS revenue,
       upper(g.account_name) || ' Sales ' || strftime(first_day, '%m-%d-%Y')
         || CASE WHEN days <= 1 THEN '' ELSE ' through ' || strftime(last_day, '%m-%d-%Y') END
         || ' (' || {units} || ' units, $' || format('{{:,.2f}}', CAST(t.revenue AS DOUBLE)) || ')' AS report_name,
       status
FROM gate g LEFT JOIN totals t ON {same}"""


WINDOW_KEYS = "account_name, start_utc, end_utc"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%dT%H:%M:%S+00:00')"


def eastern(c: str) -> str:
    return f"(CAST({c} AS TIMESTAMP) AT TIME ZONE 'US/Eastern' AT TIME ZONE 'UTC')"


ISO_KEYS = f"account_name, {iso('start_utc')} AS start_utc, {iso('end_utc')} AS end_utc"
ISO_INDEX_KEYS = f"g.account_name, {iso('g.start_utc')} AS start_utc, {iso('g.end_utc')} AS end_utc"

WINDOWS = f"""
ranges AS (
  SELECT c_mktsegment AS account_name, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) + 1 AS last_day
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
),
steps AS (
  SELECT account_name, last_day, CAST(unnest(generate_series(CAST(first_day AS TIMESTAMP), CAST(last_day AS TIMESTAMP), INTERVAL 31 DAYS)) AS DATE) AS day
  FROM ranges
),
windows AS (
  SELECT account_name, {eastern('day')} AS start_utc, {eastern('least(day + 31, last_day)')} AS end_utc
  FROM steps WHERE day < last_day
)"""

WINDOWED = ORDERS.replace("o AS", "every_line AS", 1) + "," + WINDOWS + """,
o AS (
  SELECT e.*, w.start_utc, w.end_utc FROM every_line e JOIN windows w
  ON e.account_name = w.account_name AND e.instant >= w.start_utc AND e.instant < w.end_utc
)"""


def _written(c: str) -> str:
    sep = "CASE l_returnflag WHEN 'R' THEN '/' WHEN 'A' THEN '.' ELSE '-' END"
    return f"month({c}) || {sep} || day({c}) || {sep} || year({c})"


def requests(as_of: str) -> str:
    return f"""
q AS (
  SELECT CASE WHEN l_linenumber = 6 THEN '' ELSE 'c-' || o_custkey END AS account_name,
         CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 5 THEN '13-13-2000' ELSE {_written('o_orderdate')} END AS start_date,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 4 THEN {_written('o_orderdate')} ELSE {_written('l_shipdate')} END AS end_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
parsed AS (
  SELECT *, CAST('{as_of}' AS TIMESTAMP) AS as_of,
         CAST(TRY_STRPTIME(regexp_replace(start_date, '[/.]', '-', 'g'), '%m-%d-%Y') AS DATE) AS start_day,
         CAST(TRY_STRPTIME(regexp_replace(end_date, '[/.]', '-', 'g'), '%m-%d-%Y') AS DATE) AS end_day
  FROM q
),
bounds AS (
  SELECT *, CASE WHEN start_date IS NULL THEN as_of - INTERVAL 1 DAY ELSE {eastern('start_day')} END AS start_utc,
         CASE WHEN end_date IS NULL THEN as_of ELSE {eastern('end_day')} END AS end_utc
  FROM parsed
),
checked AS (
  SELECT *, CASE WHEN account_name = '' THEN 'account_name is missing'
                 WHEN start_utc IS NULL THEN 'start_date is not a date'
                 WHEN end_utc IS NULL THEN 'end_date is not a date'
                 WHEN start_utc >= end_utc THEN 'start_date must be before end_date'
                 WHEN end_utc > as_of THEN 'end_date must not be in the future' END AS basic_error
  FROM bounds
)"""


LOG = f"""
log AS (
  SELECT 'user-' || user_id AS account_name, CAST(event_id AS VARCHAR) AS report_id,
         CASE WHEN value < 25 THEN '{INVENTORY_REPORT}' ELSE '{ORDERS_REPORT}' END AS report_type,
         CASE event_type WHEN 'purchase' THEN 'DONE' WHEN 'error' THEN 'FATAL' WHEN 'signup' THEN 'CANCELLED' ELSE 'IN_PROGRESS' END AS processing_status,
         CASE WHEN value > 50 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS processing_end_time
  FROM events
),
latest AS (
  SELECT account_name, report_type, report_id, processing_end_time FROM log
  WHERE processing_status = 'DONE' AND processing_end_time <> 'unknown'
  QUALIFY row_number() OVER (PARTITION BY account_name, report_type ORDER BY processing_end_time DESC, report_id) = 1
)"""

ON_HAND = """
sold AS (SELECT account_name, sku, sum(quantity) AS sold FROM o GROUP BY ALL),
received AS (
  SELECT account_name, sku, asin, product_name, qty AS on_hand, qty + coalesce(sold, 0) AS received
  FROM stock LEFT JOIN sold USING (account_name, sku)
)"""

ON_HAND_ROWS = """
SELECT account_name, sku, asin, product_name, CAST(on_hand AS DOUBLE) AS on_hand, CAST(received AS DOUBLE) AS received,
       row_number() OVER (PARTITION BY account_name ORDER BY on_hand DESC NULLS LAST, sku, asin, product_name) AS report_rank
FROM received WHERE received > 0"""

RAW_ORDERS = """
SELECT account_name, order_id, sku, product_name AS "{name}", strftime(day, '%Y-%m-%d') || 'T00:00:00+00:00' AS "{date}",
       CAST(item_price AS DOUBLE) AS "{price}", CAST(quantity AS DOUBLE) AS quantity{fmt}
FROM o"""
INTERNAL = dict(name="product_name", date="purchase_date", price="item_price", fmt=", CAST(day AS VARCHAR) AS purchase_date_fmt")
SOURCE = dict(name="product-name", date="purchase-date", price="item-price", fmt="")


def _bars(rows: str, keys: str, columns: tuple[str, ...], product: str) -> str:
    tops = ", ".join(f"max({c}) FILTER ({product}) OVER (PARTITION BY account_name) AS {c}_top" for c in columns)
    bars = ", ".join(
        f"CASE WHEN {product} AND {c} IS NOT NULL AND {c}_top > 1 "
        f"THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({c} - 1) / ({c}_top - 1))) END AS {c}_bar"
        for c in columns
    )
    return f"SELECT {keys}, {bars} FROM (SELECT *, {tops} FROM ({rows}))"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts[:-1]) + parts[-1]


def statements() -> dict[str, str]:
    sales = (ORDERS, STOCK, pieces())
    windowed = (WINDOWED, STOCK, pieces(WINDOW_KEYS))
    summary_keys = "account_name, sku, product_name, units_sold, revenue, remaining_units, is_total, report_rank"
    chunk = 'SELECT account_name, CAST(order_id AS VARCHAR) AS order_id, sku, product_name AS "product-name", strftime(day, \'%Y-%m-%d\') || \'T00:00:00+00:00\' AS "purchase-date", CAST(item_price AS DOUBLE) AS "item-price", CAST(quantity AS DOUBLE) AS quantity'
    chunks = f"""{chunk}, CAST(NULL AS VARCHAR) AS note FROM o
UNION ALL {chunk}, NULL FROM o WHERE item_price > 0
UNION ALL SELECT account_name, NULL, sku, NULL, NULL, NULL, CAST(quantity AS DOUBLE), 'late' FROM o WHERE item_price > 0"""
    window_errors = "CASE WHEN basic_error IS NOT NULL THEN basic_error WHEN epoch_us(end_utc) - epoch_us(start_utc) >= 32 * 86400000000 THEN 'range must not exceed 31 days' END"
    return {
        "sales_report": _with(*sales, summary()),
        "report_index": _with(*sales, index()),
        "raw_data": _with(ORDERS, RAW_ORDERS.format(**INTERNAL)),
        "sales_report_by_window": _with(*windowed, summary(WINDOW_KEYS, ISO_KEYS)),
        "report_index_by_window": _with(*windowed, index(WINDOW_KEYS, ISO_INDEX_KEYS)),
        "window_filter": _with(
            WINDOWED,
            f"\nSELECT account_name, {iso('start_utc')} AS start_utc, {iso('end_utc')} AS end_utc, count(*) AS lines, "
            "CAST(sum(item_price) AS DOUBLE) AS price FROM o GROUP BY ALL",
        ),
        "sales_by_sku": _with(
            *sales, "\nSELECT account_name, sku, product_name, CAST(units AS DOUBLE) AS units_sold, CAST(revenue AS DOUBLE) AS revenue FROM sums"
        ),
        "units_by_sku": _with(ORDERS, "\nSELECT account_name, sku, CAST(sum(quantity) AS DOUBLE) AS sold FROM o GROUP BY account_name, sku"),
        "sku_rollup": _with(ORDERS, """
SELECT account_name, sku, product_name, count(*) AS lines, count(CASE WHEN item_price > 0 THEN 1 END) AS paid_lines,
       CAST(coalesce(sum(item_price), 0) AS DOUBLE) AS price_sum,
       CAST(coalesce(sum(CASE WHEN item_price > 0 THEN quantity END), 0) AS DOUBLE) AS units_sold,
       CAST(coalesce(sum(CASE WHEN item_price > 0 THEN item_price END), 0) AS DOUBLE) AS revenue,
       CAST(min(day) AS VARCHAR) AS start_date, CAST(max(day) AS VARCHAR) AS end_date
FROM o GROUP BY account_name, sku, product_name"""),
        "sales_with_stock": _with(*sales, """
SELECT account_name, sku, product_name, CAST(units AS DOUBLE) AS units_sold, CAST(revenue AS DOUBLE) AS revenue,
       CAST(remaining AS DOUBLE) AS remaining_units, CAST(1 AS BIGINT) AS copies FROM joined"""),
        "sales_totals": _with(*sales, """
SELECT account_name, CAST(units AS DOUBLE) AS units_sold, CAST(revenue AS DOUBLE) AS revenue FROM totals"""),
        "sales_report_repeated_stock": _with(ORDERS, REPEATED, pieces(), summary()),
        "sales_report_hot_stock": _with(ORDERS, HOT, pieces(), summary()),
        "sales_report_summed_stock": _with(ORDERS, SUMMED, pieces(), summary()),
        "sales_report_small_accounts": _with(SMALL, SMALL_STOCK, pieces(stock_by=""), summary()),
        "zero_sales_gate": _with(SMALL, STOCK, pieces(), """
SELECT account_name, CAST(first_day AS VARCHAR) AS start_date, CAST(last_day AS VARCHAR) AS end_date, CAST(days AS BIGINT) AS days, status FROM gate"""),
        "account_coverage": _with(SMALL, STOCK, pieces(), """
SELECT 'ord-' || o_orderkey AS account_name, coalesce(status, 'NO_ORDERS') AS status
FROM orders LEFT JOIN gate ON gate.account_name = 'ord-' || o_orderkey"""),
        "account_dimension": "SELECT DISTINCT c_mktsegment AS account_name FROM customer",
        "on_hand_report": _with(ORDERS, STOCK, ON_HAND, ON_HAND_ROWS),
        "on_hand_repeated_stock": _with(ORDERS, REPEATED, ON_HAND, ON_HAND_ROWS),
        "on_hand_hot_stock": _with(ORDERS, HOT, ON_HAND, ON_HAND_ROWS),
        "on_hand_index": """
SELECT 'c-' || o_custkey AS account_name, 'C-' || o_custkey || ' On Hand ' || strftime(max(o_orderdate), '%m-%d-%Y') AS report_name
FROM orders GROUP BY o_custkey""",
        "clean_orders": _with(DIRTY_TEXT, """
SELECT account_name, order_id, CAST(line AS BIGINT) AS line, sku, product_name, purchase_date,
       CAST(item_price AS DOUBLE) AS item_price, CAST(quantity AS DOUBLE) AS quantity, CAST(day AS VARCHAR) AS purchase_date_fmt
FROM o"""),
        "quarantine": _with(DIRTY_TEXT, """
SELECT account_name, order_id, CAST(line AS BIGINT) AS line, coalesce(sku, 'None') AS sku, coalesce(product_name, '') AS product_name,
       purchase_date, price_text AS item_price, quantity_text AS quantity,
       concat_ws(',', CASE WHEN sku IS NULL THEN 'sku_missing' END, CASE WHEN product_name IS NULL THEN 'product_name_missing' END,
         CASE WHEN day IS NULL THEN 'purchase_date_unreadable' END, CASE WHEN item_price IS NULL THEN 'item_price_unreadable' END,
         CASE WHEN quantity IS NULL THEN 'quantity_unreadable' END) AS reasons
FROM o WHERE sku IS NULL OR product_name IS NULL OR day IS NULL OR item_price IS NULL OR quantity IS NULL"""),
        "dirty_sales_report": _with(DIRTY_TEXT, STOCK, pieces(), summary()),
        "dirty_report_index": _with(DIRTY_TEXT, STOCK, pieces(), index()),
        "chunk_union": _with(ORDERS, "\n" + chunks),
        "dedup_chunks": _with(ORDERS, f"\nSELECT DISTINCT * FROM ({chunks})"),
        "window_validate": _with(requests(AS_OF_INSIDE), f"""
SELECT account_name, start_date, end_date, {iso('start_utc')} AS start_utc, {iso('end_utc')} AS end_utc,
       {iso('start_utc')} AS start_iso, {iso('end_utc')} AS end_iso, {window_errors} AS error FROM checked"""),
        "window_split": _with(requests(AS_OF), f"""
,local AS (
  SELECT *, start_utc AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS local_start, end_utc AT TIME ZONE 'UTC' AT TIME ZONE 'US/Eastern' AS local_end
  FROM checked WHERE basic_error IS NULL
),
steps AS (
  SELECT *, CAST(unnest(range(0, 1 + CAST(floor((epoch_us(local_end) - epoch_us(local_start)) / (31 * 86400000000)) AS BIGINT))) AS BIGINT) AS n FROM local
),
parts AS (
  SELECT account_name, start_date, end_date, n + 1 AS window_no, local_start + INTERVAL 31 DAYS * n AS a,
         least(local_start + INTERVAL 31 DAYS * (n + 1), local_end) AS b, local_end FROM steps
)
SELECT account_name, start_date, end_date, window_no, {iso(eastern('a'))} AS start_utc, {iso(eastern('b'))} AS end_utc FROM parts WHERE a < local_end"""),
        "preset_ranges": f"""
SELECT c_name AS account_name, preset, strftime(CAST('{AS_OF}' AS DATE) - days, '%m-%d-%Y') AS start_date,
       strftime(CAST('{AS_OF}' AS DATE), '%m-%d-%Y') AS end_date
FROM customer CROSS JOIN (VALUES ('today', 0), ('one_month_ago', 30), ('two_months_ago', 60), ('three_months_ago', 90)) AS presets(preset, days)""",
        "latest_ready_report": _with(LOG, """
SELECT account_name, report_type, report_id, replace(processing_end_time, 'Z', '+00:00') AS processing_end_time FROM latest"""),
        "resolve_report": _with(LOG, f"""
SELECT log.*, CASE WHEN processing_status = 'DONE' THEN 'direct' WHEN processing_status NOT IN ('FATAL', 'CANCELLED') THEN 'pending'
                   WHEN latest_id IS NOT NULL THEN 'fallback' ELSE 'failed' END AS resolution,
       CASE WHEN processing_status = 'DONE' THEN report_id WHEN processing_status IN ('FATAL', 'CANCELLED') THEN latest_id END AS resolved_report_id
FROM log LEFT JOIN (SELECT account_name AS a, report_type AS t, report_id AS latest_id FROM latest WHERE report_type = '{INVENTORY_REPORT}')
  ON a = account_name AND t = report_type""").replace("log.*", "account_name, report_id, report_type, processing_status, processing_end_time"),
        "report_log_json": _with(LOG, f"""
SELECT * FROM log UNION ALL SELECT account_name, report_id || '-next', '{ORDERS_REPORT}', 'N/A', NULL FROM log"""),
        "bars": _with(*sales, "\n" + _bars(summary(), summary_keys, ("units_sold", "revenue", "remaining_units"), "NOT is_total")),
        "on_hand_bars": _with(ORDERS, STOCK, ON_HAND, "\n" + _bars(
            ON_HAND_ROWS, "account_name, sku, asin, product_name, on_hand, received, report_rank", ("on_hand", "received"), "TRUE")),
        "display": _with(*sales, f"""
SELECT account_name, report_rank, sku, product_name, format('{{:,.0f}}', units_sold) AS units_sold,
       '$' || format('{{:,.2f}}', revenue) AS revenue, format('{{:,.0f}}', remaining_units) AS remaining_units
FROM ({summary()})"""),
        "flat_file_scan": _with(ORDERS, RAW_ORDERS.format(**INTERNAL).replace("order_id,", "CAST(order_id AS VARCHAR) AS order_id,")),
        "mixed_header_scan": _with(ORDERS, RAW_ORDERS.format(**INTERNAL).replace(
            "order_id,", "CASE WHEN item_price > 0 THEN CAST(order_id AS VARCHAR) END AS order_id,")),
        "csv_scan": _with(STOCK, """
SELECT account_name, sku, asin, product_name AS "product-name", CAST(CAST(qty AS BIGINT) AS VARCHAR) AS "afn-fulfillable-quantity" FROM stock"""),
        "tsv_scan": _with(STOCK, """
SELECT account_name, sku, asin, product_name AS "product-name", CAST(CAST(qty AS BIGINT) AS VARCHAR) AS "afn-fulfillable-quantity" FROM stock"""),
        "json_array_scan": _with(STOCK, """
SELECT account_name, sku, asin, product_name AS "product-name", CAST(CAST(qty AS BIGINT) AS VARCHAR) AS "afn-fulfillable-quantity" FROM stock"""),
        "empty_stock_report": _with(ORDERS, STOCK.replace("WHERE p_type <> 'PROMO'", "WHERE FALSE"), pieces(), summary()),
        "raw_data_small_accounts": _with(SMALL, SMALL_STOCK, pieces(stock_by=""), """
SELECT o.account_name, sku, product_name, CAST(item_price AS DOUBLE) AS item_price, CAST(quantity AS DOUBLE) AS quantity, CAST(day AS VARCHAR) AS purchase_date_fmt
FROM o JOIN gate USING (account_name) WHERE status = 'OK'"""),
        "txt_scan": r"""
SELECT regexp_replace(text, '[\r\n]+', ' ', 'g') AS value, count(*) AS lines FROM conversations GROUP BY 1""",
        "json_records": _with(STOCK, """
SELECT account_name, sku, CASE WHEN qty > 0 THEN asin END AS asin, product_name AS "product-name", CAST(CAST(qty AS BIGINT) AS VARCHAR) AS "afn-fulfillable-quantity" FROM stock"""),
        "json_chunks": _with(STOCK, """
SELECT account_name, sku, asin, product_name AS "product-name", CAST(CAST(qty AS BIGINT) AS VARCHAR) AS "afn-fulfillable-quantity" FROM stock"""),
        "roundtrip_sink": _with(STOCK, """
SELECT account_name, sku, asin, product_name AS "product-name", CAST(qty AS BIGINT) AS "afn-fulfillable-quantity",
       CAST(CASE WHEN account_name < 'F' THEN 2 ELSE 1 END AS BIGINT) AS run FROM stock"""),
        "two_output_report": _with(*sales, """
SELECT account_name, count(*) AS raw_lines, CAST(sum(item_price) AS DOUBLE) AS raw_price,
       CAST(any_value(t.units) AS DOUBLE) AS units_sold, CAST(any_value(t.revenue) AS DOUBLE) AS revenue
FROM o JOIN totals t USING (account_name) GROUP BY account_name"""),
        "daily_job": _daily_job(),
        "dirty_window_filter": _with(ODD, WINDOWS, f"""
SELECT w.account_name, {iso('start_utc')} AS start_utc, {iso('end_utc')} AS end_utc, CAST(line AS BIGINT) AS line, count(*) AS lines
FROM o JOIN windows w ON o.account_name = w.account_name AND instant >= start_utc AND instant < end_utc GROUP BY ALL"""),
        "line_accounting": _with(ODD, """
ranges AS (
  SELECT c_mktsegment AS account_name, CAST(min(o_orderdate) AS DATE) AS first_day,
         CAST(min(o_orderdate) AS DATE) + CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) // 2 AS INT) AS last_day
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
),
placed AS (
  SELECT o.account_name, day, instant >= """ + eastern("first_day") + " AND instant < " + eastern("last_day") + """ AS inside
  FROM o JOIN ranges r ON o.account_name = r.account_name
)""", """
SELECT account_name, count(*) AS landed, count(*) FILTER (inside) AS in_window, count(*) FILTER (day IS NOT NULL AND NOT inside) AS outside,
       count(*) FILTER (day IS NULL) AS undated
FROM placed GROUP BY account_name"""),
        "fine_prices": _with(ODD, """
SELECT account_name, sku, product_name, CAST(sum(quantity) AS DOUBLE) AS units_sold, CAST(sum(item_price) AS VARCHAR) AS revenue
FROM o WHERE item_price > 0 GROUP BY ALL"""),
        "fine_quarantine": _with(ODD, """
SELECT account_name, order_id, CAST(line AS BIGINT) AS line, purchase_date, price_text AS item_price,
       concat_ws(',', CASE WHEN day IS NULL THEN 'purchase_date_unreadable' END, CASE WHEN line IN (2, 4) THEN 'item_price_rounded' END) AS reasons
FROM o WHERE day IS NULL OR line IN (2, 4)"""),
        "job_latest_snapshot": _with(DISTINCT_WINDOWED, STOCK, pieces(WINDOW_KEYS), summary(WINDOW_KEYS, ISO_KEYS)),
        "rerun_job": _rerun_job(),
        "incremental_job": _daily_job(),
        "job_resolved_report": _job_resolved_report(),
        "incremental_summary": _with(DISTINCT_WINDOWED.replace(WINDOWS, CUT_WINDOWS), STOCK, pieces(WINDOW_KEYS), summary(WINDOW_KEYS, ISO_KEYS)),
        "known_lines": _with(ORDERS, """
SELECT CASE WHEN day < DATE '1998-01-01' THEN 1 ELSE 2 END AS landing, account_name, count(*) AS lines FROM (SELECT DISTINCT * FROM o) GROUP BY ALL"""),
        "report_type_dispatch": _with(ORDERS, STOCK, f"""
SELECT kind, account_name, count(*) AS lines
FROM o CROSS JOIN (VALUES ('default'), ('{ORDERS_REPORT}')) AS kinds(kind) GROUP BY ALL
UNION ALL SELECT '{INVENTORY_REPORT}', account_name, count(*) FROM stock GROUP BY account_name"""),
        "ranked_lines": _with(ORDERS, """
SELECT account_name, CAST(item_price AS DOUBLE) AS item_price,
       row_number() OVER (PARTITION BY account_name ORDER BY item_price DESC) AS report_rank FROM o"""),
    }


# Lines that are equal in every column count once.
DISTINCT_WINDOWED = WINDOWED.replace("every_line AS", "landed AS", 1).replace(
    ",\no AS (", ",\nevery_line AS (SELECT DISTINCT * FROM landed),\no AS (")


CUT_WINDOWS = f"""
windows AS (
  SELECT account_name, TIMESTAMP '{CUT_START}' + to_hours({CUT_HOURS} * n) AS start_utc, TIMESTAMP '{CUT_START}' + to_hours({CUT_HOURS} * (n + 1)) AS end_utc
  FROM (SELECT DISTINCT c_mktsegment AS account_name FROM customer), range({CUTS}) AS t(n)
)"""


def _rerun_job() -> str:
    """Accounts before F have free lines only by the second run, so nothing of the first is left but the status of their windows."""
    return _with(DISTINCT_WINDOWED, STOCK, pieces(WINDOW_KEYS), """
kept AS (SELECT * FROM gate WHERE account_name >= 'F'),
made AS (SELECT account_name, start_utc, end_utc FROM kept WHERE status = 'OK')""", """
SELECT 'summary' AS output, account_name, '' AS what, count(*) AS n_rows
FROM (SELECT account_name FROM fine WHERE account_name >= 'F' UNION ALL SELECT account_name FROM made) GROUP BY account_name
UNION ALL SELECT 'raw_data', o.account_name, '', count(*) FROM o JOIN made USING (account_name, start_utc, end_utc) GROUP BY o.account_name
UNION ALL SELECT 'report_index', w.account_name, CASE WHEN g.status IS NULL THEN 'NO_ORDERS' WHEN w.account_name < 'F' THEN 'ZERO_REVENUE' ELSE g.status END AS what, count(*)
FROM windows w LEFT JOIN gate g ON w.account_name = g.account_name AND w.start_utc = g.start_utc AND w.end_utc = g.end_utc GROUP BY ALL""")


def _job_resolved_report() -> str:
    """Lines of the years whose report is ready; the first two years' failures have nothing to fall back to, the stock's has."""
    ready = ", ".join(str(y) for y, status in YEAR_STATUS.items() if status == "DONE")
    left = {"FATAL": "failed", "CANCELLED": "failed", "IN_PROGRESS": "pending"}
    said = ["I1:bound:I1", "I2:bound:I2", "I3:bound:I2"]
    said += [f"R{y}:{left[s]}" if s in left else f"R{y}:{'missing' if y == 2002 else 'bound'}:R{y}" for y, s in YEAR_STATUS.items()]
    landed = DISTINCT_WINDOWED.replace("SELECT DISTINCT * FROM landed", f"SELECT DISTINCT * FROM landed WHERE year(day) IN ({ready})")
    return _with(landed, STOCK, pieces(WINDOW_KEYS), f"""
g AS (SELECT account_name, CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) FILTER (status = 'OK') AS reports
      FROM ({index(WINDOW_KEYS, "g.account_name")}) GROUP BY account_name),
units AS (SELECT account_name, sku, sum(quantity) AS sold FROM every_line GROUP BY ALL),
h AS (SELECT account_name, CAST(sum(qty) AS DOUBLE) AS on_hand FROM stock LEFT JOIN units USING (account_name, sku)
      WHERE qty + coalesce(sold, 0) > 0 GROUP BY account_name)""", f"""
SELECT account_name, revenue, reports, '{" ".join(sorted(said))}' AS bindings, on_hand FROM g JOIN h USING (account_name)""")


def _daily_job() -> str:
    """Windows without orders have a status row."""
    shown = f"w.account_name, {iso('w.start_utc')} AS start_utc, {iso('w.end_utc')} AS end_utc"
    rows = index(WINDOW_KEYS, "g.account_name, g.start_utc, g.end_utc")
    return _with(DISTINCT_WINDOWED, STOCK, pieces(WINDOW_KEYS), f"""
SELECT {shown}, units_sold, revenue, report_name, coalesce(status, 'NO_ORDERS') AS status
FROM windows w LEFT JOIN ({rows}) r ON w.account_name = r.account_name AND w.start_utc = r.start_utc AND w.end_utc = r.end_utc""")
