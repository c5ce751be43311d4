"""The registered queries as plain SQL for an independent engine."""

from __future__ import annotations

from tillmark.plans.catalog import PERIODS, SMALL, STRATEGIES, THRESHOLD
from tillmark.plans.standins import PHRASES

# Written out here once more, so that a wrong pattern in the library shows.
SPAN = 600
MONTHS = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
TYPED = (
    r"\b[A-Za-z]{2,5}[-/][0-9]{4}(-[0-9]{2})?[-/]([A-Z]/)?[0-9]{4,7}\b",
    r"\b[A-Za-z]{2,5}-[0-9]{6}/[0-9]{4}\b",
    r"\b0[0-9]{7}\b",
    r"\b[0-9]{1,2}[-/.][0-9]{1,2}[-/.][0-9]{4}\b",
    r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    r"\b[0-9]{1,2}[- ]" + MONTHS + r"[- ][0-9]{2,4}\b",
    r"\b" + MONTHS + r" [0-9]{1,2}, [0-9]{4}\b",
    r"(?i)\b(rs\.?|inr|rupees)\s*[0-9][0-9,]*(\.[0-9]+)?(\s*(lakh|crore|cr|only)\b)?(/-)?",
    r"\b[0-9]{7,}\b",
)

K, BANDS, ROWS, MODULUS = 400, 20, 20, 2147483647

# Warehouse -----------------------------------------------------------------

STORE = "'S' || lpad(CAST({key} % 12 + 1 AS VARCHAR), 2, '0')"

SALES = f"""
raw_lines AS (
  SELECT {STORE.format(key='l_orderkey')} || '/' || l_orderkey AS bill_no,
    CAST(l_linenumber AS VARCHAR) AS line_no,
    'P' || l_partkey AS product_code,
    CASE WHEN l_quantity = 49 AND l_tax = 0.08 THEN NULL ELSE l_quantity END AS quantity,
    l_extendedprice AS unit_price,
    CASE WHEN l_returnflag = 'N' THEN 'SALE'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'RETURN'
         WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'VOID'
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DISCOUNT'
         WHEN l_linenumber % 2 = 0 THEN 'TENDER' ELSE 'TAX' END AS line_type,
    CASE WHEN l_orderkey % 2 = 0 AND l_quantity = 50 THEN NULL
         ELSE l_shipdate + to_seconds(l_orderkey % 86400) END AS "timestamp",
    l_orderkey % 2 = 0 AS even_order
  FROM lineitem),
sales AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY bill_no, line_no
      ORDER BY "timestamp" DESC NULLS LAST, product_code DESC NULLS LAST, quantity DESC NULLS LAST,
               unit_price DESC NULLS LAST, line_type DESC NULLS LAST) AS rn
    FROM raw_lines) WHERE rn = 1)"""

PRODUCTS = """
products AS (
  SELECT p_partkey * 2 AS product_sk, 'P' || p_partkey AS product_code,
    replace(p_brand, 'Brand#', 'C') AS category_id, DATE '1995-06-01' AS valid_from,
    CASE WHEN p_partkey % 50 = 0 THEN DATE '1998-06-30' WHEN p_partkey % 7 = 0 THEN NULL
         ELSE DATE '9999-12-31' END AS valid_to
  FROM part
  UNION ALL
  SELECT p_partkey * 2 + 1, 'P' || p_partkey, 'C' || (p_size % 25 + 1), DATE '1998-07-01', DATE '9999-12-31'
  FROM part WHERE p_partkey % 50 = 0),
categories AS (SELECT DISTINCT replace(p_brand, 'Brand#', 'C') AS category_id, p_brand AS category_name FROM part)"""

FACT = f"""{SALES}, {PRODUCTS},
fact AS (
  SELECT s.bill_no, s.line_no, split_part(s.bill_no, '/', 1) AS store_id, p.product_sk, s.quantity,
    s.unit_price, s.quantity * s.unit_price AS line_revenue, CAST(s."timestamp" AS DATE) AS business_date,
    s.line_type
  FROM sales s LEFT JOIN products p ON s.product_code = p.product_code
    AND CAST(s."timestamp" AS DATE) >= p.valid_from
    AND (CAST(s."timestamp" AS DATE) <= p.valid_to OR p.valid_to IS NULL)
  WHERE s.line_type IN ('SALE', 'VOID', 'RETURN', 'DISCOUNT'))"""

REVISIONS = """
monthly_price AS (
  SELECT l_partkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS effective_from,
    CAST(max(l_extendedprice) AS DECIMAL(12,2)) AS selling_price
  FROM lineitem GROUP BY 1, 2),
keyed_price AS (
  SELECT *, l_partkey * 2 + CASE WHEN l_partkey % 50 = 0 AND effective_from >= DATE '1998-07-01'
                                 THEN 1 ELSE 0 END AS product_sk
  FROM monthly_price),
revisions AS (
  SELECT product_sk, selling_price, effective_from,
    coalesce(CAST(lead(effective_from) OVER (PARTITION BY product_sk ORDER BY effective_from)
                  - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS effective_to
  FROM keyed_price)"""

FINANCE = """
finance AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders GROUP BY 1)"""

MONTHLY = """
monthly AS (
  SELECT strftime(business_date, '%Y-%m') AS month, sum(CAST(line_revenue AS DECIMAL(24,4))) AS revenue
  FROM fact GROUP BY 1)"""

BY_CATEGORY = """
by_category AS (
  SELECT c.category_name, round(sum(CAST(f.line_revenue AS DECIMAL(24,4))), 2) AS revenue
  FROM fact f JOIN products p ON f.product_sk = p.product_sk
  JOIN categories c ON p.category_id = c.category_id GROUP BY 1)"""

TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"


def _pit(comparison: str) -> str:
    rows = ", ".join(f"('{label}', DATE '{a}', DATE '{b}')" for label, a, b in PERIODS)
    return f"""WITH {FACT}, {REVISIONS}, periods(reporting_period, first_day, last_day) AS (VALUES {rows}),
    totals AS (
      SELECT w.reporting_period, sum(CAST(f.quantity AS DECIMAL(18,2)) * r.selling_price) AS total
      FROM fact f JOIN periods w ON f.business_date BETWEEN w.first_day AND w.last_day
      JOIN revisions r ON f.product_sk = r.product_sk AND f.business_date >= r.effective_from
        AND (f.business_date {comparison} r.effective_to OR r.effective_to IS NULL)
      WHERE f.line_type = 'SALE' GROUP BY 1)
    SELECT reporting_period, CAST(total AS DOUBLE) AS total_historical_revenue
    FROM periods LEFT JOIN totals USING (reporting_period)"""


_RECONCILED_ZERO = f"""{FACT}, {FINANCE}, {MONTHLY},
reconciled AS (
  SELECT f.month, round(f.revenue, 2) AS finance_revenue, round(coalesce(m.revenue, 0), 2) AS pipeline_revenue,
    round(coalesce(m.revenue, 0) - f.revenue, 2) AS variance
  FROM finance f LEFT JOIN monthly m ON f.month = m.month)"""

_STAR_COUNTS = f"""WITH {FACT}
    SELECT 'dim_category' AS table_name, count(*) AS row_count FROM categories
    UNION ALL SELECT 'dim_product', count(*) FROM products
    UNION ALL SELECT 'dim_store', count(DISTINCT o_orderkey % 12) FROM orders
    UNION ALL SELECT 'fact_sales', count(*) FROM fact
    UNION ALL SELECT 'sales_fact', count(*) FROM sales"""

_CHECKSUM = 'SELECT {n} AS times_sent, count(*) AS row_count, CAST(sum(CAST(quantity AS DECIMAL(24,6))) AS DOUBLE) AS check_sum FROM sales'


def _repeated(table: str, keys: str) -> str:
    return f"""SELECT 'primary key' AS "check", '{table}' AS table_name, '{keys}' AS columns, count(*) AS keys,
      CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys} HAVING count(*) > 1)"""


def _orphans(table: str, key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT 'reference', '{table}', '{key}', count(DISTINCT {key}), count({key}) FROM {table}
      WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})"""


def _missing(column: str) -> str:
    return f"""SELECT 'not null', 'sales', '{column}', 0, count(*) FROM sales WHERE "{column}" IS NULL"""


_EVENTS = """WITH raw AS (
      SELECT *, date_trunc('second', ts) AS at_second FROM events),
    texts AS (
      SELECT event_type || '/' || user_id AS bill_no, CAST(event_id AS VARCHAR) AS line_no,
        'E' || user_id AS product_code,
        CASE WHEN event_type = 'error' THEN value || 'd' ELSE CAST(value AS VARCHAR) END AS quantity,
        CAST(value AS VARCHAR) AS unit_price, event_type AS line_type,
        CASE WHEN user_id % 10 = 3 THEN strftime(at_second, '%Y-%m')
             WHEN user_id % 10 = 4 THEN strftime(at_second, '%Y/%m/%d %H:%M:%S')
             WHEN user_id % 2 = 0 THEN strftime(at_second, '%Y-%m-%d %H:%M:%S')
             ELSE CAST(CAST(epoch(at_second) AS BIGINT) AS VARCHAR) END AS at_text
      FROM raw)
    SELECT bill_no, line_no, product_code, TRY_CAST(quantity AS DOUBLE) AS quantity,
      TRY_CAST(unit_price AS DOUBLE) AS unit_price, line_type,
      strftime(CASE WHEN regexp_matches(at_text, '^[0-9]+$')
                    THEN make_timestamp(TRY_CAST(at_text AS BIGINT) * 1000000)
                    ELSE TRY_CAST(at_text AS TIMESTAMP) END, '%Y-%m-%d %H:%M:%S') AS "timestamp"
    FROM texts"""

_WAREHOUSE = {
    "normalise_lines": _EVENTS,
    "dedup_latest": f"""WITH {SALES}
    SELECT bill_no, line_no, product_code, quantity, unit_price, line_type,
      {TIME.format('"timestamp"')} AS "timestamp" FROM sales""",
    "load_checksum": f"WITH {SALES} " + " UNION ALL ".join(_CHECKSUM.format(n=n) for n in (1, 2, 3)),
    "union_by_name": f"""WITH {SALES}
    SELECT bill_no, line_no, product_code, quantity, unit_price, line_type,
      {TIME.format('"timestamp"')} AS "timestamp" FROM raw_lines""",
    "rejected_values": """WITH texts AS (
      SELECT CASE l_orderkey % 10 WHEN 0 THEN '1e30' WHEN 1 THEN 'inf' WHEN 2 THEN 'nan' WHEN 3 THEN 'x' END AS bad_quantity,
        l_orderkey % 11 = 0 AS bad_price, l_orderkey % 13 < 4 AS bad_time, l_quantity, l_extendedprice FROM lineitem)
    SELECT 'quantity' AS columns, CAST(count(bad_quantity) AS DOUBLE) AS rows FROM texts
    UNION ALL SELECT 'unit_price', count(*) FROM texts WHERE bad_price
    UNION ALL SELECT 'timestamp', count(*) FROM texts WHERE bad_time
    UNION ALL SELECT 'kept value', CAST(sum(CAST(l_quantity * l_extendedprice AS DECIMAL(24,4))) AS DOUBLE)
    FROM texts WHERE bad_quantity IS NULL AND NOT bad_price""",
    "land_files": f"""WITH sent AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS year, {STORE.format(key='l_orderkey')} AS store,
        CAST(month(max(l_shipdate)) AS INTEGER) AS month, count(*) AS all_lines,
        count(*) FILTER (l_returnflag <> 'R') AS kept_lines
      FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1, 2),
    marked AS (SELECT *, store = 'S03' AND year = 1995 AS again FROM sent)
    SELECT 1 AS run, year, month, store, 1 AS files, all_lines AS lines FROM marked WHERE year <= 1996
    UNION ALL SELECT 3, year, month, store, 1, CASE WHEN again THEN kept_lines ELSE all_lines END
    FROM marked WHERE year > 1996 OR again
    UNION ALL SELECT 0, year, month, store, 1, CASE WHEN again THEN kept_lines ELSE all_lines END FROM marked""",
    "partition_filter": f"""SELECT o_orderkey, {STORE.format(key='o_orderkey')} AS store, 1996 AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1996-04' AND '1996-06' AND {STORE.format(key='o_orderkey')} = 'S03'""",
    "fallback_files": """SELECT o_orderkey, o_totalprice, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month,
      strftime(o_orderdate, '%Y%m') IN ('199603', '199604') AS from_mirror FROM orders""",
    "swept_prices": f"""WITH {FACT}, {REVISIONS}
    SELECT strftime(business_date, '%Y-%m') AS month, count(*) AS lines, count(selling_price) AS priced,
      CAST(sum(CAST(quantity AS DECIMAL(18,2)) * selling_price) AS DOUBLE) AS list_value
    FROM fact f LEFT JOIN revisions r ON f.product_sk = r.product_sk AND business_date >= effective_from
      AND (business_date <= effective_to OR effective_to IS NULL)
    GROUP BY 1""",
    "finance_file": f"""WITH {FINANCE} SELECT month, CAST(revenue AS DOUBLE) AS revenue_inr FROM finance""",
    "replaced_table": "SELECT o_orderkey, o_totalprice FROM orders",
    "replaced_table_whole": "SELECT o_orderkey, o_totalprice FROM orders",
    "masters_files": f"""WITH {PRODUCTS}, {REVISIONS},
    prices AS (SELECT product_sk, count(*) AS revisions, CAST(max(selling_price) AS DOUBLE) AS highest FROM revisions GROUP BY 1)
    SELECT p.product_sk, product_code, category_name, strftime(valid_from, '%Y-%m-%d') AS valid_from, revisions, highest
    FROM products p LEFT JOIN categories USING (category_id) LEFT JOIN prices ON p.product_sk = prices.product_sk""",
    "federated_files": f"""WITH {SALES}, {PRODUCTS}
    SELECT c.category_name, CAST(sum(CAST(r.quantity * r.unit_price AS DECIMAL(24,4))) AS DOUBLE) AS total_revenue
    FROM raw_lines r JOIN products p ON r.product_code = p.product_code
    JOIN categories c ON p.category_id = c.category_id WHERE r.even_order GROUP BY 1""",
    "land_partitions": f"""WITH names AS (
      SELECT DISTINCT {STORE.format(key='o_orderkey')} AS store, CAST(o_orderdate AS DATE) AS day,
        o_orderkey % 3 = 0 AS columnar
      FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, store, count(*) AS files,
      strftime(min(day), '%Y-%m-%d') AS first_day, strftime(max(day), '%Y-%m-%d') AS last_day
    FROM names GROUP BY 1, 2, 3""",
    "validity_join": f"""WITH {FACT}
    SELECT bill_no, line_no, product_sk, strftime(business_date, '%Y-%m-%d') AS business_date FROM fact""",
    "validity_join_gaps": f"""WITH {FACT}
    SELECT strftime(business_date, '%Y-%m') AS month, count(*) AS lines
    FROM fact WHERE product_sk IS NULL GROUP BY 1""",
    "star_fact": f"""WITH {FACT}
    SELECT bill_no, line_no, store_id, product_sk, quantity, unit_price, line_revenue,
      strftime(business_date, '%Y-%m-%d') AS business_date, dayname(business_date) AS day_of_week,
      monthname(business_date) AS sales_month, line_type FROM fact""",
    "pit_revenue_halfopen": _pit("<"),
    "pit_revenue_closed": _pit("<="),
    "monthly_reconcile": f"""WITH {FACT}, {FINANCE}, {MONTHLY}
    SELECT f.month, CAST(f.revenue AS DOUBLE) AS finance_revenue, CAST(m.revenue AS DOUBLE) AS pipeline_revenue,
      CAST(m.revenue - f.revenue AS DOUBLE) AS variance
    FROM finance f LEFT JOIN monthly m ON f.month = m.month ORDER BY 1""",
    "monthly_reconcile_zero": f"""WITH {_RECONCILED_ZERO}
    SELECT month, CAST(finance_revenue AS DOUBLE) AS finance_revenue,
      CAST(pipeline_revenue AS DOUBLE) AS pipeline_revenue, CAST(variance AS DOUBLE) AS variance
    FROM reconciled ORDER BY 1""",
    "avg_variance": f"""WITH {_RECONCILED_ZERO}
    SELECT count(variance) AS months, round(CAST(sum(variance) AS DOUBLE) / count(variance), 2) AS avg_variance
    FROM reconciled""",
    "kpis": f"""WITH {FACT}
    SELECT count(*) AS fact_rows, CAST(sum(CAST(line_revenue AS DECIMAL(24,4))) AS DOUBLE) AS pipeline_revenue,
      count(DISTINCT store_id) AS stores, count(DISTINCT product_sk) AS products FROM fact""",
    "category_topk": f"""WITH {FACT}, {BY_CATEGORY}
    SELECT category_name, CAST(revenue AS DOUBLE) AS revenue FROM by_category
    ORDER BY by_category.revenue DESC, category_name LIMIT 8""",
    "share_of_max": f"""WITH {FACT}, {BY_CATEGORY}
    SELECT category_name, CAST(revenue AS DOUBLE) AS revenue,
      round(CAST(revenue AS DOUBLE) / (SELECT CAST(max(revenue) AS DOUBLE) FROM by_category), 6) AS share
    FROM by_category""",
    "federated_category": f"""WITH {SALES}, {PRODUCTS}
    SELECT c.category_name, CAST(sum(CAST(r.quantity * r.unit_price AS DECIMAL(24,4))) AS DOUBLE) AS total_revenue
    FROM raw_lines r JOIN products p ON r.product_code = p.product_code
    JOIN categories c ON p.category_id = c.category_id WHERE r.even_order GROUP BY 1""",
    "federated_category_validity": f"""WITH {SALES}, {PRODUCTS}
    SELECT c.category_name, CAST(sum(CAST(s.quantity * s.unit_price AS DECIMAL(24,4))) AS DOUBLE) AS total_revenue
    FROM sales s JOIN products p ON s.product_code = p.product_code
      AND CAST(s."timestamp" AS DATE) >= p.valid_from
      AND (CAST(s."timestamp" AS DATE) <= p.valid_to OR p.valid_to IS NULL)
    JOIN categories c ON p.category_id = c.category_id GROUP BY 1""",
    "key_violations": f"WITH {SALES} " + " UNION ALL ".join(
        [
            _repeated("lineitem", "l_orderkey,l_linenumber"),
            _repeated("orders", "o_orderkey"),
            _repeated("part", "p_partkey"),
            _orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
            _orphans("lineitem", "l_partkey", "part", "p_partkey"),
            _orphans("orders", "o_custkey", "customer", "c_custkey"),
            _orphans("customer", "c_nationkey", "nation", "n_nationkey"),
            *[_missing(c) for c in ("bill_no", "quantity", "timestamp")],
        ]
    ),
    "table_inventory": _STAR_COUNTS + " ORDER BY 1",
    "dashboard_json": f"""WITH {_RECONCILED_ZERO}, {BY_CATEGORY},
    top AS (SELECT * FROM by_category ORDER BY by_category.revenue DESC, category_name LIMIT 8),
    inventory AS ({_STAR_COUNTS.removeprefix(f"WITH {FACT}")})
    SELECT CAST(to_json({{
      'kpis': (SELECT {{'fact_rows': count(*), 'pipeline_revenue': sum(CAST(line_revenue AS DECIMAL(24,4))),
                       'stores': count(DISTINCT store_id), 'products': count(DISTINCT product_sk)}} FROM fact),
      'monthly': (SELECT list({{'month': month, 'finance': finance_revenue, 'pipeline': pipeline_revenue,
                               'variance': variance}} ORDER BY month) FROM reconciled),
      'categories': (SELECT list({{'name': category_name, 'revenue': revenue}}
                               ORDER BY top.revenue DESC, category_name) FROM top),
      'tables': (SELECT list({{'name': table_name, 'rows': row_count}} ORDER BY table_name) FROM inventory)
    }}) AS VARCHAR) AS payload""",
}

# Notices -------------------------------------------------------------------


def _mask(text: str) -> str:
    return f"regexp_replace({text}, '\\p{{Nd}}+', '<NUM>', 'g')"


def _strip(text: str) -> str:
    for phrase in PHRASES:
        text = f"replace({text}, '{phrase}', '')"
    return text


def _wipe(text: str) -> str:
    hits = " OR ".join(f"contains(lower({text}), lower('{p}'))" for p in PHRASES)
    return f"CASE WHEN {hits} THEN '' ELSE {text} END"


def _block(text: str) -> str:
    for phrase in PHRASES:
        start = "(?is)" + phrase.replace(".", "\\.").replace(",", "\\,")
        text = f"regexp_replace({text}, '{start}(?:.{{0,{SPAN}}}?\\n[ \\t]*\\n)?', '', 'g')"
    return text


def _footer(text: str) -> str:
    for phrase in ("DISCLAIMER", "This is a system generated notice"):
        text = f"regexp_replace({text}, '(?is){phrase}.*', '', 'g')"
    return text


def _typed(text: str) -> str:
    for pattern in TYPED:
        text = f"regexp_replace({text}, '{pattern}', '<NUM>', 'g')"
    return text


_CLEANED = {
    "raw": "text",
    "strip_then_mask": _mask(_strip("text")),
    "mask_then_strip": _strip(_mask("text")),
    "greedy_block": _wipe(_mask("text")),
    "block": _mask(_block("text")),
    "block_and_footer": _mask(_footer(_block("text"))),
    "typed": f"regexp_replace({_mask(_typed(_strip('text')))}, '[[:punct:]]', '', 'g')",
}


def _grams(strategy: str = "mask_then_strip", name: str = "grams") -> str:
    return f"""
{name}_chars AS (SELECT doc_id AS notice_id, string_split(lower({_CLEANED[strategy]}), '') AS c FROM documents),
{name} AS (
  SELECT DISTINCT notice_id, c[i] || c[i + 1] || c[i + 2] AS gram
  FROM (SELECT notice_id, c, unnest(range(1, len(c) - 1)) AS i FROM {name}_chars))"""


_SLOTS = ", ".join(f"min(({i + 1} * base + {137 * i}) % {MODULUS})" for i in range(K))

SIGNATURES = f"""{_grams()},
bases AS (SELECT notice_id, CAST('0x' || substr(md5(gram), 1, 8) AS BIGINT) AS base FROM grams),
filled AS (SELECT notice_id, [{_SLOTS}] AS signature FROM bases GROUP BY notice_id),
signatures AS (
  SELECT d.doc_id AS notice_id, coalesce(f.signature, list_transform(range({K}), lambda i: {MODULUS})) AS signature
  FROM documents d LEFT JOIN filled f ON d.doc_id = f.notice_id)"""

BUCKETS = f"""{SIGNATURES},
buckets AS (
  SELECT CAST(band_id AS INTEGER) AS band_id, notice_id,
    md5('(' || array_to_string(list_transform(signature[band_id * {ROWS} + 1 : (band_id + 1) * {ROWS}],
      lambda v: CASE WHEN v = {MODULUS} THEN 'inf' ELSE CAST(v AS VARCHAR) END), ', ') || ')') AS bucket_hash
  FROM signatures, range({BANDS}) r(band_id)),
sizes AS (SELECT band_id, bucket_hash, count(*) AS size FROM buckets GROUP BY ALL)"""

LABELS = """
folded AS (SELECT doc_id AS notice_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS fold FROM documents),
first_of AS (SELECT fold, min(notice_id) AS head FROM folded GROUP BY fold),
labels_ AS (
  SELECT head AS notice_id_a, notice_id AS notice_id_b, 'same' AS label
  FROM folded JOIN first_of USING (fold) WHERE notice_id <> head
  UNION ALL
  SELECT a.notice_id, b.notice_id, 'different'
  FROM folded a JOIN folded b ON a.notice_id + 1 = b.notice_id WHERE a.fold <> b.fold)"""


def _scored(pairs: str, grams: str = "grams", name: str = "scored") -> str:
    """Exact similarity of the rows of ``pairs``."""
    return f"""
{name}_lists AS (
  SELECT d.doc_id AS notice_id, coalesce(list(gram) FILTER (gram IS NOT NULL), []) AS all_grams
  FROM documents d LEFT JOIN {grams} g ON d.doc_id = g.notice_id GROUP BY 1),
{name}_sets AS (
  SELECT p.*, len(a.all_grams) + len(b.all_grams) AS n, len(list_intersect(a.all_grams, b.all_grams)) AS shared
  FROM {pairs} p JOIN {name}_lists a ON p.notice_id_a = a.notice_id JOIN {name}_lists b ON p.notice_id_b = b.notice_id),
{name} AS (
  SELECT * EXCLUDE (n, shared), CASE WHEN n = 0 THEN 0.0 ELSE shared / CAST(n - shared AS DOUBLE) END AS jaccard
  FROM {name}_sets)"""


_ESTIMATED = """
estimated AS (
  SELECT p.*, len(list_filter(list_zip(a.signature, b.signature), lambda z: z[1] = z[2])) / 400.0::DOUBLE AS estimate
  FROM scored p JOIN signatures a ON p.notice_id_a = a.notice_id JOIN signatures b ON p.notice_id_b = b.notice_id)"""


def _candidates(limit: int) -> str:
    return f"""
sparse AS (SELECT b.* FROM buckets b JOIN sizes USING (band_id, bucket_hash) WHERE size BETWEEN 2 AND {limit}),
pairs AS (
  SELECT DISTINCT a.notice_id AS notice_id_a, b.notice_id AS notice_id_b FROM sparse a JOIN sparse b
  ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.notice_id < b.notice_id)"""


def _mixed(limit: int) -> str:
    return f"""WITH {BUCKETS}, {_candidates(limit)}
    SELECT 'pair' AS kind, notice_id_a, notice_id_b, CAST(NULL AS INTEGER) AS band_id,
      CAST(NULL AS VARCHAR) AS bucket_hash FROM pairs
    UNION ALL
    SELECT 'member', notice_id, NULL, band_id, bucket_hash
    FROM buckets JOIN sizes USING (band_id, bucket_hash) WHERE size > {limit}"""


def _hits(limit: int) -> str:
    return f"""
hits AS (
  SELECT p.notice_id_a, p.notice_id_b, p.label, count(b.band_id) AS shared_buckets,
    count(CASE WHEN s.size <= {limit} THEN 1 END) AS kept_buckets
  FROM labels_ p JOIN buckets a ON p.notice_id_a = a.notice_id
  LEFT JOIN buckets b ON p.notice_id_b = b.notice_id AND a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash
  LEFT JOIN sizes s ON b.band_id = s.band_id AND b.bucket_hash = s.bucket_hash
  GROUP BY ALL)"""


def _evaluation() -> str:
    parts = [f"{_grams(s, 'g_' + s)}, {_scored('labels_', 'g_' + s, 'v_' + s)}" for s in STRATEGIES]
    union = " UNION ALL ".join(f"SELECT '{s}' AS strategy, label, jaccard FROM v_{s}" for s in STRATEGIES)
    return f"""WITH {LABELS}, {', '.join(parts)}, scores AS ({union}),
    summary AS (
      SELECT strategy,
        count(*) FILTER (label = 'same') AS same_pairs, avg(jaccard) FILTER (label = 'same') AS same_avg,
        min(jaccard) FILTER (label = 'same') AS same_min, max(jaccard) FILTER (label = 'same') AS same_max,
        count(*) FILTER (label = 'different') AS different_pairs,
        avg(jaccard) FILTER (label = 'different') AS different_avg,
        min(jaccard) FILTER (label = 'different') AS different_min,
        max(jaccard) FILTER (label = 'different') AS different_max
      FROM scores GROUP BY strategy)
    SELECT * REPLACE (round(same_avg, 6) AS same_avg, round(different_avg, 6) AS different_avg),
      same_avg < different_avg AS inverted FROM summary"""


_FIRST = """
firsts AS (
  SELECT notice_id_a, notice_id_b, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY notice_id_a, notice_id_b) AS rn FROM labels_)
  WHERE rn = 1)"""

_NOTICES = {
    **{
        f"clean_{s}": f"""SELECT doc_id AS notice_id, length(body) AS characters, md5(body) AS digest
    FROM (SELECT doc_id, {expression} AS body FROM documents)"""
        for s, expression in _CLEANED.items()
    },
    "trigram_counts": f"""WITH {_grams()}
    SELECT d.doc_id AS notice_id, CAST(count(gram) AS INTEGER) AS trigrams,
      CAST(coalesce(sum(CAST('0x' || substr(md5(gram), 1, 8) AS BIGINT)), 0) AS BIGINT) AS hash_sum
    FROM documents d LEFT JOIN grams g ON d.doc_id = g.notice_id GROUP BY 1""",
    "labelled_pairs": f"WITH {LABELS} SELECT * FROM labels_",
    "first_pairs": f"WITH {LABELS}, {_FIRST} SELECT * FROM firsts",
    "peek": f"""WITH {LABELS}, {_FIRST}
    SELECT doc_id AS notice_id, CAST(length(text) AS INTEGER) AS length, substr(text, 1, 500) AS opening
    FROM documents WHERE doc_id IN (SELECT notice_id_a FROM firsts UNION SELECT notice_id_b FROM firsts)""",
    "jaccard_pairs": f"WITH {LABELS}, {_grams()}, {_scored('labels_')} SELECT * FROM scored",
    "evaluate_metric": _evaluation(),
    "minhash_signature": f"""WITH {SIGNATURES}
    SELECT notice_id, CAST(list_sum(signature) AS BIGINT) AS slot_sum, CAST(signature[1] AS BIGINT) AS first_slot,
      CAST(signature[{K}] AS BIGINT) AS last_slot FROM signatures""",
    "minhash_error": f"""WITH {LABELS}, {SIGNATURES}, {_scored('labels_')}, {_ESTIMATED}
    SELECT *, round(abs(jaccard - estimate) * 100, 6) AS error_pct,
      abs(jaccard - estimate) * 100 <= 5.0 AS within_bound FROM estimated""",
    "lsh_buckets": f"WITH {BUCKETS} SELECT band_id, bucket_hash, notice_id FROM buckets",
    "lsh_candidates": _mixed(50),
    "lsh_candidates_dense": _mixed(SMALL),
    "lsh_stats": f"""WITH {BUCKETS},
    pairs AS (
      SELECT DISTINCT a.notice_id AS x, b.notice_id AS y FROM buckets a JOIN buckets b
      ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.notice_id < b.notice_id),
    counted AS (
      SELECT (SELECT count(*) FROM documents) AS notices, (SELECT count(*) FROM pairs) AS candidate_pairs,
        (SELECT count(*) FROM sizes WHERE size > 50) AS dense_buckets)
    SELECT *, notices * (notices - 1) // 2 AS possible_pairs,
      round(100 * (1 - candidate_pairs / CAST(notices * (notices - 1) // 2 AS DOUBLE)), 6) AS reduction_pct
    FROM counted""",
    "bucket_histogram": f"""WITH {BUCKETS}
    SELECT band_id, size, count(*) AS buckets FROM sizes GROUP BY ALL""",
    "pair_volume": f"""WITH {BUCKETS}
    SELECT band_id, count(*) AS colliding_buckets, count(*) FILTER (size > {SMALL}) AS dense_buckets,
      CAST(sum(size * (size - 1) // 2) AS BIGINT) AS pairs,
      CAST(sum(CASE WHEN size > {SMALL} THEN 0 ELSE size * (size - 1) // 2 END) AS BIGINT) AS pairs_after_pruning
    FROM sizes WHERE size > 1 GROUP BY 1""",
    "prune_dense": f"""WITH {BUCKETS}, {_candidates(SMALL)} SELECT band_id, bucket_hash, notice_id FROM sparse""",
    "pruning_recall": f"""WITH {LABELS}, {BUCKETS}, {_hits(SMALL)},
    counted AS (
      SELECT count(*) AS same_pairs, count(*) FILTER (shared_buckets > 0) AS found_before,
        count(*) FILTER (kept_buckets > 0) AS found_after FROM hits WHERE label = 'same')
    SELECT *, CAST(found_before AS DOUBLE) / same_pairs AS recall_before,
      CAST(found_after AS DOUBLE) / same_pairs AS recall_after,
      100 * (CAST(found_before AS DOUBLE) / same_pairs - CAST(found_after AS DOUBLE) / same_pairs) AS recall_loss_pct
    FROM counted""",
    "bucket_lookup": f"""WITH {LABELS}, {BUCKETS}
    SELECT a.notice_id AS query_id, b.notice_id AS match_id, count(*) AS bands FROM buckets a
    JOIN buckets b ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND b.notice_id <> a.notice_id
    WHERE a.notice_id IN (SELECT notice_id_a FROM labels_ WHERE label = 'same') GROUP BY ALL""",
    "verify_candidates": f"""WITH {BUCKETS},
    folds AS (SELECT notice_id, md5(string_agg(gram, '' ORDER BY gram)) AS fold FROM grams GROUP BY 1),
    heads AS (SELECT fold, min(notice_id) AS head FROM folds GROUP BY 1),
    own AS (SELECT b.* FROM buckets b JOIN heads ON b.notice_id = head),
    pairs AS (
      SELECT DISTINCT a.notice_id AS notice_id_a, b.notice_id AS notice_id_b FROM own a JOIN own b
      ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.notice_id < b.notice_id),
    {_scored('pairs')}
    SELECT 'pair' AS kind, notice_id_a, notice_id_b, jaccard FROM scored WHERE jaccard >= {THRESHOLD}
    UNION ALL
    SELECT 'member', head, notice_id, 1.0 FROM folds JOIN heads USING (fold) WHERE notice_id <> head""",
    "near_groups": f"""WITH RECURSIVE {BUCKETS},
    pairs AS (
      SELECT DISTINCT a.notice_id AS notice_id_a, b.notice_id AS notice_id_b FROM buckets a JOIN buckets b
      ON a.band_id = b.band_id AND a.bucket_hash = b.bucket_hash AND a.notice_id < b.notice_id),
    {_scored('pairs')},
    near AS (SELECT notice_id_a AS x, notice_id_b AS y FROM scored WHERE jaccard >= {THRESHOLD}),
    both_ways AS (SELECT x, y FROM near UNION ALL SELECT y, x FROM near),
    reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
    linked AS (SELECT x, count(*) AS links FROM both_ways GROUP BY 1)
    SELECT r.x AS notice_id, min(r.y) AS group_id, coalesce(any_value(links), 0) AS links
    FROM reach r LEFT JOIN linked l ON r.x = l.x GROUP BY 1""",
    "s_curve": f"""WITH {LABELS}, {BUCKETS}, {_hits(50)}, {_scored('hits')}
    SELECT notice_id_a, notice_id_b, label, round(1 - pow(1 - pow(jaccard, 20), 20), 6) AS b20_r20,
      round(1 - pow(1 - pow(jaccard, 8), 50), 6) AS b50_r8, shared_buckets > 0 AS is_candidate FROM scored""",
    "notices_load": """SELECT CAST(doc_id AS VARCHAR) AS notice_id, source AS portal_id,
      CASE WHEN doc_id % 10 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS published_at,
      md5(trim(regexp_replace(CASE WHEN doc_id % 10 = 0 THEN 'AMENDED ' ELSE '' END || text, '\\s+', ' ', 'g'))) AS digest
    FROM documents""",
    "stored_lookup": f"""WITH {LABELS}, {BUCKETS},
    asked AS (SELECT DISTINCT band_id, bucket_hash FROM buckets
      WHERE notice_id IN (SELECT notice_id_a FROM labels_ WHERE label = 'same'))
    SELECT band_id, bucket_hash, count(*) AS notices, min(notice_id) AS first_id
    FROM buckets SEMI JOIN asked USING (band_id, bucket_hash) GROUP BY ALL""",
    "stored_lookup_bands": f"""WITH {LABELS}, {BUCKETS},
    asked AS (SELECT DISTINCT band_id, bucket_hash FROM buckets
      WHERE notice_id IN (SELECT notice_id_a FROM labels_ WHERE label = 'same'))
    SELECT band_id, bucket_hash, notice_id FROM buckets SEMI JOIN asked USING (band_id, bucket_hash)""",
    "portal_volume": """SELECT source AS portal_id, count(*) AS notices FROM documents
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
}

ORACLES = {**_WAREHOUSE, **_NOTICES}
