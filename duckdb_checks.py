"""SQL that DuckDB runs on the same tables to check every query's result."""

RAW = """
nat AS (SELECT n_nationkey, n_name FROM nation),
keyed AS (
  SELECT l.*, o.o_custkey, o.o_orderdate, p.p_name, p.p_retailprice,
         bn.n_name AS buyer_nation, sn.n_name AS seller_nation,
         l.l_orderkey + l.l_partkey + l.l_linenumber AS k,
         CAST(l.l_quantity AS BIGINT) AS q, CAST(p.p_retailprice AS DECIMAL(12,4)) AS price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nat bn ON c.c_nationkey = bn.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nat sn ON s.s_nationkey = sn.n_nationkey
),
once AS (
  SELECT k,
    CASE WHEN l_returnflag = 'R' AND k % 4 = 0 THEN 'C' || CAST(l_orderkey AS VARCHAR)
         WHEN k % 397 = 0 THEN 'A' || CAST(l_orderkey AS VARCHAR)
         ELSE CAST(l_orderkey AS VARCHAR) END AS "InvoiceNo",
    CASE WHEN k % 397 = 0 THEN 'B' WHEN l_partkey % 97 = 0 THEN 'POST'
         ELSE CAST(l_partkey AS VARCHAR) END AS "StockCode",
    CASE WHEN k % 397 = 0 THEN 'Adjust bad debt' WHEN l_partkey % 53 = 0 THEN NULL
         WHEN k % 211 = 0 THEN '   ' WHEN l_linenumber = 7 THEN p_name || ' boxed'
         ELSE p_name END AS "Description",
    CAST(CASE WHEN l_returnflag = 'R' AND k % 4 = 0 THEN -q WHEN k % 397 = 0 THEN 1
         WHEN k % 61 = 0 THEN -q WHEN k % 307 = 0 THEN 0 WHEN k % 503 = 0 THEN -q
         ELSE q END AS BIGINT) AS "Quantity",
    o_orderdate AS "InvoiceDate",
    CAST(CASE WHEN l_returnflag = 'R' AND k % 4 = 0 THEN price WHEN k % 397 = 0 THEN -price
         WHEN k % 61 = 0 OR k % 67 = 0 THEN 0 ELSE price END AS DECIMAL(12,4)) AS "UnitPrice",
    CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE o_custkey * 8 + l_orderkey % 8 END AS "CustomerID",
    CASE WHEN k % 23 = 0 THEN seller_nation ELSE buyer_nation END AS "Country"
  FROM keyed
),
raw AS (
  SELECT * EXCLUDE (k) FROM once UNION ALL SELECT * EXCLUDE (k) FROM once WHERE k % 101 = 0
)
"""

FACT = (
    RAW
    + """,
cleaned AS (
  SELECT trim("InvoiceNo") AS invoice_no, trim("StockCode") AS stock_code,
         COALESCE(trim("Description"), 'UNSPECIFIED') AS description,
         "Quantity" AS quantity, CAST("InvoiceDate" AS TIMESTAMP) AS invoice_date,
         CAST("UnitPrice" AS DECIMAL(18,6)) AS unit_price, CAST("CustomerID" AS BIGINT) AS customer_id, trim("Country") AS country,
         CAST("Description" IS NULL OR trim("Description") = '' AS INT) AS is_missing_description
  FROM raw
),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country
    ORDER BY is_missing_description) AS occurrence
  FROM cleaned
),
flagged AS (
  SELECT *, CAST(round(quantity * unit_price, 4) AS DECIMAL(30,6)) AS line_revenue,
         CAST(occurrence > 1 AS INT) AS is_duplicate,
         CAST(invoice_no LIKE 'C%' AS INT) AS is_cancelled,
         CAST(quantity < 0 AS INT) AS is_negative_quantity, CAST(quantity = 0 AS INT) AS is_zero_quantity,
         CAST(unit_price < 0 AS INT) AS is_negative_price, CAST(unit_price = 0 AS INT) AS is_zero_price,
         CAST(customer_id IS NULL AS INT) AS is_missing_customer
  FROM numbered
),
fact AS (
  SELECT *,
    CAST(quantity > 0 AND unit_price > 0 AND is_cancelled = 0 AND is_duplicate = 0 AS INT) AS is_normal_sale,
    CASE WHEN is_duplicate = 1 THEN 'DUPLICATE' WHEN is_cancelled = 1 THEN 'CANCELLED_INVOICE'
         WHEN unit_price < 0 THEN 'NEGATIVE_PRICE_ADJUSTMENT' WHEN unit_price = 0 THEN 'ZERO_PRICE_ITEM'
         WHEN quantity < 0 THEN 'NEGATIVE_QUANTITY_OTHER' WHEN quantity = 0 THEN 'ZERO_QUANTITY'
         WHEN quantity > 0 AND unit_price > 0 THEN 'NORMAL_SALE' ELSE 'OTHER' END AS transaction_category,
    strftime(invoice_date, '%Y-%m') AS sales_month
  FROM flagged
)
"""
)

SALE = "is_normal_sale = 1"
CANCELLED_KEPT = "is_cancelled = 1 AND is_duplicate = 0"
BAD_DEBT = "is_negative_price = 1 AND is_duplicate = 0"
OTHER_NEGATIVE = "is_negative_quantity = 1 AND is_cancelled = 0 AND is_duplicate = 0"
ZERO_PRICE = "is_zero_price = 1 AND is_negative_quantity = 0 AND is_duplicate = 0"
KEPT = "is_duplicate = 0"
DUPLICATE = "is_duplicate = 1"
FEES = "('POST', 'D', 'M', 'BANK CHARGES', 'PADS', 'DOT', 'CRUK')"


def _with(body: str, base: str = FACT) -> str:
    return f"WITH {base} {body}"


def _money(rows: str) -> str:
    return f"CAST(ROUND(SUM(CASE WHEN {rows} THEN line_revenue ELSE 0 END), 2) AS DOUBLE)"


def _zero_money(rows: str) -> str:
    return f"COALESCE({_money(rows)}, 0.0)"


def _units(rows: str) -> str:
    return f"CAST(SUM(CASE WHEN {rows} THEN quantity ELSE 0 END) AS BIGINT)"


def _count(rows: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {rows}) AS BIGINT)"


def _orders(rows: str) -> str:
    return f"COUNT(DISTINCT CASE WHEN {rows} THEN invoice_no END)"


def _exact(rows: str) -> str:
    return f"SUM(CASE WHEN {rows} THEN line_revenue ELSE 0 END)"


def _hundredths(value: str) -> str:
    """Two decimals, half away from zero, in the same double steps as the queries."""
    half_up = f"CAST(floor(abs({value}) * 100 + 0.5) AS BIGINT)"
    return f"CAST(CASE WHEN {value} < 0 THEN -{half_up} ELSE {half_up} END AS DOUBLE) / 100"


def _share(part: str, whole: str) -> str:
    return _hundredths(f"(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100)")


def _overview() -> str:
    return f"""SELECT COUNT(*) AS total_transaction_lines, {_count(KEPT)} AS non_duplicate_lines,
      {_count(DUPLICATE)} AS duplicate_lines, COUNT(DISTINCT invoice_no) AS total_distinct_invoices,
      {_orders(SALE)} AS sales_invoices, {_orders("is_cancelled = 1")} AS cancellation_invoices,
      {_units(SALE)} AS units_sold, {_units(CANCELLED_KEPT)} AS units_returned,
      {_money(SALE)} AS gross_sales_revenue, {_money(CANCELLED_KEPT)} AS cancellations_revenue_offset,
      {_money(BAD_DEBT)} AS bad_debt_adjustments, {_money(KEPT)} AS net_revenue,
      {_hundredths(f"(CAST({_exact(SALE)} AS DOUBLE) / NULLIF({_orders(SALE)}, 0))")} AS gross_aov_per_sales_order,
      {_hundredths(f"(CAST({_exact(KEPT)} AS DOUBLE) / NULLIF({_orders(KEPT)}, 0))")} AS net_aov_per_distinct_order
      FROM fact"""


def _monthly(where: str = "TRUE") -> str:
    return f"""SELECT sales_month, order_count, units_sold, gross_revenue, returns_offset, net_revenue,
      previous AS prev_month_net_revenue,
      {_hundredths("((net_revenue - previous) / NULLIF(previous, 0) * 100)")} AS mom_growth_percent
      FROM (SELECT *, LAG(net_revenue) OVER (ORDER BY sales_month) AS previous FROM (SELECT strftime(invoice_date, '%Y-%m') AS sales_month, {_orders(SALE)} AS order_count,
        {_units(SALE)} AS units_sold, {_money(SALE)} AS gross_revenue,
        {_money(CANCELLED_KEPT)} AS returns_offset, {_money(KEPT)} AS net_revenue
        FROM fact WHERE {where} GROUP BY 1))"""


def _daily(where: str = "TRUE") -> str:
    return f"""SELECT strftime(invoice_date, '%Y-%m-%d') AS sales_date, {_orders(SALE)} AS order_count,
      {_units(SALE)} AS units_sold, {_units(CANCELLED_KEPT)} AS units_returned,
      {_money(SALE)} AS gross_revenue, {_money(CANCELLED_KEPT)} AS returns_offset,
      {_money(KEPT)} AS net_revenue FROM fact WHERE {where} GROUP BY 1"""


def _moving_average() -> str:
    return f"""SELECT sales_date, order_count, units_sold, units_returned, gross_revenue, returns_offset,
      net_revenue, {_hundredths("mean")} AS net_revenue_7d_ma FROM (SELECT *,
        CAST(SUM(CAST(net_revenue AS DECIMAL(28,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS mean
      FROM ({_daily()}) WINDOW w AS (ORDER BY sales_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


def _first_last() -> str:
    return f"""SELECT * FROM (SELECT *, 'FIRST' AS part FROM ({_daily()}) ORDER BY sales_date LIMIT 5)
      UNION ALL
      SELECT * FROM (SELECT *, 'LAST' AS part FROM ({_daily()}) ORDER BY sales_date DESC LIMIT 5)"""


NAMES = f"""SELECT stock_code, description FROM (
  SELECT stock_code, description,
    ROW_NUMBER() OVER (PARTITION BY stock_code ORDER BY COUNT(*) DESC, description) AS rn
  FROM fact WHERE {SALE} AND description NOT IN ('UNSPECIFIED', '') GROUP BY stock_code, description)
  WHERE rn = 1"""


def _products(order: str, where: str = "TRUE", limit: int = 10) -> str:
    return f"""SELECT t.stock_code, COALESCE(n.description, 'UNSPECIFIED') AS product_name, gross_units_sold,
      units_returned, net_units_sold, gross_revenue, net_revenue, order_count
      FROM (SELECT stock_code, {_units(SALE)} AS gross_units_sold, {_units(CANCELLED_KEPT)} AS units_returned,
        {_units(KEPT)} AS net_units_sold, {_money(SALE)} AS gross_revenue, {_money(KEPT)} AS net_revenue,
        {_orders(SALE)} AS order_count
        FROM fact WHERE stock_code NOT IN {FEES} AND {where} GROUP BY stock_code) t
      LEFT JOIN ({NAMES}) n ON t.stock_code = n.stock_code
      ORDER BY {order} DESC, t.stock_code LIMIT {limit}"""


COUNTRIES = f"""SELECT country, {_orders(SALE)} AS sales_orders,
  COUNT(DISTINCT customer_id) AS identified_customers,
  {_orders(SALE + " AND customer_id IS NULL")} AS guest_orders, {_units(SALE)} AS units_sold,
  {_money(SALE)} AS gross_revenue, {_money(CANCELLED_KEPT)} AS cancellations_offset,
  {_money(KEPT)} AS net_revenue,
  {_share(_exact(KEPT), f"(SELECT SUM(line_revenue) FROM fact WHERE {KEPT})")} AS pct_of_global_net_revenue
  FROM fact GROUP BY country"""


def _share_of_market(top: int) -> str:
    return f"SELECT country, net_revenue FROM ({COUNTRIES}) ORDER BY net_revenue DESC, country LIMIT {top}"


def _customers(limit: int) -> str:
    return f"""SELECT customer_id, MAX(country) AS primary_country, {_orders(SALE)} AS completed_orders,
      {_orders("is_cancelled = 1")} AS cancellation_orders, {_units(SALE)} AS units_purchased,
      {_money(SALE)} AS gross_spend, {_money(CANCELLED_KEPT)} AS returns_refunded,
      {_money(KEPT)} AS net_lifetime_spend,
      CASE WHEN {_orders(SALE)} > 1 THEN 'REPEAT' ELSE 'ONE_TIME' END AS customer_type
      FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id
      ORDER BY net_lifetime_spend DESC, customer_id LIMIT {limit}"""


SPEND = f"""SELECT customer_id, {_orders(SALE)} AS order_count, ROUND({_exact(KEPT)}, 2) AS net_spend
  FROM fact WHERE customer_id IS NOT NULL GROUP BY customer_id"""

SUMMARY = f"""SELECT COUNT(*) AS total_identified_customers,
  {_count("order_count > 1")} AS repeat_customers, {_count("order_count = 1")} AS one_time_customers,
  {_hundredths("(CAST(SUM(net_spend) AS DOUBLE) / COUNT(*))")} AS avg_spend_per_customer,
  {_share(_count("order_count > 1"), "COUNT(*)")} AS repeat_customer_rate_pct FROM ({SPEND})"""

MEDIAN = f"""SELECT {_hundredths("(MEDIAN(CAST(net_spend * 100 AS DOUBLE)) / 100)")} AS approx_median_spend
  FROM ({SPEND})"""


def _anomalies() -> str:
    labels = [
        (
            "Cancelled Invoices (Starts with C)",
            CANCELLED_KEPT,
            "Definitive order cancellation or return initiated by customer",
        ),
        (
            "Other Negative Quantity (Non-Cancelled)",
            OTHER_NEGATIVE,
            "Inventory write-offs, damaged stock, or manual corrections (UnitPrice = 0)",
        ),
        (
            "Negative Price Adjustments (Bad Debt)",
            BAD_DEBT,
            "Accounting ledger adjustment (e.g. Adjust bad debt) rather than item sale",
        ),
        (
            "Zero Price Promotional / Gift Items",
            ZERO_PRICE,
            "Free samples, gifts, or zero-priced line items",
        ),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{label}' AS anomaly_category, COUNT(*) AS record_count,
        COUNT(DISTINCT invoice_no) AS distinct_invoices, CAST(SUM(quantity) AS BIGINT) AS net_units_impact,
        CAST(ROUND(SUM(line_revenue), 2) AS DOUBLE) AS net_revenue_impact, '{behavior}' AS observed_behavior
        FROM fact WHERE {rows}"""
        for label, rows, behavior in labels
    )


def _reconciliation(names: dict[str, str], parts: int, whole: str, total: str, difference: str) -> str:
    amounts = ", ".join(f"COALESCE(ROUND({_exact(rows)}, 2), 0) AS {name}" for name, rows in names.items())
    added = " + ".join(list(names)[:parts])
    published = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)
    return f"""SELECT {published}, CAST({added} AS DOUBLE) AS {total},
      CAST(ROUND(ABS(({added}) - {whole}), 4) AS DOUBLE) AS {difference} FROM (SELECT {amounts} FROM fact)"""


RECONCILIATION = _reconciliation(
    {
        "gross_normal_sales": SALE,
        "cancellations_non_dup": CANCELLED_KEPT,
        "bad_debt_adjustments": BAD_DEBT,
        "other_neg_qty": OTHER_NEGATIVE,
        "duplicate_revenue_excluded": DUPLICATE,
        "net_revenue_non_duplicate": KEPT,
        "total_table_revenue": "TRUE",
    },
    4,
    "net_revenue_non_duplicate",
    "component_sum",
    "discrepancy",
)

_LOAD_MONEY = _reconciliation(
    {
        "gross_normal_sales": SALE,
        "cancelled_returns_non_dup": CANCELLED_KEPT,
        "bad_debt_adjustments": BAD_DEBT,
        "other_neg_qty_adjustments": OTHER_NEGATIVE,
        "duplicate_revenue_excluded": DUPLICATE,
        "net_revenue_non_duplicate": KEPT,
        "total_table_revenue": "TRUE",
    },
    4,
    "net_revenue_non_duplicate",
    "component_sum",
    "discrepancy",
)

LOAD_AUDIT = f"""SELECT * FROM (SELECT COUNT(*) AS total_rows,
  {_count("customer_id IS NULL")} AS missing_customers,
  {_count("is_missing_description = 1")} AS missing_descriptions, {_count(DUPLICATE)} AS duplicates,
  {_count("is_cancelled = 1")} AS cancellations, {_count(SALE)} AS normal_sales,
  {_count("is_negative_quantity = 1")} AS neg_quantities, {_count("is_zero_price = 1")} AS zero_prices,
  {_count("is_negative_price = 1")} AS neg_prices FROM fact) CROSS JOIN ({_LOAD_MONEY})"""

# The financial audit lists all cancellations third, so the parts are named here.
AUDIT_FINANCIALS = f"""SELECT gross_normal_sales, cancelled_returns_offset_non_dup, cancelled_returns_offset_all,
  bad_debt_accounting_adjustments, other_negative_quantity_adjustments, duplicate_revenue_excluded,
  net_revenue_non_duplicate, component_reconciled_sum, reconciliation_difference FROM ({_reconciliation(
    {
        "gross_normal_sales": SALE,
        "cancelled_returns_offset_non_dup": CANCELLED_KEPT,
        "bad_debt_accounting_adjustments": BAD_DEBT,
        "other_negative_quantity_adjustments": OTHER_NEGATIVE,
        "cancelled_returns_offset_all": "is_cancelled = 1",
        "duplicate_revenue_excluded": DUPLICATE,
        "net_revenue_non_duplicate": KEPT,
    },
    4,
    "net_revenue_non_duplicate",
    "component_reconciled_sum",
    "reconciliation_difference",
)})"""


def _kpis(where: str = "TRUE") -> str:
    return f"""SELECT COUNT(*) AS total_rows, {_count(KEPT)} AS non_duplicate_lines,
      COUNT(DISTINCT invoice_no) AS total_invoices, {_orders(SALE)} AS sales_invoices,
      {_orders("is_cancelled = 1")} AS cancel_invoices, COALESCE({_units(SALE)}, 0) AS units_sold,
      COALESCE({_units(CANCELLED_KEPT)}, 0) AS units_returned, {_zero_money(SALE)} AS gross_sales_revenue,
      {_zero_money(CANCELLED_KEPT)} AS cancellations_offset, {_zero_money(BAD_DEBT)} AS bad_debt_adjustments,
      {_zero_money(KEPT)} AS net_revenue, COUNT(DISTINCT customer_id) AS identified_customers,
      COALESCE({_hundredths(f"({_zero_money(SALE)} / NULLIF({_orders(SALE)}, 0))")}, 0.0) AS gross_aov
      FROM fact WHERE {where}"""


FLAGS = [
    "is_duplicate",
    "is_cancelled",
    "is_negative_quantity",
    "is_zero_quantity",
    "is_negative_price",
    "is_zero_price",
    "is_missing_customer",
    "is_missing_description",
    "is_normal_sale",
]
FACT_COLUMNS = [
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
    "line_revenue",
    *FLAGS,
    "transaction_category",
]
RAW_TYPES = {
    "InvoiceNo": "string",
    "StockCode": "string",
    "Description": "string",
    "Quantity": "bigint",
    "InvoiceDate": "timestamp_ntz",
    "UnitPrice": "decimal(12,4)",
    "CustomerID": "bigint",
    "Country": "string",
}


def _rows(columns: list[str], value, source: str) -> str:
    return " UNION ALL ".join(value(column) + f" FROM {source}" for column in columns)


CLEAN = f"""SELECT md5(CAST(to_json([invoice_no, stock_code, description, CAST(quantity AS VARCHAR),
    strftime(invoice_date, '%Y-%m-%d %H:%M:%S.%f'), CAST(unit_price AS VARCHAR), CAST(customer_id AS VARCHAR),
    country]) AS VARCHAR)) || '-0-' || CAST(occurrence AS VARCHAR) AS line_id,
  {", ".join(c for c in FACT_COLUMNS if c not in ("invoice_date", "unit_price", "line_revenue"))},
  strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(line_revenue AS DOUBLE) AS line_revenue, sales_month FROM fact"""


def _raw_anomaly(rule: tuple[str, str]) -> str:
    name, rows = rule
    return (
        f"SELECT '{name}' AS anomaly, {_count(rows)} AS n, {_share(_count(rows), 'COUNT(*)')} AS pct FROM raw"
    )


RAW_ANOMALIES = " UNION ALL ".join(
    _raw_anomaly(rule)
    for rule in [
        ("cancelled_invoices", "\"InvoiceNo\" LIKE 'C%'"),
        ("negative_quantity", '"Quantity" < 0'),
        ("negative_quantity_cancelled", '"Quantity" < 0 AND "InvoiceNo" LIKE \'C%\''),
        ("negative_quantity_not_cancelled", '"Quantity" < 0 AND NOT "InvoiceNo" LIKE \'C%\''),
        ("zero_price", '"UnitPrice" = 0'),
        ("negative_price", '"UnitPrice" < 0'),
        ("missing_customer", '"CustomerID" IS NULL'),
    ]
)

_STATISTICS = {
    "count": "CAST(COUNT({c}) AS DOUBLE)",
    "mean": "AVG(CAST({c} AS DOUBLE))",
    "std": "STDDEV_SAMP(CAST({c} AS DOUBLE))",
    "min": "CAST(MIN({c}) AS DOUBLE)",
    "25%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.25)",
    "50%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.5)",
    "75%": "QUANTILE_CONT(CAST({c} AS DOUBLE), 0.75)",
    "max": "CAST(MAX({c}) AS DOUBLE)",
}
RAW_NUMERIC = " UNION ALL ".join(
    f"""SELECT '{label}' AS statistic, ROUND({sql.format(c='"Quantity"')}, 4) AS quantity,
    ROUND({sql.format(c='"UnitPrice"')}, 4) AS unit_price FROM raw"""
    for label, sql in _STATISTICS.items()
)


def _currency(column: str) -> str:
    return f"""CASE WHEN {column} IS NULL THEN '£0.00' WHEN {column} < 0
      THEN '-£' || format('{{:,.2f}}', abs({column})) ELSE '£' || format('{{:,.2f}}', {column}) END"""


def _number(column: str) -> str:
    return f"COALESCE(format('{{:,}}', CAST({column} AS BIGINT)), '0')"


MONTHLY_DISPLAY = f"""SELECT sales_month AS "Month", order_count AS "Orders",
  {_currency("net_revenue")} AS "Net Revenue",
  CASE WHEN mom_growth_percent IS NULL OR mom_growth_percent = 0 THEN '0.0%'
       ELSE format('{{:+.1f}}%', mom_growth_percent) END AS "MoM Growth" FROM ({_monthly()})"""

PRODUCTS_DISPLAY = f"""SELECT stock_code AS "Stock Code", product_name AS "Product Name",
  {_number("gross_units_sold")} AS "Units Sold", {_number("units_returned")} AS "Units Returned",
  {_number("net_units_sold")} AS "Net Units", {_currency("gross_revenue")} AS "Gross Revenue",
  {_currency("net_revenue")} AS "Net Revenue", order_count AS "Orders" FROM ({_products("gross_revenue")})"""

COUNTRIES_DISPLAY = f"""SELECT country AS "Country", {_number("sales_orders")} AS "Sales Orders",
  {_number("identified_customers")} AS "Identified Customers", {_number("guest_orders")} AS "Guest Orders",
  units_sold AS "Units Sold", {_currency("gross_revenue")} AS "Gross Revenue",
  {_currency("cancellations_offset")} AS "Returns Offset", {_currency("net_revenue")} AS "Net Revenue",
  pct_of_global_net_revenue AS "% Global Revenue"
  FROM (SELECT * FROM ({COUNTRIES}) ORDER BY net_revenue DESC, country LIMIT 15)"""

CUSTOMERS_DISPLAY = f"""SELECT customer_id AS "Customer ID", primary_country AS "Country",
  completed_orders AS "Completed Orders", cancellation_orders AS "Cancellations",
  units_purchased AS "Units Purchased", {_currency("gross_spend")} AS "Gross Spend",
  {_currency("returns_refunded")} AS "Refunds", {_currency("net_lifetime_spend")} AS "Net Lifetime Spend",
  customer_type AS "Segment" FROM ({_customers(20)})"""

ANOMALIES_DISPLAY = f"""SELECT anomaly_category AS "Anomaly Category", {_number("record_count")} AS "Records",
  {_number("distinct_invoices")} AS "Invoices", {_number("net_units_impact")} AS "Net Units Impact",
  {_currency("net_revenue_impact")} AS "Net Revenue Impact", observed_behavior AS "Empirical Observation"
  FROM ({_anomalies()})"""

# The lines of the untidy file as cleaning must see them, told by the key that decides about each line.
TIDIED = (
    RAW.replace(" * EXCLUDE (k)", " *")
    + """,
tidied AS (
  SELECT k, CASE WHEN k % 73 <> 0 THEN "InvoiceNo" END AS invoice_no, "StockCode" AS stock_code,
    CASE WHEN k % 79 = 0 THEN '' ELSE COALESCE(trim("Description"), 'UNSPECIFIED') END AS description,
    CASE WHEN k % 37 <> 0 AND (k % 41 = 0 OR k % 43 = 0) THEN 0 ELSE "Quantity" END AS quantity,
    CASE WHEN k % 71 = 0 THEN NULL
         WHEN k % 29 = 0 THEN date_trunc('day', CAST("InvoiceDate" AS TIMESTAMP))
         WHEN k % 31 = 0 THEN date_trunc('minute', CAST("InvoiceDate" AS TIMESTAMP))
         WHEN k % 19 = 0 THEN date_trunc('day', CAST("InvoiceDate" AS TIMESTAMP))
         ELSE date_trunc('second', CAST("InvoiceDate" AS TIMESTAMP)) END AS invoice_date,
    CASE WHEN k % 47 = 0 THEN 0.0 WHEN k % 83 = 0 THEN 123456789.0 WHEN k % 89 = 0 THEN 0.00001
         ELSE CAST("UnitPrice" AS DOUBLE) END AS unit_price,
    CASE WHEN k % 59 <> 0 THEN CAST("CustomerID" AS BIGINT) END AS customer_id, "Country" AS country,
    CAST(k % 79 = 0 OR "Description" IS NULL OR trim("Description") = '' AS INT) AS is_missing_description
  FROM raw
)
"""
)
UNREADABLE = {
    "Quantity": "k % 41 = 0 AND k % 37 <> 0",
    "InvoiceDate": "k % 71 = 0",
    "UnitPrice": "k % 47 = 0",
    "CustomerID": "k % 59 = 0",
}
INCOMPLETE = {"invoice_no": "k % 73 = 0", "invoice_date": "k % 71 = 0"}

DATES = "strftime(invoice_date, '%Y-%m-%d') BETWEEN '1996-03-15' AND '1997-02-10'"
REQUIRED = [c for c in FACT_COLUMNS if c not in ("description", "customer_id")]

CHECKS = {
    "clean_transactions": _with(CLEAN),
    "category_breakdown": _with(
        f"""SELECT transaction_category, COUNT(*) AS n,
        {_share("COUNT(*)", "(SELECT COUNT(*) FROM fact)")} AS pct FROM fact GROUP BY 1"""
    ),
    "sales_overview": _with(_overview()),
    "monthly_sales": _with(_monthly()),
    "monthly_sales_filtered": _with(_monthly(f"{DATES} AND country = 'NATION_3'")),
    "daily_sales": _with(_daily()),
    "daily_sales_filtered": _with(
        _daily(f"{DATES} AND (stock_code ILIKE '%LD_g%r%' OR description ILIKE '%LD_g%r%')")
    ),
    "daily_moving_average": _with(_moving_average()),
    "daily_first_last": _with(_first_last()),
    "canonical_names": _with(NAMES),
    "top_products_revenue": _with(_products("gross_revenue")),
    "top_products_quantity": _with(_products("gross_units_sold")),
    "top_products_filtered": _with(
        _products(
            "gross_revenue",
            f"{DATES} AND country = 'NATION_3' AND (stock_code ILIKE '%bolt%' OR description ILIKE '%bolt%')",
            25,
        )
    ),
    "country_analysis": _with(COUNTRIES),
    "market_share_top6": _with(_share_of_market(6)),
    "market_share_top10": _with(_share_of_market(10)),
    "customer_analysis": _with(_customers(50)),
    "customer_summary": _with(SUMMARY),
    "customer_median_spend": _with(MEDIAN),
    "returns_and_cancellations": _with(_anomalies()),
    "financial_reconciliation": _with(RECONCILIATION),
    "filtered_kpis": _with(_kpis(f"{DATES} AND country = 'NATION_3'")),
    "filtered_kpis_empty": _with(_kpis("strftime(invoice_date, '%Y-%m-%d') >= '2030-01-01'")),
    "net_units": _with(
        f"""SELECT units_sold, units_returned, units_sold + units_returned AS net_units FROM ({_kpis()})"""
    ),
    "filter_date_bounds": _with(
        """SELECT COALESCE(MIN(strftime(invoice_date, '%Y-%m-%d')), '2010-12-01') AS min_date,
        COALESCE(MAX(strftime(invoice_date, '%Y-%m-%d')), '2011-12-09') AS max_date FROM fact"""
    ),
    "filter_countries": _with("SELECT DISTINCT country FROM fact"),
    "load_audit": _with(LOAD_AUDIT),
    "audit_flags": _with(
        _rows(
            FLAGS,
            lambda f: f"""SELECT '{f}' AS flag, {_count(f + " = 1")} AS count,
            {_share(_count(f + " = 1"), "COUNT(*)")} AS percentage""",
            "fact",
        )
    ),
    "audit_financials": _with(AUDIT_FINANCIALS),
    "missing_values": _with(
        _rows(
            FACT_COLUMNS,
            lambda c: f"SELECT '{c}' AS \"column\", {_count(c + ' IS NULL')} AS null_count",
            "fact",
        )
    ),
    "profile_size": _with('SELECT COUNT(*) AS "rows", CAST(8 AS BIGINT) AS "columns" FROM raw', RAW),
    "profile_columns": _with(
        _rows(
            list(RAW_TYPES),
            lambda c: f"""SELECT '{c}' AS "column", '{RAW_TYPES[c]}' AS dtype, COUNT("{c}") AS non_null_count,
            COUNT(*) - COUNT("{c}") AS null_count, {_share(f'COUNT(*) - COUNT("{c}")', "COUNT(*)")} AS null_pct""",
            "raw",
        ),
        RAW,
    ),
    "profile_sample": _with(
        f"""SELECT "InvoiceNo", "StockCode", "Description", "Quantity",
        strftime("InvoiceDate", '%Y-%m-%d %H:%M:%S') AS "InvoiceDate", CAST("UnitPrice" AS DOUBLE) AS "UnitPrice",
        CAST("CustomerID" AS BIGINT) AS "CustomerID", "Country" FROM raw
        ORDER BY {", ".join(f'raw."{c}" NULLS FIRST' for c in RAW_TYPES)} LIMIT 5""",
        RAW,
    ),
    "profile_duplicates": _with(
        f"""SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
        {_share("SUM(n - 1)", "SUM(n)")} AS duplicate_pct
        FROM (SELECT COUNT(*) AS n FROM raw GROUP BY {", ".join(f'"{c}"' for c in RAW_TYPES)})""",
        RAW,
    ),
    "profile_temporal": _with(
        """SELECT strftime(MIN("InvoiceDate"), '%Y-%m-%d %H:%M:%S') AS min_date,
        strftime(MAX("InvoiceDate"), '%Y-%m-%d %H:%M:%S') AS max_date,
        date_sub('day', MIN("InvoiceDate"), MAX("InvoiceDate")) AS timespan_days FROM raw""",
        RAW,
    ),
    "profile_numeric": _with(RAW_NUMERIC, RAW),
    "profile_anomalies": _with(RAW_ANOMALIES, RAW),
    "parse_failures": _with(
        _rows(
            ["Quantity", "InvoiceDate", "UnitPrice", "CustomerID"],
            # The derived columns are typed, so a given value always has a text form.
            lambda c: f"""SELECT '{c}' AS "column",
            COUNT("{c}") - COUNT(CAST("{c}" AS VARCHAR)) AS unreadable""",
            "raw",
        ),
        RAW,
    ),
    "revenue_mismatches": _with(
        f"SELECT {_count('ABS(line_revenue - quantity * unit_price) > 0.01')} AS mismatches FROM fact"
    ),
    "row_count_reconciliation": _with(
        """SELECT b.n AS rows_before, a.n AS rows_after, a.n - b.n AS difference
        FROM (SELECT COUNT(*) AS n FROM raw) b CROSS JOIN (SELECT COUNT(*) AS n FROM fact) a"""
    ),
    "not_null_violations": _with(
        _rows(
            REQUIRED,
            lambda c: f"SELECT '{c}' AS \"column\", {_count(c + ' IS NULL')} AS null_count",
            "fact",
        )
    ),
    "monthly_display": _with(MONTHLY_DISPLAY),
    "products_display": _with(PRODUCTS_DISPLAY),
    "countries_display": _with(COUNTRIES_DISPLAY),
    "customers_display": _with(CUSTOMERS_DISPLAY),
    "anomalies_display": _with(ANOMALIES_DISPLAY),
    "load_job": _with(LOAD_AUDIT),
    "untidy_lines": _with(
        """SELECT invoice_no, stock_code, description, quantity, strftime(invoice_date, '%Y-%m-%d %H:%M:%S') AS invoice_date,
        unit_price, customer_id, country, is_missing_description FROM tidied""",
        TIDIED,
    ),
    "untidy_parse_failures": _with(
        _rows(
            list(UNREADABLE),
            lambda c: f"SELECT '{c}' AS \"column\", {_count(UNREADABLE[c])} AS unreadable",
            "tidied",
        ),
        TIDIED,
    ),
    "untidy_not_null_violations": _with(
        _rows(
            REQUIRED,
            lambda c: f"SELECT '{c}' AS \"column\", {_count(INCOMPLETE.get(c, 'FALSE'))} AS null_count",
            "tidied",
        ),
        TIDIED,
    ),
    "untidy_revenue_mismatches": _with(f"SELECT {_count('quantity % 7 = 0')} AS mismatches FROM fact"),
    "validation_summary": _with(
        f"""SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, CAST(0 AS BIGINT) AS difference,
        {_count("quantity % 7 = 0")} AS wrong_revenue,
        {_count(" OR ".join(INCOMPLETE.values()))} AS incomplete_lines FROM tidied""",
        TIDIED,
    ),
    "append_roundtrip": _with(
        """SELECT sales_month, 2 * COUNT(*) AS lines, 2 * COUNT(*) AS line_ids,
        CAST(2 * SUM(line_revenue) AS DOUBLE) AS revenue FROM fact GROUP BY sales_month"""
    ),
    "search_published": _with(
        _daily(f"{DATES} AND (stock_code ILIKE '%LD_g%r%' OR description ILIKE '%LD_g%r%')")
    ),
    "append_duplicates": _with(
        """SELECT sales_month, transaction_category, COUNT(*) AS lines, CAST(SUM(line_revenue) AS DOUBLE) AS revenue
        FROM (SELECT sales_month, transaction_category, line_revenue FROM fact
              UNION ALL SELECT sales_month, 'DUPLICATE', line_revenue FROM fact) GROUP BY 1, 2"""
    ),
    "quarantine_roundtrip": _with(
        """SELECT CASE WHEN k % 73 = 0 AND k % 71 = 0 THEN 'InvoiceNo:missing,InvoiceDate:unreadable' WHEN k % 73 = 0 THEN 'InvoiceNo:missing'
        WHEN k % 71 = 0 THEN 'InvoiceDate:unreadable' ELSE 'published' END AS fate, COUNT(*) AS lines,
        CAST(SUM(CASE WHEN k % 73 <> 0 AND k % 71 <> 0 THEN round(quantity * CAST(unit_price AS DECIMAL(18,6)), 4) END) AS DOUBLE) AS revenue
        FROM tidied GROUP BY 1""",
        TIDIED,
    ),
    "written_report": _with(
        f"""SELECT a.section, a.name, a.value FROM ({LOAD_AUDIT}) l,
        LATERAL (VALUES ('audit', 'total_rows', CAST(l.total_rows AS VARCHAR)), ('audit', 'duplicates', CAST(l.duplicates AS VARCHAR)),
                        ('audit', 'normal_sales', CAST(l.normal_sales AS VARCHAR)), ('run', 'status', 'SUCCESS'),
                        ('run', 'raw_rows', CAST(l.total_rows AS VARCHAR)), ('steps', 'profile', 'SUCCESS'),
                        ('profile', 'rows', CAST(l.total_rows AS VARCHAR))) AS a(section, name, value)"""
    ),
    "user_sql": _with(
        "SELECT country, COUNT(*) AS sales FROM fact WHERE is_normal_sale = 1 AND quantity > 10 GROUP BY country"
    ),
    "publish_roundtrip": _with(
        """SELECT sales_month, COUNT(*) AS lines, COUNT(DISTINCT invoice_no) AS invoices,
        CAST(SUM(line_revenue) AS DOUBLE) AS revenue FROM fact GROUP BY sales_month"""
    ),
}
