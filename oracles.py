"""Check queries in DuckDB SQL for the registered Spark queries.

``COLUMNS`` is the output contract of both sides: a kind per column (i whole number, d double,
r4/r6 rounded double, t date as text, s text).
"""

from __future__ import annotations

from itertools import combinations

DISCOUNT_MIN, NET_MAX = "0.08", "10000"   # the test data has no discount above 0.10

RETURN_FEATURES = ["quantity", "unit_price", "discount", "net_spent",
                   "avg_discount_by_product", "avg_net_spent_by_product"]
ORDER_NUMERIC = ["avg_discount", "avg_unit_price", "net_spent", "total_quantity", "total_orders"]
LINEAR_WEIGHTS = [0.5, -0.01, 2.0, 0.001, 3.0, 0.002]

BASE = """
customers AS (SELECT c_custkey AS customer_id, n_name AS country, c_mktsegment AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
base_orders AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date FROM orders),
order_details AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS line_id,
  l_orderkey AS order_id, l_partkey AS product_id,
  CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) * 0.01
    AS DECIMAL(12,2)) AS unit_price,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS discount
  FROM lineitem),
nets AS (SELECT *, CAST(unit_price * quantity * (1 - discount) AS DECIMAL(18,4)) AS net
  FROM order_details),
products AS (SELECT p_partkey AS product_id, p_name AS product_name,
  CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER) AS category_id,
  p_retailprice AS unit_price, CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS discontinued
  FROM part),
categories AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER)
  AS category_id, p_brand AS category_name FROM part)"""

# A fan-out repeats every line of an order equally often: it multiplies sums, and leaves averages
# alone, which are therefore taken before it (the same number, without a second rounding).
FEATURES = BASE + """,
averages AS (SELECT order_id,
  CAST(SUM(discount) AS DOUBLE) / COUNT(discount) AS avg_discount,
  CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_unit_price
  FROM order_details GROUP BY order_id),
features AS (SELECT c.customer_id, o.order_id, o.order_date,
  CAST(SUM(od.net) AS DOUBLE) AS net_spent, CAST(SUM(od.quantity) AS BIGINT) AS total_quantity,
  any_value(a.avg_discount) AS avg_discount, any_value(a.avg_unit_price) AS avg_unit_price,
  COUNT(DISTINCT o2.order_id) AS total_orders, MAX(o2.order_date) AS recent_order,
  year(o.order_date)::VARCHAR || 'Q' || quarter(o.order_date)::VARCHAR AS year_quarter,
  c.country, c.city
  FROM customers c JOIN base_orders o ON c.customer_id = o.customer_id
  JOIN nets od ON o.order_id = od.order_id JOIN averages a ON a.order_id = o.order_id
  JOIN base_orders o2 ON c.customer_id = o2.customer_id
  WHERE o.order_date >= DATE '1997-05-06'
  GROUP BY c.customer_id, o.order_id, o.order_date, c.country, c.city)"""

LABELS = FEATURES + """,
following AS (SELECT *, lead(order_date) OVER (PARTITION BY customer_id
  ORDER BY order_date, order_id) AS next_order_date FROM features),
labels AS (SELECT *, coalesce(next_order_date - order_date <= 180, FALSE) AS will_reorder_6m
  FROM following WHERE next_order_date IS NOT NULL
  OR order_date + INTERVAL 6 MONTH <= (SELECT max(order_date) FROM features))"""

LINES = BASE + f""",
stats AS (SELECT product_id,
  CAST(SUM(discount) AS DOUBLE) / COUNT(discount) AS avg_discount_by_product,
  CAST(SUM(net) AS DOUBLE) / COUNT(net) AS avg_net_spent_by_product FROM nets GROUP BY product_id),
lines AS (SELECT line_id, o.order_id, o.customer_id, d.product_id, p.product_name, d.quantity,
  d.unit_price, d.discount, d.net AS net_spent, s.avg_discount_by_product,
  s.avg_net_spent_by_product,
  CASE WHEN d.discount >= {DISCOUNT_MIN} AND d.net < {NET_MAX} THEN 1 ELSE 0 END AS is_returned
  FROM base_orders o JOIN nets d ON o.order_id = d.order_id
  JOIN products p ON d.product_id = p.product_id
  JOIN stats s ON d.product_id = s.product_id WHERE d.quantity > 0)"""

SCORED = LINES + """,
scored AS (SELECT line_id, is_returned AS label,
  CAST(discount AS DOUBLE) * 5 + (50 - quantity) * CAST(0.01 AS DOUBLE) AS score FROM lines),
predicted AS (SELECT *, CASE WHEN score > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS prediction
  FROM scored)"""

CONFUSION = SCORED + """,
counts AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM predicted)"""

GRID = BASE + """,
summary AS (SELECT c.customer_id, COUNT(DISTINCT o.order_id) AS customer_orders,
  CAST(SUM(d.net) AS DOUBLE) AS customer_spend,
  CAST(SUM(d.unit_price) AS DOUBLE) / COUNT(d.unit_price) AS customer_avg_price,
  MAX(o.order_date) AS last_order_date
  FROM customers c JOIN base_orders o ON o.customer_id = c.customer_id
  JOIN nets d ON d.order_id = o.order_id GROUP BY c.customer_id),
popularity AS (SELECT p.product_id, COUNT(DISTINCT d.order_id) AS product_orders,
  COUNT(DISTINCT o.customer_id) AS product_buyers
  FROM products p LEFT JOIN order_details d ON d.product_id = p.product_id
  LEFT JOIN base_orders o ON o.order_id = d.order_id GROUP BY p.product_id),
by_category AS (SELECT c.customer_id, cat.category_id, CAST(SUM(d.net) AS DOUBLE) AS category_spend,
  CAST(SUM(d.quantity) AS BIGINT) AS category_quantity, MAX(o.order_date) AS category_last_order
  FROM customers c JOIN base_orders o ON o.customer_id = c.customer_id
  JOIN nets d ON d.order_id = o.order_id JOIN products p ON d.product_id = p.product_id
  JOIN categories cat ON p.category_id = cat.category_id
  GROUP BY c.customer_id, cat.category_id),
bought AS (SELECT DISTINCT o.customer_id, d.product_id FROM base_orders o
  JOIN order_details d ON d.order_id = o.order_id),
grid AS (SELECT c.customer_id, p.product_id, cat.category_id, cat.category_name,
  p.unit_price AS product_price, p.discontinued, s.customer_orders, s.customer_spend,
  s.customer_avg_price, s.last_order_date,
  COALESCE(k.category_spend, 0) AS category_spend,
  COALESCE(k.category_quantity, 0) AS category_quantity, k.category_last_order,
  CAST(ROUND(CAST(COALESCE(k.category_spend, 0) / NULLIF(s.customer_spend, 0) AS DECIMAL(28,10)), 4)
    AS DOUBLE) AS category_spend_share,
  u.product_orders, u.product_buyers,
  CAST(ROUND(CAST(p.unit_price / NULLIF(s.customer_avg_price, 0) AS DECIMAL(28,10)), 2)
    AS DOUBLE) AS price_ratio,
  CASE WHEN b.product_id IS NOT NULL THEN 1 ELSE 0 END AS purchased
  FROM customers c CROSS JOIN products p JOIN categories cat ON p.category_id = cat.category_id
  LEFT JOIN summary s ON c.customer_id = s.customer_id
  LEFT JOIN by_category k ON c.customer_id = k.customer_id AND k.category_id = p.category_id
  LEFT JOIN popularity u ON p.product_id = u.product_id
  LEFT JOIN bought b ON c.customer_id = b.customer_id AND p.product_id = b.product_id)"""

PREPARED = GRID + """,
recent AS (SELECT *,
  date_diff('day', last_order_date, (SELECT max(last_order_date) FROM grid)) AS recency_days,
  date_diff('day', category_last_order, (SELECT max(last_order_date) FROM grid)) AS raw_recency
  FROM grid WHERE customer_orders IS NOT NULL),
prepared AS (SELECT *, COALESCE(raw_recency, (SELECT max(raw_recency) FROM recent))
  AS category_recency_days FROM recent)"""

TOP = PREPARED + """,
likely AS (SELECT *, category_spend_share
  + product_buyers / (product_buyers + CAST(10 AS DOUBLE)) / (1 + price_ratio)
  AS purchase_probability FROM prepared),
placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY purchase_probability DESC, product_id) AS rank FROM likely),
top AS (SELECT * FROM placed WHERE rank <= 5)"""


def _quantile(values: str, p: str) -> str:
    """Linear interpolation between two ranks, from the nearer one, of a sorted list."""
    place = f"(CAST({p} AS DOUBLE) * (len({values}) - 1))"
    low = f"{values}[CAST(floor({place}) AS BIGINT) + 1]"
    high = f"{values}[CAST(ceil({place}) AS BIGINT) + 1]"
    part = f"({place} - floor({place}))"
    return (f"CASE WHEN {part} >= 0.5 THEN {high} - ({high} - {low}) * (1 - {part})"
            f" ELSE {low} + ({high} - {low}) * {part} END")


def _bounds(name: str, source: str, col: str) -> str:
    return (f"{name} AS (SELECT q1, q2, q3, q3 - q1 AS iqr, q1 - (q3 - q1) * CAST(1.5 AS DOUBLE) AS lo,"
            f" q3 + (q3 - q1) * CAST(1.5 AS DOUBLE) AS hi FROM (SELECT {_quantile('v', '0.25')} AS q1,"
            f" {_quantile('v', '0.5')} AS q2, {_quantile('v', '0.75')} AS q3"
            f" FROM (SELECT list_sort(list(CAST({col} AS DOUBLE))) AS v FROM {source})))")


def _per_column(source: str, cols: list[str], select: str) -> str:
    """One SELECT per column over its bounds; ``{c}`` and ``{v}`` name it and its value."""
    return " UNION ALL ".join(
        "(WITH " + _bounds("b", source, c) + " " + select.format(c=c, v=f"CAST({c} AS DOUBLE)",
                                                                 source=source) + ")"
        for c in cols)


def _remove_outliers() -> str:
    steps, source = [], "features"
    for i, c in enumerate(ORDER_NUMERIC):
        steps.append(_bounds(f"b{i}", source, c))
        steps.append(f"kept{i} AS (SELECT s.* FROM {source} s, b{i}"
                     f" WHERE CAST({c} AS DOUBLE) BETWEEN lo AND hi)")
        source = f"kept{i}"
    return f"WITH {FEATURES}, {', '.join(steps)} SELECT order_id FROM {source}"


def _pair_bins() -> str:
    bins = ", ".join(
        f"CAST(least(19, floor((CAST({c} AS DOUBLE) - (SELECT min(CAST({c} AS DOUBLE)) FROM features))"
        f" / ((SELECT max(CAST({c} AS DOUBLE)) FROM features)"
        f" - (SELECT min(CAST({c} AS DOUBLE)) FROM features)) * 20)) AS BIGINT) AS {c}"
        for c in ORDER_NUMERIC)
    plots = [(c, c) for c in ORDER_NUMERIC] + list(combinations(ORDER_NUMERIC, 2))
    cells = " UNION ALL ".join(
        f"SELECT '{x}' AS col_x, '{y}' AS col_y, {x} AS bin_x, {y} AS bin_y, count(*) AS n"
        f" FROM bins GROUP BY {x}, {y}" for x, y in plots)
    return f"WITH {FEATURES}, bins AS (SELECT {bins} FROM features) {cells}"


def _split(source: str, label: str, share: str, seed: int) -> str:
    return (f"SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5(line_id || '|{seed}'))"
            f" <= floor(CAST({share} AS DOUBLE) * count(*) OVER (PARTITION BY {label}) + 0.5)"
            f" AS chosen FROM {source}")


def _scaled(fit: str) -> str:
    return ", ".join(
        f"(CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM {fit}))"
        f" / (SELECT stddev_pop(CAST({c} AS DOUBLE)) FROM {fit}) AS {c}" for c in RETURN_FEATURES)


NEIGHBOURS = (
    f"WITH {LINES}, few AS (SELECT line_id, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in RETURN_FEATURES)
    + " FROM lines WHERE is_returned = 1), pairs AS (SELECT a.line_id, b.line_id AS neighbour_key, "
    + "sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in RETURN_FEATURES)
    + ") AS distance FROM few a JOIN few b ON a.line_id <> b.line_id)"
    " SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line_id"
    " ORDER BY distance, neighbour_key) AS rank FROM pairs) WHERE rank <= 5")

ATTRIBUTIONS = (
    f"{LINES}, background AS (SELECT * FROM lines ORDER BY md5(line_id || '|42') LIMIT 100), "
    "attributions AS (" + " UNION ALL ".join(
        f"SELECT line_id, '{c}' AS feature, CAST({w} AS DOUBLE) * (CAST({c} AS DOUBLE)"
        f" - (SELECT avg(CAST({c} AS DOUBLE)) FROM background)) AS value FROM lines"
        for c, w in zip(RETURN_FEATURES, LINEAR_WEIGHTS)) + ")")

REPORT = f"""WITH {CONFUSION},
parts AS (SELECT '0' AS class, tn AS h, fn AS a, fp AS m FROM counts
  UNION ALL SELECT '1', tp, fp, fn FROM counts),
rates AS (SELECT class, coalesce(h / nullif(h + a, 0), 0.0) AS precision,
  coalesce(h / nullif(h + m, 0), 0.0) AS recall,
  coalesce(2 * h / nullif(2 * h + a + m, 0), 0.0) AS f1, h + m AS support FROM parts)
SELECT * FROM rates
UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + fp + fn + tn), tp + fp + fn + tn FROM counts
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM rates
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM rates"""

FEATURE_COLUMNS = {"customer_id": "i", "order_id": "i", "order_date": "t", "net_spent": "d",
                   "total_quantity": "i", "avg_discount": "d", "avg_unit_price": "d",
                   "total_orders": "i", "recent_order": "t", "year_quarter": "s",
                   "country": "s", "city": "s"}
LINE_COLUMNS = {"line_id": "s", "order_id": "i", "customer_id": "i", "product_id": "i",
                "product_name": "s", "quantity": "i", "unit_price": "d", "discount": "d",
                "net_spent": "d", "avg_discount_by_product": "d", "avg_net_spent_by_product": "d",
                "is_returned": "i"}
TOP_COLUMNS = {"customer_id": "i", "product_id": "i", "category_name": "s",
               "purchase_probability": "d"}

FILE_COLUMNS = TOP_COLUMNS | {
    "category_id": "i", "product_price": "d", "discontinued": "i", "customer_orders": "i",
    "customer_spend": "d", "customer_avg_price": "d", "category_spend": "d",
    "category_quantity": "i", "category_spend_share": "r4", "product_orders": "i",
    "product_buyers": "i", "price_ratio": "r4", "recency_days": "i",
    "category_recency_days": "i", "purchased": "i", "rank": "i"}

COLUMNS: dict[str, dict[str, str]] = {
    "scan_order_lines": {"line_id": "s", "order_id": "i", "product_id": "i", "unit_price": "d",
                         "quantity": "i", "discount": "d"},
    "order_features": FEATURE_COLUMNS,
    "order_totals": FEATURE_COLUMNS,
    "reorder_labels": FEATURE_COLUMNS | {"next_order_date": "t", "will_reorder_6m": "i",
                                         "label_is_reliable": "i"},
    "confirmed_lapsed": {"order_id": "i", "order_date": "t", "next_order_date": "t"},
    "quarter_dummies": {"order_id": "i", "quarter": "s", "flag": "i"},
    "parse_dates": {"order_id": "i", "order_date": "t"},
    "return_lines": LINE_COLUMNS,
    "product_stats": {"product_id": "i", "avg_discount_by_product": "d",
                      "avg_net_spent_by_product": "d"},
    "line_product_stats": {"line_id": "s", "avg_discount_by_product": "d",
                           "avg_net_spent_by_product": "d"},
    "return_status_counts": {"is_returned": "i", "n": "i"},
    "return_summary": {"total_orders": "i", "return_count": "i", "return_rate_pct": "d",
                       "return_rate": "s"},
    "top_products": {"product_name": "s", "n": "i"},
    "top_returned_products": {"product_name": "s", "n": "i"},
    "customer_summary": {"customer_id": "i", "customer_orders": "i", "customer_spend": "d",
                         "customer_avg_price": "d", "last_order_date": "t"},
    "product_popularity": {"product_id": "i", "product_orders": "i", "product_buyers": "i"},
    "customer_category_spend": {"customer_id": "i", "category_id": "i", "category_spend": "d",
                                "category_quantity": "i", "category_last_order": "t"},
    "purchased_pairs": {"customer_id": "i", "product_id": "i"},
    "recommend_grid": {
        "customer_id": "i", "category_id": "i", "category_name": "s", "n": "i",
        "product_ids": "i", "product_price": "r4", "discontinued": "i", "customer_orders": "i",
        "customer_spend": "d", "customer_avg_price": "d", "last_order_date": "t",
        "category_spend": "d", "category_quantity": "i", "category_last_order": "t",
        "category_spend_share": "r4", "product_orders": "i", "product_buyers": "i",
        "price_ratio": "r4", "purchased": "i", "purchased_ids": "i"},
    "recommend_features": {
        "product_id": "i", "n": "i", "customer_ids": "i", "recency_days": "i",
        "category_recency_days": "i", "category_spend_share": "r4", "price_ratio": "r4",
        "category_quantity": "i", "purchased": "i"},
    "top_k_per_customer": TOP_COLUMNS | {"rank": "i", "purchased": "i"},
    "precision_at_k": {"precision": "d"},
    "recommend_lookup": TOP_COLUMNS,
    "csv_roundtrip": FILE_COLUMNS,
    "iqr_bounds": {"column": "s", "q1": "d", "q3": "d", "iqr": "d", "lower": "d", "upper": "d"},
    "outlier_report": {"column": "s", "n_outliers": "i", "pct_outliers": "r6", "lower": "d",
                       "upper": "d"},
    "remove_outliers": {"order_id": "i"},
    "winsorize_net": {"order_id": "i", "net_spent_winsorized": "d", "net_spent_1k": "d"},
    "outlier_customers": {"customer_id": "i", "n_outlier_orders": "i"},
    "table_preview": LINE_COLUMNS,
    "table_profile": {"column": "s", "type": "s", "n_rows": "i", "n_null": "i"},
    "describe_numeric": {"column": "s", "count": "i", "mean": "r4", "std": "r4", "min": "d",
                         "q25": "d", "q50": "d", "q75": "d", "max": "d"},
    "boxplot_stats": {"column": "s", "q1": "d", "median": "d", "q3": "d", "whisker_low": "d",
                      "whisker_high": "d", "n_fliers": "i"},
    "discount_spend_bins": {"discount_bin": "i", "spend_bin": "i", "is_returned": "i", "n": "i"},
    "eda_report": {"report": "s", "item": "s", "measure": "s", "value": "d"},
    "pair_bins": {"col_x": "s", "col_y": "s", "bin_x": "i", "bin_y": "i", "n": "i"},
    "stratified_split": {"line_id": "s", "split": "s"},
    "validation_split": {"line_id": "s", "is_validation": "i"},
    "standard_scale": {"line_id": "s"} | {c: "r4" for c in RETURN_FEATURES},
    "split_roundtrip": {"line_id": "s", "is_returned": "i", "split": "s"} | {c: "r4" for c in RETURN_FEATURES},
    "class_weights": {"line_id": "s", "weight": "d"},
    "smote_neighbors": {"line_id": "s", "neighbour_key": "s", "rank": "i", "distance": "r6"},
    "resampled_counts": {"is_returned": "i", "n": "i"},
    "score_threshold": {"line_id": "s", "probability": "d", "prediction": "i",
                        "prediction_text": "s"},
    "roc_auc": {"metric": "s", "value": "r6"},
    "f1_score": {"metric": "s", "value": "r6"},
    "confusion_matrix": {"label": "i", "prediction": "i", "n": "i"},
    "classification_report": {"class": "s", "precision": "r6", "recall": "r6", "f1": "r6",
                              "support": "i"},
    "shapley_values": {"line_id": "s", "feature": "s", "value": "r4"},
    "feature_importance": {"feature": "s", "mean_abs_value": "r4"},
}

LINE_TYPES = {"line_id": "string", "order_id": "bigint", "customer_id": "bigint",
              "product_id": "bigint", "product_name": "string", "quantity": "int",
              "unit_price": "decimal(12,2)", "discount": "decimal(4,2)",
              "net_spent": "decimal(18,4)", "avg_discount_by_product": "double",
              "avg_net_spent_by_product": "double", "is_returned": "int"}

BODIES: dict[str, str] = {
    "scan_order_lines": f"WITH {BASE} SELECT * FROM order_details",
    "order_features": f"WITH {FEATURES} SELECT * FROM features",
    "order_totals": f"""WITH {BASE},
history AS (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
  MAX(order_date) AS recent_order FROM base_orders GROUP BY customer_id)
SELECT c.customer_id, o.order_id, o.order_date, CAST(SUM(od.net) AS DOUBLE) AS net_spent,
  SUM(od.quantity) AS total_quantity,
  CAST(SUM(od.discount) AS DOUBLE) / COUNT(od.discount) AS avg_discount,
  CAST(SUM(od.unit_price) AS DOUBLE) / COUNT(od.unit_price) AS avg_unit_price,
  any_value(h.total_orders) AS total_orders, any_value(h.recent_order) AS recent_order,
  year(o.order_date)::VARCHAR || 'Q' || quarter(o.order_date)::VARCHAR AS year_quarter,
  c.country, c.city
FROM customers c JOIN base_orders o ON c.customer_id = o.customer_id
JOIN nets od ON o.order_id = od.order_id JOIN history h ON h.customer_id = c.customer_id
WHERE o.order_date >= DATE '1997-05-06'
GROUP BY c.customer_id, o.order_id, o.order_date, c.country, c.city""",
    "reorder_labels": f"WITH {LABELS} SELECT *, TRUE AS label_is_reliable FROM labels",
    "confirmed_lapsed": f"WITH {LABELS} SELECT * FROM labels WHERE NOT will_reorder_6m",
    "quarter_dummies": f"""WITH {LABELS}, levels AS (SELECT DISTINCT year_quarter AS level FROM labels)
SELECT order_id, 'year_quarter_' || level AS quarter,
  CASE WHEN year_quarter = level THEN 1 ELSE 0 END AS flag
FROM labels, levels WHERE level > (SELECT min(level) FROM levels)""",
    "parse_dates": """SELECT o_orderkey AS order_id, TRY_CAST(CASE WHEN o_orderstatus = 'F'
  THEN 'on ' ELSE '' END || strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS order_date FROM orders""",
    "return_lines": f"WITH {LINES} SELECT * FROM lines",
    "product_stats": f"WITH {LINES} SELECT * FROM stats",
    "line_product_stats": f"""WITH {BASE} SELECT line_id,
  CAST(SUM(discount) OVER w AS DOUBLE) / COUNT(discount) OVER w AS avg_discount_by_product,
  CAST(SUM(net) OVER w AS DOUBLE) / COUNT(net) OVER w AS avg_net_spent_by_product
FROM nets WINDOW w AS (PARTITION BY product_id)""",
    "return_status_counts": f"""WITH {LINES} SELECT is_returned, count(*) AS n FROM lines
GROUP BY is_returned""",
    "return_summary": f"""WITH {LINES} SELECT count(*) AS total_orders,
  sum(is_returned) AS return_count,
  CAST(round(CAST(avg(is_returned) * 100 AS DECIMAL(28,10)), 1) AS DOUBLE) AS return_rate_pct,
  '%' || printf('%.1f', round(CAST(avg(is_returned) * 100 AS DECIMAL(28,10)), 1)::DOUBLE) AS return_rate
FROM lines""",
    "top_products": f"""WITH {LINES} SELECT product_name, count(*) AS n FROM lines
GROUP BY product_name ORDER BY n DESC, product_name LIMIT 10""",
    "top_returned_products": f"""WITH {LINES} SELECT product_name, count(*) AS n FROM lines
WHERE is_returned = 1 GROUP BY product_name ORDER BY n DESC, product_name LIMIT 5""",
    "customer_summary": f"WITH {GRID} SELECT * FROM summary",
    "product_popularity": f"WITH {GRID} SELECT * FROM popularity",
    "customer_category_spend": f"WITH {GRID} SELECT * FROM by_category",
    "purchased_pairs": f"WITH {GRID} SELECT * FROM bought",
    "recommend_grid": f"""WITH {GRID} SELECT customer_id, category_id, category_name, count(*) AS n,
  sum(product_id) AS product_ids, sum(product_price) AS product_price,
  sum(discontinued) AS discontinued, max(customer_orders) AS customer_orders,
  max(customer_spend) AS customer_spend, max(customer_avg_price) AS customer_avg_price,
  max(last_order_date) AS last_order_date, max(category_spend) AS category_spend,
  max(category_quantity) AS category_quantity, max(category_last_order) AS category_last_order,
  sum(category_spend_share) AS category_spend_share, sum(product_orders) AS product_orders,
  sum(product_buyers) AS product_buyers, sum(price_ratio) AS price_ratio,
  sum(purchased) AS purchased, sum(purchased * product_id) AS purchased_ids
FROM grid GROUP BY customer_id, category_id, category_name""",
    "recommend_features": f"""WITH {PREPARED} SELECT product_id, count(*) AS n,
  sum(customer_id) AS customer_ids, sum(recency_days) AS recency_days,
  sum(category_recency_days) AS category_recency_days,
  sum(category_spend_share) AS category_spend_share, sum(price_ratio) AS price_ratio,
  sum(category_quantity) AS category_quantity, sum(purchased) AS purchased
FROM prepared GROUP BY product_id""",
    "top_k_per_customer": f"WITH {TOP} SELECT * FROM top",
    "precision_at_k": f"""WITH {TOP} SELECT sum(purchased) / CAST(5 * count(DISTINCT customer_id)
  AS DOUBLE) AS precision FROM top""",
    "recommend_lookup": f"""WITH {TOP} SELECT * FROM top WHERE customer_id IN
  (SELECT customer_id FROM customers WHERE city = 'BUILDING')""",
    "csv_roundtrip": f"WITH {TOP} SELECT * FROM top",
    "iqr_bounds": f"WITH {FEATURES} " + _per_column(
        "features", ORDER_NUMERIC,
        "SELECT '{c}' AS \"column\", q1, q3, iqr, lo AS lower, hi AS upper FROM b"),
    "outlier_report": f"WITH {LINES} " + _per_column(
        "lines", RETURN_FEATURES,
        "SELECT '{c}' AS \"column\", count(*) FILTER ({v} < lo OR {v} > hi) AS n_outliers,"
        " count(*) FILTER ({v} < lo OR {v} > hi) * 100.0 / count(*) AS pct_outliers,"
        " lo AS lower, hi AS upper FROM {source}, b GROUP BY lo, hi"),
    "remove_outliers": _remove_outliers(),
    "winsorize_net": f"""WITH {FEATURES}, ranked AS (SELECT net_spent,
  row_number() OVER (ORDER BY net_spent) - 1 AS i, count(*) OVER () AS n FROM features),
edge AS (SELECT max(net_spent) FILTER (i = floor(CAST(0.05 AS DOUBLE) * n)) AS lo,
  max(net_spent) FILTER (i = n - 1 - floor(CAST(0.05 AS DOUBLE) * n)) AS hi FROM ranked)
SELECT order_id, least(greatest(net_spent, lo), hi) AS net_spent_winsorized,
  net_spent / 1000 AS net_spent_1k FROM features, edge""",
    "outlier_customers": f"WITH {FEATURES}, {_bounds('b', 'features', 'net_spent')}" + """
SELECT customer_id, count(*) AS n_outlier_orders FROM features, b
WHERE net_spent < lo OR net_spent > hi GROUP BY customer_id""",
    "table_preview": f"WITH {LINES} SELECT * FROM lines ORDER BY order_id, product_id, line_id LIMIT 5",
    "table_profile": f"WITH {LINES} " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS n_rows,"
        f" count(*) - count({c}) AS n_null FROM lines" for c, t in LINE_TYPES.items()),
    "describe_numeric": f"WITH {LINES} " + _per_column(
        "lines", RETURN_FEATURES,
        "SELECT '{c}' AS \"column\", count({c}) AS count, avg({v}) AS mean,"
        " stddev_samp({v}) AS std, min({v}) AS min, any_value(q1) AS q25, any_value(q2) AS q50,"
        " any_value(q3) AS q75, max({v}) AS max FROM {source}, b"),
    "boxplot_stats": f"WITH {LINES} " + _per_column(
        "lines", RETURN_FEATURES,
        "SELECT '{c}' AS \"column\", q1, q2 AS median, q3,"
        " min({v}) FILTER ({v} >= lo AND {v} <= hi) AS whisker_low,"
        " max({v}) FILTER ({v} >= lo AND {v} <= hi) AS whisker_high,"
        " count(*) FILTER ({v} < lo OR {v} > hi) AS n_fliers FROM {source}, b GROUP BY q1, q2, q3"),
    "discount_spend_bins": f"""WITH {LINES} SELECT CAST(discount * 100 AS BIGINT) AS discount_bin,
  CAST(floor(net_spent / 1000) AS BIGINT) AS spend_bin, is_returned, count(*) AS n
FROM lines GROUP BY ALL""",
    "pair_bins": _pair_bins(),
    "stratified_split": f"WITH {LINES} SELECT line_id, CASE WHEN chosen THEN 'test' ELSE 'train' END"
                        f" AS split FROM ({_split('lines', 'is_returned', '0.2', 42)})",
    "validation_split": f"WITH {LINES} SELECT line_id, chosen AS is_validation"
                        f" FROM ({_split('lines', 'is_returned', '0.25', 7)})",
    "standard_scale": f"WITH {LINES} SELECT line_id, {_scaled('lines')} FROM lines",
    "split_roundtrip": f"WITH {LINES}, parts AS ({_split('lines', 'is_returned', '0.2', 42)}),"
                       f" train AS (SELECT * FROM parts WHERE NOT chosen)"
                       f" SELECT line_id, is_returned, CASE WHEN chosen THEN 'test' ELSE 'train' END"
                       f" AS split, {_scaled('train')} FROM parts",
    "class_weights": f"""WITH {LINES} SELECT line_id, count(*) OVER () /
  CAST(2 * count(*) OVER (PARTITION BY is_returned) AS DOUBLE) AS weight FROM lines""",
    "smote_neighbors": NEIGHBOURS,
    "resampled_counts": f"""WITH {LINES}, sizes AS (SELECT count(*) FILTER (is_returned = 0) AS big,
  count(*) FILTER (is_returned = 1) AS small FROM lines)
SELECT 0 AS is_returned, big AS n FROM sizes UNION ALL
SELECT 1, small + CAST(trunc(CAST(0.3 AS DOUBLE) * big - small) AS BIGINT) FROM sizes""",
    "score_threshold": f"""WITH {SCORED} SELECT line_id, score AS probability, prediction,
  CASE WHEN prediction = 1 THEN 'returned' ELSE 'not returned' END AS prediction_text
FROM predicted""",
    "roc_auc": f"""WITH {SCORED}, ranks AS (SELECT label, rank() OVER (ORDER BY score)
  + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored)
SELECT 'roc_auc' AS metric, (sum(r) FILTER (label = 1) - any_value(p) * (any_value(p) + 1) / 2.0)
  / (any_value(p)::DOUBLE * any_value(q)) AS value
FROM ranks, (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scored)""",
    "f1_score": f"""WITH {CONFUSION} SELECT 'f1' AS metric,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS value FROM counts""",
    "confusion_matrix": f"""WITH {CONFUSION} SELECT 1 AS label, 1 AS prediction, tp AS n FROM counts
UNION ALL SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts
UNION ALL SELECT 0, 0, tn FROM counts""",
    "classification_report": REPORT,
    "shapley_values": f"WITH {ATTRIBUTIONS} SELECT * FROM attributions",
    "feature_importance": f"""WITH {ATTRIBUTIONS} SELECT feature, avg(abs(value)) AS mean_abs_value
FROM attributions GROUP BY feature""",
}

# The exploratory report in long form: of each table the columns that name a row, and its numbers.
REPORTS: dict[str, tuple[list[str], list[str]]] = {
    "preview": (["line_id"], ["order_id", "product_id", "quantity", "unit_price", "discount",
                              "net_spent", "is_returned"]),
    "profile": (["column", "type"], ["n_rows", "n_null"]),
    "describe": (["column"], ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]),
    "outliers": (["column"], ["n_outliers", "pct_outliers", "lower", "upper"]),
    "boxplots": (["column"], ["q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers"]),
    "status_counts": (["is_returned"], ["n"]),
    "discount_spend": (["discount_bin", "spend_bin", "is_returned"], ["n"]),
    "top_products": (["product_name"], ["n"]),
}
ROUNDED = ["mean", "std", "pct_outliers"]


def _report() -> str:
    bodies = {"preview": "table_preview", "profile": "table_profile",
              "describe": "describe_numeric", "outliers": "outlier_report",
              "boxplots": "boxplot_stats", "status_counts": "return_status_counts",
              "discount_spend": "discount_spend_bins", "top_products": "top_products"}
    tables = [f"{name}_rows AS ({BODIES[key].removeprefix(f'WITH {LINES} ')})"
              for name, key in bodies.items()]
    rows = []
    for name, (item, measures) in REPORTS.items():
        key = ", ".join(f'CAST("{c}" AS VARCHAR)' for c in item)
        for m in measures:
            value = f'CAST("{m}" AS DOUBLE)'
            value = f"round({value}, 4)" if m in ROUNDED else value
            rows.append(f"SELECT '{name}' AS report, concat_ws('/', {key}) AS item,"
                        f" '{m}' AS measure, {value} AS value FROM {name}_rows")
    return f"WITH {LINES}, " + ", ".join(tables) + " " + " UNION ALL ".join(rows)


BODIES["eda_report"] = _report()

CASTS = {"i": "CAST({c} AS BIGINT)", "d": "CAST({c} AS DOUBLE) + 0.0::DOUBLE",
         "r4": "ROUND(CAST({c} AS DOUBLE), 4) + 0.0::DOUBLE",
         "r6": "ROUND(CAST({c} AS DOUBLE), 6) + 0.0::DOUBLE",
         "t": "CAST(CAST({c} AS DATE) AS VARCHAR)", "s": "CAST({c} AS VARCHAR)"}


def oracle_text(key: str) -> str:
    if key not in COLUMNS:
        return BODIES[key]
    select = ", ".join(f'{CASTS[kind].format(c=chr(34) + c + chr(34))} AS "{c}"'
                       for c, kind in COLUMNS[key].items())
    return f"SELECT {select} FROM ({BODIES[key]}) AS result"
