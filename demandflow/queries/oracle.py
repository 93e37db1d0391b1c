"""Reference SQL (DuckDB dialect) for every registered query that SQL can express.

``TABLES`` are the derived tables as common table expressions; ``sql`` puts those a
statement mentions in front of it.
"""

from __future__ import annotations

import re

RUN_AT = "TIMESTAMP '2002-02-01 00:00:00'"

TABLES: dict[str, str] = {}

TABLES["stores"] = """
SELECT s_suppkey AS store_nbr, n_name AS city, r_name AS state,
       CASE s_suppkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' ELSE 'E' END AS type,
       CAST(s_suppkey % 17 AS INT) AS cluster
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

TABLES["sales"] = """
SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr, p_type AS family,
       CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS sales,
       CAST(SUM(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END) AS INT) AS onpromotion
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3"""

TABLES["sales_raw"] = """
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr,
       CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE p_type END AS family,
       CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_quantity END AS sales,
       CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS onpromotion
FROM lineitem JOIN part ON l_partkey = p_partkey"""

TABLES["last_sale"] = "SELECT CAST(MAX(l_shipdate) AS DATE) AS d FROM lineitem"

TABLES["future"] = """
SELECT date, store_nbr, family, onpromotion FROM sales WHERE date > (SELECT CAST(d - INTERVAL 28 DAY AS DATE) FROM last_sale)"""

TABLES["future_raw"] = """
SELECT id, date, store_nbr, family, onpromotion FROM sales_raw
WHERE date > (SELECT CAST(d - INTERVAL 28 DAY AS DATE) FROM last_sale)"""

TABLES["transactions"] = """
SELECT CAST(o_orderdate AS DATE) AS date, l_suppkey AS store_nbr, CAST(COUNT(DISTINCT o_orderkey) AS INT) AS transactions
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2"""

TABLES["oil_raw"] = """
SELECT CAST(o_orderdate AS DATE) AS date,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS dcoilwtico
FROM orders WHERE isodow(o_orderdate) <= 5 GROUP BY 1"""

TABLES["holidays_raw"] = """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, 'Holiday' AS type, 'National' AS locale, 'ALL' AS locale_name,
       month(o_orderdate) = 6 AS transferred
FROM orders WHERE day(o_orderdate) = 1
UNION
SELECT DISTINCT CAST(o_orderdate AS DATE), 'Holiday', 'Regional', r_name, false
FROM orders JOIN region ON r_regionkey = month(o_orderdate) % 5
WHERE day(o_orderdate) = 15 AND month(o_orderdate) IN (3, 6, 9, 12)"""

TABLES["oil"] = """
SELECT date, dcoilwtico FROM (
  SELECT sp.date, last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY sp.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dcoilwtico
  FROM (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM oil_raw) sp
  LEFT JOIN oil_raw o ON o.date = sp.date) WHERE dcoilwtico IS NOT NULL"""

TABLES["oil_ahead"] = """
SELECT date, dcoilwtico FROM oil
UNION ALL
SELECT CAST(unnest(generate_series(z + INTERVAL 1 DAY, d, INTERVAL 1 DAY)) AS DATE), price
FROM (SELECT MAX(date) AS z, arg_max(dcoilwtico, date) AS price FROM oil) CROSS JOIN last_sale"""

TABLES["holidays"] = """
SELECT CAST(sp.date AS DATE) AS date, st.state, CASE WHEN m.date IS NULL THEN 0 ELSE 1 END AS is_holiday
FROM (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM holidays_raw) sp
CROSS JOIN (SELECT DISTINCT state FROM stores) st
LEFT JOIN (
  SELECT DISTINCT h.date, s.state FROM holidays_raw h
  JOIN (SELECT DISTINCT state FROM stores) s ON h.locale_name = 'ALL' OR h.locale_name = s.state
  WHERE NOT h.transferred) m ON m.date = sp.date AND m.state = st.state"""

TABLES["train"] = """
SELECT id, date, store_nbr, family, CAST(sales AS DOUBLE) AS sales, CAST(onpromotion AS INT) AS onpromotion FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY date, store_nbr, family, sales, onpromotion) AS rk
  FROM sales_raw WHERE family IS NOT NULL AND sales IS NOT NULL) WHERE rk = 1"""

TABLES["test"] = """
SELECT id, date, store_nbr, family, CAST(onpromotion AS INT) AS onpromotion FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY date, store_nbr, family, onpromotion) AS rk
  FROM future_raw WHERE family IS NOT NULL) WHERE rk = 1"""

TABLES["gold"] = """
SELECT t.id, t.date, t.store_nbr, t.family, t.sales, t.onpromotion, o.dcoilwtico, s.city, s.state, s.type AS store_type,
       s.cluster, CAST(COALESCE(h.is_holiday, 0) AS INT) AS is_holiday, CAST(year(t.date) AS INT) AS year,
       CAST(month(t.date) AS INT) AS month, CAST(day(t.date) AS INT) AS day, CAST(weekofyear(t.date) AS INT) AS week_of_year,
       CAST(dayofweek(t.date) + 1 AS INT) AS day_of_week,
       CASE WHEN dayofweek(t.date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM train t LEFT JOIN stores s USING (store_nbr)
LEFT JOIN holidays h ON h.date = t.date AND h.state = s.state LEFT JOIN oil o ON o.date = t.date"""

TABLES["codes"] = """
SELECT category, value, CAST(row_number() OVER (PARTITION BY category ORDER BY value) - 1 AS INT) AS code FROM (
  SELECT DISTINCT 'family' AS category, family AS value FROM train
  UNION SELECT DISTINCT 'city', city FROM stores
  UNION SELECT DISTINCT 'state', state FROM stores
  UNION SELECT DISTINCT 'type', type FROM stores)"""


def _enriched(rows: str, oil: str, sales: str) -> str:
    return f"""
SELECT t.date, t.store_nbr, t.family, {sales} t.onpromotion, s.city, s.state, s.type, s.cluster,
       CAST(COALESCE(h.is_holiday, 0) AS INT) AS is_holiday, o.dcoilwtico, cf.code AS family_code, cc.code AS city_code,
       cs.code AS state_code, ct.code AS type_code, CAST(dayofweek(t.date) + 1 AS INT) AS day_of_week,
       CAST(day(t.date) AS INT) AS day_of_month, CAST(month(t.date) AS INT) AS month, CAST(year(t.date) AS INT) AS year,
       CASE WHEN day(t.date) IN (15, 30) THEN 1 ELSE 0 END AS is_salary_day
FROM {rows} t JOIN stores s USING (store_nbr)
LEFT JOIN holidays h ON h.date = t.date AND h.state = s.state JOIN {oil} o ON o.date = t.date
JOIN codes cf ON cf.category = 'family' AND cf.value = t.family JOIN codes cc ON cc.category = 'city' AND cc.value = s.city
JOIN codes cs ON cs.category = 'state' AND cs.value = s.state JOIN codes ct ON ct.category = 'type' AND ct.value = s.type"""


TABLES["training"] = _enriched("train", "oil", "t.sales,")
TABLES["training_ahead"] = _enriched("train", "oil_ahead", "t.sales,")
TABLES["testing"] = _enriched("test", "oil_ahead", "")

TABLES["series"] = """
SELECT date, family, state, CAST(SUM(CAST(sales AS BIGINT)) AS DOUBLE) AS sales, CAST(SUM(onpromotion) AS INT) AS onpromotion
FROM sales JOIN stores USING (store_nbr) GROUP BY 1, 2, 3"""

TABLES["pred"] = """
SELECT * FROM (
  SELECT date, family, state, sales AS y, LAG(sales, 7) OVER (PARTITION BY family, state ORDER BY date) AS prediction FROM series
) WHERE prediction IS NOT NULL"""

TABLES["lagged"] = """
SELECT *, LAG(sales, 1) OVER w AS lag_1, LAG(sales, 2) OVER w AS lag_2, LAG(sales, 3) OVER w AS lag_3, LAG(sales, 4) OVER w AS lag_4
FROM sales WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)"""

TABLES["scenario_pred"] = """
SELECT date, store_nbr, family, predicted_sales, scenario FROM (
  SELECT date, store_nbr, family, lag_1 AS predicted_sales, 'current' AS scenario FROM lagged
  UNION ALL
  SELECT date, store_nbr, family, lag_1 * (1 + 0.25E0 * onpromotion), 'onpromotion_2x' FROM lagged
) WHERE predicted_sales IS NOT NULL AND date > (SELECT CAST(d - INTERVAL 90 DAY AS DATE) FROM last_sale)"""

TABLES["validation_pred"] = """
SELECT date, store_nbr, family, sales, lag_1 AS predicted_sales FROM lagged
WHERE lag_1 IS NOT NULL AND date > (SELECT CAST(d - INTERVAL 28 DAY AS DATE) FROM last_sale)"""

TABLES["model_pred"] = """
SELECT date, store_nbr, family, m.name AS model_name, m.version AS model_version, m.made_at AS prediction_timestamp,
       m.iteration AS best_iteration, CASE m.iteration WHEN 1 THEN lag_1 WHEN 2 THEN lag_2 ELSE lag_3 END AS prediction
FROM lagged CROSS JOIN (VALUES ('previous', 'v1', TIMESTAMP '2002-01-01 00:00:00', 1), ('previous', 'v2', TIMESTAMP '2002-01-02 00:00:00', 2),
                               ('third', 'v1', TIMESTAMP '2002-01-01 00:00:00', 3)) m(name, version, made_at, iteration)
WHERE date > (SELECT CAST(d - INTERVAL 90 DAY AS DATE) FROM last_sale)"""

TABLES["fact"] = f"""
SELECT date, family, store_nbr, sales, CAST(NULL AS DOUBLE) AS forecast, 'train' AS split, 'actual' AS record_type,
       CAST(NULL AS VARCHAR) AS model_name, CAST(NULL AS VARCHAR) AS model_type, CAST(NULL AS VARCHAR) AS model_version,
       CAST(NULL AS VARCHAR) AS model_strategy, CAST(NULL AS INT) AS best_iteration,
       CAST(NULL AS TIMESTAMP) AS prediction_timestamp, {RUN_AT} AS created_at, {RUN_AT} AS updated_at FROM sales
UNION ALL
SELECT p.date, p.family, p.store_nbr, s.sales, p.prediction, 'test', 'backtest', model_name, 'lag', model_version, 'global',
       best_iteration, prediction_timestamp, {RUN_AT}, {RUN_AT}
FROM model_pred p JOIN sales s USING (date, family, store_nbr) WHERE p.prediction IS NOT NULL
UNION ALL
SELECT date, family, store_nbr, NULL, prediction, 'test', 'forecast', model_name, 'lag', model_version, 'global',
       best_iteration, prediction_timestamp, {RUN_AT}, {RUN_AT} FROM model_pred WHERE prediction IS NOT NULL"""

TABLES["latest"] = """
SELECT * EXCLUDE (rk) FROM (
  SELECT *, row_number() OVER (PARTITION BY date, family, store_nbr, model_name, record_type
                               ORDER BY prediction_timestamp DESC, model_version DESC) AS rk
  FROM fact WHERE record_type = 'forecast') WHERE rk = 1"""

TABLES["accuracy"] = """
SELECT model_name, model_version, family, store_nbr, COUNT(*) AS num_predictions, AVG(ABS(sales - forecast)) AS mae,
       AVG(ABS((sales - forecast) / NULLIF(sales, 0))) AS mape, SQRT(AVG((sales - forecast) * (sales - forecast))) AS rmse,
       MIN(prediction_timestamp) AS first_prediction_time, MAX(prediction_timestamp) AS last_prediction_time
FROM fact WHERE record_type = 'backtest' AND sales IS NOT NULL AND forecast IS NOT NULL GROUP BY 1, 2, 3, 4"""

TABLES["stack"] = """
SELECT date, store_nbr, family, city, sales AS actual_sales, 'Actual' AS data_type FROM sales LEFT JOIN stores USING (store_nbr)
UNION ALL
SELECT date, store_nbr, family, city, predicted_sales, 'Forecast - ' || scenario FROM scenario_pred LEFT JOIN stores USING (store_nbr)
UNION ALL
SELECT date, store_nbr, family, city, predicted_sales, 'Validation' FROM validation_pred LEFT JOIN stores USING (store_nbr)"""

TABLES["segments"] = """
SELECT CAST(year(date) AS INT) AS year, store_nbr, family, city, data_type, SUM(actual_sales) AS total_sales
FROM stack CROSS JOIN last_sale WHERE year(date) >= year(d) - 1 AND month(date) <= month(d) GROUP BY ALL"""

TABLES["totals"] = """
SELECT year, store_nbr, family, city, '1x_promos' AS scenario, SUM(total_sales) AS total_sales
FROM segments WHERE data_type IN ('Actual', 'Forecast - current') GROUP BY ALL
UNION ALL
SELECT year, store_nbr, family, city, '2x_promos', SUM(total_sales)
FROM segments WHERE data_type IN ('Actual', 'Forecast - onpromotion_2x') GROUP BY ALL"""

# The published marts start from the cleaned rows of the gold fact instead of the daily sales.
TABLES["published_totals"] = """
SELECT DISTINCT CAST(year(date) AS INT) AS year, store_nbr, family, city, scenario FROM (
  SELECT date, store_nbr, family, city, 'Actual' AS data_type FROM gold
  UNION ALL SELECT date, store_nbr, family, city, data_type FROM stack WHERE data_type <> 'Actual') CROSS JOIN last_sale
JOIN (VALUES ('1x_promos', 'Actual'), ('1x_promos', 'Forecast - current'), ('2x_promos', 'Actual'),
             ('2x_promos', 'Forecast - onpromotion_2x')) s(scenario, data_type) USING (data_type)
WHERE year(date) >= year(d) - 1 AND month(date) <= month(d)"""

TABLES["growth"] = """
SELECT scenario, family, AVG(total_sales) FILTER (year = 2000) AS before, AVG(total_sales) FILTER (year = 2001) AS latest,
       (AVG(total_sales) FILTER (year = 2001) / AVG(total_sales) FILTER (year = 2000) - 1) * 100 AS ytd_growth
FROM totals GROUP BY 1, 2"""

TABLES["price_feed"] = """
SELECT CAST(ts AS DATE) AS day, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS price
FROM events WHERE event_type = 'purchase' GROUP BY 1"""

TABLES["merged_prices"] = """
SELECT date, dcoilwtico FROM oil_raw
UNION ALL SELECT day, price FROM price_feed WHERE day NOT IN (SELECT date FROM oil_raw)"""

TABLES["dense"] = """
SELECT sp.family, sp.state, sp.date, COALESCE(s.sales, 0) AS sales, s.onpromotion FROM (
  SELECT family, state, CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM series GROUP BY family, state) sp LEFT JOIN series s ON s.family = sp.family AND s.state = sp.state AND s.date = sp.date"""

TABLES["baselines"] = """
SELECT * FROM (
  UNPIVOT (
    SELECT date, family, state, sales AS y, LAG(sales, 7) OVER w AS naive_7, LAG(sales, 14) OVER w AS naive_14,
           LAG(sales, 28) OVER w AS naive_28,
           AVG(sales) OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS ma_7
    FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date)
  ) ON naive_7, naive_14, naive_28, ma_7 INTO NAME model_name VALUE prediction)
WHERE prediction IS NOT NULL"""


def _three_way(rows: str, last: str) -> str:
    return f"""
SELECT t.*, CASE WHEN t.date >= z - 179 THEN 'test' WHEN t.date >= z - 209 THEN 'validation' ELSE 'train' END AS split
FROM {rows} t CROSS JOIN (SELECT MAX(date) AS z FROM {last})"""


TABLES["stacked"] = _three_way("baselines", "baselines")
TABLES["pred_split"] = _three_way("pred", "pred")

TABLES["errors"] = """
SELECT *, y - prediction AS error, ABS(y - prediction) AS abs_error,
       COALESCE((y - prediction) / NULLIF(y, 0) * 100, 0) AS pct_error, CAST(isodow(date) - 1 AS INT) AS day_of_week,
       CAST(month(date) AS INT) AS month, CAST(day(date) AS INT) AS day, CAST(weekofyear(date) AS INT) AS week_of_year,
       CASE WHEN isodow(date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend FROM pred"""

TABLES["family_errors"] = """
SELECT *, y - prediction AS error, ABS(y - prediction) AS abs_error,
       COALESCE((y - prediction) / NULLIF(y, 0) * 100, 0) AS pct_error
FROM (SELECT family, date, SUM(y) AS y, SUM(prediction) AS prediction FROM pred GROUP BY 1, 2)"""

TABLES["scale_free"] = """
SELECT *, ABS(y - prediction) AS ae, CASE WHEN ABS(y) + ABS(prediction) > 0
       THEN ABS(y - prediction) / ((ABS(y) + ABS(prediction)) / 2) ELSE 0 END AS smape,
       ABS(y - LAG(y, 7) OVER (PARTITION BY family, state ORDER BY date)) AS nae FROM pred"""

TABLES["naive_folds"] = """
SELECT family, state, date, y, k AS fold, CAST(14 - (back - k * 7) AS INT) AS step_ahead,
       CASE WHEN 14 - (back - k * 7) <= 7 THEN l7 ELSE l14 END AS prediction FROM (
  SELECT date, family, state, sales AS y, LAG(sales, 7) OVER w AS l7, LAG(sales, 14) OVER w AS l14,
         row_number() OVER (PARTITION BY family, state ORDER BY date DESC) - 1 AS back
  FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date))
JOIN (VALUES (0), (1), (2), (3), (4)) f(k) ON back >= k * 7 AND back < k * 7 + 14"""

_SCALE_FREE = """ROUND(AVG(smape), 6) AS "sMAPE", ROUND(SUM(ae) / CASE WHEN SUM(y) > 0 THEN SUM(y) END, 6) AS "wMAPE",
       ROUND(AVG(ae) / CASE WHEN AVG(nae) > 0 THEN AVG(nae) END, 6) AS "MASE\""""

_REGRESSION = """COUNT(*) AS sample_count, ROUND(AVG(y), 6) AS avg_actual, ROUND(AVG(prediction), 6) AS avg_predicted,
       ROUND(AVG((y - prediction) * (y - prediction)), 6) AS mse, ROUND(SQRT(AVG((y - prediction) * (y - prediction))), 6) AS rmse,
       ROUND(AVG(ABS(y - prediction)), 6) AS mae,
       ROUND(1 - SUM((y - prediction) * (y - prediction)) / (COUNT(*) * VAR_POP(y)), 6) AS r2,
       ROUND(AVG(ABS((y - prediction) / NULLIF(y, 0))) * 100, 6) AS mape"""


def sql(body: str) -> str:
    """``body`` preceded by the derived tables it needs, in the order they need each other."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(TABLES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    tables = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name].strip()})" for name in needed)
    return f"WITH {tables}\n{body.strip()}" if needed else body.strip()


_BODIES: dict[str, str] = {}

# --- tiers ---------------------------------------------------------------------------------------

_BODIES["gold_daily_fact"] = "SELECT * FROM gold"
_BODIES["published_tables"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {rows}"
    for name, rows in {
        "bronze_stores": "stores",
        "bronze_transactions": "transactions",
        "bronze_oil": "oil_raw",
        "bronze_holidays": "holidays_raw",
        "bronze_train": "sales_raw",
        "bronze_test": "future_raw",
        "silver_stores": "stores",
        "silver_oil": "oil_ahead",
        "silver_train": "train",
        "silver_test": "test",
        "silver_holidays": "holidays",
        "silver_codes": "codes",
        "silver_test_predictions": "scenario_pred",
        "silver_validation_predictions": "validation_pred",
        "silver_model_predictions": "model_pred WHERE prediction IS NOT NULL",
        "silver_training": "training_ahead",
        "silver_testing": "testing",
        "gold_daily_store_family": "gold",
        "gold_sales_forecast": "fact",
        "platinum_totals": "(SELECT DISTINCT year, store_nbr, family, scenario FROM published_totals)",
        "platinum_city_cagr": "(SELECT DISTINCT scenario, city FROM published_totals)",
        "platinum_family_cagr": "(SELECT DISTINCT scenario, family FROM published_totals)",
        "platinum_family_cagr_delta": "(SELECT DISTINCT family FROM published_totals)",
    }.items()
)
_BODIES["gold_with_transactions"] = """
SELECT g.*, x.transactions FROM gold g LEFT JOIN transactions x ON x.date = g.date AND x.store_nbr = g.store_nbr"""
_BODIES["enriched_training"] = "SELECT * FROM training"
_BODIES["enriched_testing"] = "SELECT * FROM testing"
_BODIES["clean_sales"] = "SELECT * FROM train"
_BODIES["clean_future"] = "SELECT * FROM test"
_BODIES["etl_reconcile"] = """
SELECT 'before' AS stage, COUNT(*) AS row_count, SUM(sales) AS total FROM sales_raw
UNION ALL SELECT 'after', COUNT(*), SUM(sales) FROM train"""
_BODIES["date_spine"] = """
SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM holidays_raw"""
_BODIES["holiday_calendar"] = "SELECT * FROM holidays"
_BODIES["holiday_wide"] = """
SELECT date, MAX(is_holiday) FILTER (state = 'AFRICA') AS "AFRICA", MAX(is_holiday) FILTER (state = 'AMERICA') AS "AMERICA",
       MAX(is_holiday) FILTER (state = 'ASIA') AS "ASIA", MAX(is_holiday) FILTER (state = 'EUROPE') AS "EUROPE",
       MAX(is_holiday) FILTER (state = 'MIDDLE EAST') AS "MIDDLE EAST" FROM holidays GROUP BY date"""
_BODIES["oil_gap_fill"] = "SELECT * FROM oil"
_BODIES["normalize_flag"] = """
SELECT o_orderkey, flag_text, CASE WHEN flag_text IN ('True', 'true', '1') THEN 1 ELSE 0 END AS flag FROM (
  SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'False'
         WHEN 4 THEN 'false' WHEN 5 THEN '0' ELSE 'yes' END AS flag_text FROM orders)"""
_BODIES["calendar_features"] = """
SELECT date, CAST(dayofweek(date) + 1 AS INT) AS dow, CAST(day(date) AS INT) AS dom, CAST(weekofyear(date) AS INT) AS weekofyear,
       CAST(month(date) AS INT) AS month, CAST(year(date) AS INT) AS year,
       CASE WHEN day(date) IN (15, 30) THEN 1 ELSE 0 END AS is_salary_day, CAST(weekofyear(date) AS INT) AS week_of_year,
       CAST(quarter(date) AS INT) AS quarter, CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN day(date) <= 5 THEN 1 ELSE 0 END AS is_month_start, CASE WHEN day(date) >= 25 THEN 1 ELSE 0 END AS is_month_end,
       CAST(isodow(date) - 1 AS INT) AS weekday, CAST(date_trunc('week', date) AS DATE) AS week_start,
       CAST(date_trunc('week', date) AS DATE) + 6 AS week_end
FROM (SELECT CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sales)"""
_BODIES["log_roundtrip"] = """
SELECT date, store_nbr, family, sales, ROUND(ln(1 + sales), 6) AS log_sales, ROUND(GREATEST(exp(ln(1 + sales)) - 1, 0), 6) AS restored
FROM sales"""
_BODIES["category_codes"] = "SELECT * FROM codes"
_BODIES["large_category_codes"] = """
SELECT category, value, CAST(row_number() OVER (PARTITION BY category ORDER BY value) - 1 AS INT) AS code FROM (
  SELECT DISTINCT 'p_name' AS category, p_name AS value FROM part UNION SELECT DISTINCT 'p_type', p_type FROM part)"""
_BODIES["daily_total_check"] = "SELECT SUM(sales) AS total FROM gold WHERE date = DATE '1998-08-05'"
_BODIES["fact_preview"] = """
SELECT id, date, store_nbr, family, sales, is_holiday FROM gold WHERE sales = 1 AND is_holiday IS NOT NULL
ORDER BY date, store_nbr, family, id LIMIT 50"""

# --- files, merges, streaming --------------------------------------------------------------------

_BODIES["csv_roundtrip"] = "SELECT * FROM sales"
_BODIES["csv_contract_ingest"] = "SELECT * FROM stores"
_BODIES["csv_inferred_profile"] = """
SELECT 'stores' AS file, 'loaded' AS status, COUNT(*) AS row_count, 5 AS column_count FROM stores
UNION ALL SELECT 'oil', 'loaded', COUNT(*), 2 FROM oil_raw
UNION ALL SELECT 'transactions', 'loaded', COUNT(*), 3 FROM transactions
UNION ALL SELECT 'holidays', 'missing', 0, 0"""
_BODIES["scenario_append"] = "SELECT * FROM scenario_pred"
_BODIES["partitioned_write_prune"] = """
SELECT *, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month FROM sales WHERE year(date) = 1998"""
_BODIES["schema_evolution_union"] = """
SELECT date, store_nbr, family, sales, CASE WHEN date >= DATE '1998-06-01' THEN onpromotion END AS onpromotion FROM sales"""
_BODIES["align_to_schema"] = """
SELECT date, store_nbr, family, SUM(sales) AS sales, CAST(NULL AS INT) AS onpromotion FROM sales_raw GROUP BY 1, 2, 3"""
_BODIES["model_metric_pivot"] = """
SELECT family, 'model_metrics_' || model_name AS period,
       ROUND(1 - SUM((y - prediction) * (y - prediction)) / (COUNT(*) * VAR_POP(y)), 2) AS r2
FROM baselines WHERE model_name IN ('naive_7', 'naive_14', 'ma_7') GROUP BY family, model_name"""
_BODIES["merge_insert_only"] = "SELECT * FROM merged_prices"
_BODIES["merge_upsert"] = """
SELECT s.date, s.store_nbr, s.family, s.sales + CASE WHEN f.date IS NULL THEN 0 ELSE 25 END AS sales,
       CASE WHEN f.date IS NULL THEN s.onpromotion ELSE 1 END AS onpromotion
FROM sales s LEFT JOIN (SELECT date, store_nbr, family FROM sales ORDER BY 1, 2, 3 LIMIT 5) f
  ON f.date = s.date AND f.store_nbr = s.store_nbr AND f.family = s.family
UNION ALL SELECT date + 1, store_nbr, family, sales, onpromotion FROM sales WHERE date = (SELECT d FROM last_sale)"""
_BODIES["stream_price_ingest"] = "SELECT * FROM price_feed"
_BODIES["stream_price_silver"] = "SELECT day AS date, price AS dcoilwtico FROM price_feed"
_BODIES["stream_idempotent"] = """
SELECT run, table_name, n AS row_count FROM (VALUES ('first'), ('second')) r(run)
CROSS JOIN (VALUES ('bronze'), ('silver')) t(table_name) CROSS JOIN (SELECT COUNT(*) AS n FROM price_feed)"""
_BODIES["stream_price_merge"] = "SELECT * FROM merged_prices"
_BODIES["rows_per_year"] = """
SELECT CAST(year(date) AS INT) AS year, COUNT(*) AS row_count FROM merged_prices GROUP BY 1 ORDER BY 2 DESC, 1"""

# --- series --------------------------------------------------------------------------------------

_BODIES["aggregate_granularity"] = """
SELECT city, family, date, AVG(sales) AS sales, CAST(SUM(onpromotion) AS BIGINT) AS onpromotion, MAX(onpromotion) AS top_promotion
FROM sales JOIN stores USING (store_nbr) GROUP BY 1, 2, 3"""
_BODIES["lag_features"] = """
SELECT * EXCLUDE (rn) REPLACE (CAST(onpromotion AS BIGINT) AS onpromotion) FROM (
  SELECT *, LAG(sales, 1) OVER w AS lag_1, LAG(sales, 7) OVER w AS lag_7, LAG(sales, 14) OVER w AS lag_14,
         LAG(sales, 28) OVER w AS lag_28, LAG(sales, 56) OVER w AS lag_56, LAG(sales, 71) OVER w AS lag_71, row_number() OVER w AS rn
  FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date)) WHERE rn > 71"""
_BODIES["moving_averages"] = """
SELECT *, ROUND(AVG(sales) OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS ma_7,
       ROUND(AVG(sales) OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6) AS ma_28,
       ROUND(AVG(sales) OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS ma_with_current_7,
       ROUND(AVG(sales) OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW), 6) AS ma_with_current_28
FROM series"""
_BODIES["rolling_stats"] = """
SELECT *, LAG(sales, 7) OVER w AS sales_lag_7, LAG(sales, 14) OVER w AS sales_lag_14, LAG(sales, 30) OVER w AS sales_lag_30,
       ROUND(AVG(sales) OVER w7, 6) AS sales_rolling_mean_7, ROUND(AVG(sales) OVER w14, 6) AS sales_rolling_mean_14,
       ROUND(STDDEV_SAMP(sales) OVER w7, 6) AS sales_rolling_std_7, CAST(SUM(onpromotion) OVER w7 AS BIGINT) AS promo_rolling_sum_7
FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date),
  w7 AS (PARTITION BY family, state ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
  w14 AS (PARTITION BY family, state ORDER BY date ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)"""
_BODIES["series_features"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT store_nbr, family, date, sales, CAST(onpromotion AS BIGINT) AS onpromotion, LAG(sales, 1) OVER w AS lag_1,
         LAG(sales, 7) OVER w AS lag_7, LAG(sales, 14) OVER w AS lag_14, LAG(sales, 28) OVER w AS lag_28,
         ROUND(AVG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS ma_7,
         ROUND(AVG(sales) OVER (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6) AS ma_28,
         CAST(dayofweek(date) + 1 AS INT) AS dow, CAST(day(date) AS INT) AS dom, CAST(weekofyear(date) AS INT) AS weekofyear,
         CAST(month(date) AS INT) AS month, CAST(year(date) AS INT) AS year,
         CASE WHEN day(date) IN (15, 30) THEN 1 ELSE 0 END AS is_salary_day, row_number() OVER w AS rn
  FROM sales WINDOW w AS (PARTITION BY store_nbr, family ORDER BY date)) WHERE rn > 28"""
_BODIES["dense_series"] = "SELECT family, state, date, sales, COALESCE(onpromotion, 0) AS onpromotion FROM dense"
_BODIES["active_period"] = """
SELECT s.*, a.active_start_date FROM sales s
JOIN (SELECT store_nbr, family, MIN(date) AS active_start_date FROM sales WHERE sales > 0 GROUP BY 1, 2) a USING (store_nbr, family)
WHERE s.date >= a.active_start_date"""
_BODIES["stable_period"] = """
SELECT t.*, b.stable_start_date FROM dense t JOIN (
  SELECT family, state, MIN(date) AS stable_start_date FROM (
    SELECT *, SUM(CASE WHEN sales > 0 THEN 1 ELSE 0 END)
      OVER (PARTITION BY family, state ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS active
    FROM dense) WHERE active >= 7 GROUP BY 1, 2) b USING (family, state)
WHERE t.date >= b.stable_start_date"""
_BODIES["trainable_series"] = """
, stable AS (SELECT t.* FROM sales t JOIN (
  SELECT store_nbr, family, MIN(date) AS stable_start_date FROM (
    SELECT *, SUM(CASE WHEN sales > 0 THEN 1 ELSE 0 END)
      OVER (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS active
    FROM sales) WHERE active >= 7 GROUP BY 1, 2) b USING (store_nbr, family) WHERE t.date >= b.stable_start_date)
SELECT t.* FROM stable t SEMI JOIN (
  SELECT store_nbr, family FROM stable GROUP BY 1, 2 HAVING COUNT(DISTINCT date) >= 90 AND SUM(sales) >= 0) k USING (store_nbr, family)"""
_BODIES["sales_stats"] = """
SELECT family, MIN(sales) AS min_sales, ROUND(AVG(sales), 6) AS avg_sales, MAX(sales) AS max_sales,
       ROUND(STDDEV_SAMP(sales), 6) AS std_sales FROM sales GROUP BY family"""
_BODIES["seasonal_naive"] = """
SELECT family, state, date, y, model_name, ROUND(prediction, 6) AS prediction FROM baselines WHERE model_name <> 'naive_28'"""
_BODIES["weekly_resample"] = """
, weekly AS (SELECT family, CAST(date_trunc('week', date) AS DATE) + 6 AS date, SUM(sales) AS sales FROM sales GROUP BY 1, 2),
weeks AS (SELECT family, CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 7 DAY)) AS DATE) AS date FROM weekly GROUP BY 1)
SELECT family, date, COALESCE(sales, 0) AS sales FROM weeks LEFT JOIN weekly USING (family, date)"""
_BODIES["weekly_resample_by_store"] = """
, weekly AS (SELECT family, store_nbr, CAST(date_trunc('week', date) AS DATE) + 6 AS date, SUM(sales) AS sales FROM sales GROUP BY 1, 2, 3),
weeks AS (SELECT family, store_nbr, CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 7 DAY)) AS DATE) AS date
          FROM weekly GROUP BY 1, 2)
SELECT family, store_nbr, date, COALESCE(sales, 0) AS sales FROM weeks LEFT JOIN weekly USING (family, store_nbr, date)"""
_BODIES["split_by_date"] = """
SELECT s.*, CASE WHEN date <= DATE '2000-12-31' THEN 'train' ELSE 'test' END AS split FROM series s
SEMI JOIN (SELECT family, state FROM series GROUP BY 1, 2 HAVING COUNT(*) >= 56) k USING (family, state)"""
_BODIES["split_horizon"] = """
SELECT * EXCLUDE (rn, n), CASE WHEN rn > n - 28 THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY family, state ORDER BY date) AS rn, COUNT(*) OVER (PARTITION BY family, state) AS n
  FROM series) WHERE n >= 1028"""
_BODIES["split_train_val_test"] = _three_way("series", "series")
_BODIES["split_shares"] = f"""
SELECT split, COUNT(*) AS row_count, MIN(date) AS min_date, MAX(date) AS max_date,
       ROUND(COUNT(*) / SUM(COUNT(*)) OVER () * 100, 6) AS share_pct FROM ({_three_way("series", "series")}) GROUP BY split"""
_BODIES["short_groups"] = """
SELECT store_nbr, family, COUNT(*) FILTER (date < (SELECT MAX(date) FROM sales) - 209) AS train_rows
FROM sales GROUP BY 1, 2 HAVING train_rows < 95"""
_BODIES["split_last_days"] = """
SELECT s.*, CASE WHEN date > d - 28 THEN 'validation' ELSE 'train' END AS split FROM sales s CROSS JOIN last_sale"""
_BODIES["split_fraction"] = """
SELECT s.*, split_date, CASE WHEN date < split_date THEN 'train' ELSE 'test' END AS split FROM sales s
JOIN (SELECT family, MIN(date) + CAST(floor((MAX(date) - MIN(date)) * 0.8::DOUBLE) AS INT) AS split_date FROM sales GROUP BY 1) USING (family)"""
_BODIES["training_eligibility"] = """
SELECT *, CASE WHEN row_count < 1000 THEN 'insufficient_data' WHEN clean_rows < 1000 THEN 'too_many_nulls'
               WHEN train_rows < 100 OR test_rows < 20 THEN 'insufficient_split' ELSE 'eligible' END AS reason FROM (
  SELECT family, state, COUNT(*) AS row_count, COUNT(*) FILTER (clean) AS clean_rows,
         COUNT(*) FILTER (clean AND date < cut) AS train_rows, COUNT(*) FILTER (clean AND date >= cut) AS test_rows FROM (
    SELECT *, LAG(sales, 30) OVER w IS NOT NULL AND STDDEV_SAMP(sales) OVER w7 IS NOT NULL AS clean,
           MIN(date) OVER g + CAST(floor((MAX(date) OVER g - MIN(date) OVER g) * 0.8::DOUBLE) AS INT) AS cut
    FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date), g AS (PARTITION BY family, state),
      w7 AS (PARTITION BY family, state ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) GROUP BY 1, 2)"""
_BODIES["set_difference"] = """
SELECT family, sales FROM sales CROSS JOIN last_sale WHERE date <= d - 28
EXCEPT SELECT family, sales FROM sales CROSS JOIN last_sale WHERE date > d - 28"""
_BODIES["backtest_folds"] = """
SELECT family, state, k AS fold, n - back AS train_rows, CAST(14 AS BIGINT) AS test_rows, date AS cutoff_date FROM (
  SELECT *, row_number() OVER (PARTITION BY family, state ORDER BY date DESC) - 1 AS back, COUNT(*) OVER (PARTITION BY family, state) AS n
  FROM series) JOIN (VALUES (0), (1), (2), (3)) f(k) ON back = 14 + k * 14"""
_BODIES["backtest_naive"] = f"""
, folded AS (
  SELECT family, state, date, sales AS y, CAST(back // 14 AS INT) AS fold, CASE WHEN back % 14 >= 7 THEN l7 ELSE l14 END AS prediction FROM (
    SELECT *, LAG(sales, 7) OVER w AS l7, LAG(sales, 14) OVER w AS l14,
           row_number() OVER (PARTITION BY family, state ORDER BY date DESC) - 1 AS back
    FROM series WINDOW w AS (PARTITION BY family, state ORDER BY date)) WHERE back < 56)
SELECT fold, {_SCALE_FREE}, 'portfolio' AS level FROM (
  SELECT *, ABS(y - prediction) AS ae, ABS(y - prediction) / ((ABS(y) + ABS(prediction)) / 2) AS smape,
         ABS(y - LAG(y, 7) OVER (PARTITION BY family, state, fold ORDER BY date)) AS nae FROM folded) GROUP BY fold"""
_BODIES["backtest_naive_predictions"] = "SELECT * FROM naive_folds WHERE prediction IS NOT NULL"

# --- accuracy ------------------------------------------------------------------------------------

_BODIES["metrics_by_series"] = f"SELECT family, state, {_SCALE_FREE} FROM scale_free GROUP BY 1, 2"
_BODIES["metrics_portfolio"] = f"SELECT {_SCALE_FREE}, 'portfolio' AS level FROM scale_free"
_BODIES["metrics_levels"] = f"""
SELECT family, state, 'family, state' AS level, {_SCALE_FREE} FROM scale_free GROUP BY 1, 2
UNION ALL SELECT family, NULL, 'family', {_SCALE_FREE} FROM scale_free GROUP BY 1
UNION ALL SELECT NULL, state, 'state', {_SCALE_FREE} FROM scale_free GROUP BY state
UNION ALL SELECT NULL, NULL, 'portfolio', {_SCALE_FREE} FROM scale_free"""
_BODIES["portfolio_long"] = f"""
UNPIVOT (SELECT {_SCALE_FREE} FROM scale_free) ON "sMAPE", "wMAPE", "MASE" INTO NAME metric VALUE value"""
_BODIES["wmape_by_family"] = """
SELECT family, ROUND(MIN(w), 6) AS "min_wMAPE", ROUND(MAX(w), 6) AS "max_wMAPE", ROUND(quantile_disc(w, 0.5), 6) AS "median_wMAPE"
FROM (SELECT family, state, SUM(ae) / SUM(y) AS w FROM scale_free GROUP BY 1, 2) GROUP BY family"""
_BODIES["regression_metrics"] = f"SELECT {_REGRESSION} FROM pred"
_BODIES["worst_best_groups"] = f"""
, m AS (SELECT family, state, {_REGRESSION} FROM pred GROUP BY 1, 2)
(SELECT *, 'worst' AS side FROM m ORDER BY rmse DESC, family, state LIMIT 5)
UNION ALL (SELECT *, 'best' FROM m ORDER BY rmse, family, state LIMIT 5)"""
_BODIES["model_comparison"] = f"SELECT model_name, split, {_REGRESSION} FROM stacked GROUP BY 1, 2"
_BODIES["best_model"] = """
SELECT model_name, ROUND(SQRT(AVG((y - prediction) * (y - prediction))), 6) AS rmse FROM stacked
WHERE split = 'validation' GROUP BY 1 ORDER BY 2, 1 LIMIT 1"""
_BODIES["rmsle"] = """
SELECT split, ROUND(SQRT(AVG((ln(1 + prediction) - ln(1 + y)) * (ln(1 + prediction) - ln(1 + y)))), 6) AS rmsle
FROM pred_split GROUP BY 1"""
_BODIES["split_metrics"] = "SELECT model_name, " + ", ".join(
    f"""ROUND(SQRT(AVG((y - prediction) * (y - prediction)) FILTER (split = '{s}')), 6) AS {s}_rmse,
       ROUND(AVG(ABS(y - prediction)) FILTER (split = '{s}'), 6) AS {s}_mae,
       ROUND(AVG(ABS((y - prediction) / (y + 1e-10) * 100)) FILTER (split = '{s}'), 6) AS {s}_mape"""
    for s in ("train", "validation", "test")
) + " FROM stacked GROUP BY 1"
_BODIES["overfit_flag"] = """
SELECT family, ROUND(t, 6) AS train_rmse, ROUND(v, 6) AS validation_rmse, t < v * 0.7 AS possible_overfit FROM (
  SELECT family, SQRT(AVG((y - prediction) * (y - prediction)) FILTER (split = 'train')) AS t,
         SQRT(AVG((y - prediction) * (y - prediction)) FILTER (split = 'validation')) AS v FROM pred_split GROUP BY 1)"""
_BODIES["error_by_date"] = """
SELECT date, split, y, prediction, y - prediction AS error, ABS(y - prediction) AS abs_error,
       ROUND((y - prediction) / (y + 1e-10) * 100, 6) AS pct_error
FROM (SELECT date, split, SUM(y) AS y, SUM(prediction) AS prediction FROM pred_split GROUP BY 1, 2)"""
_DRIFT_BINS = """
SELECT feature, CAST(CASE WHEN v IS NULL THEN -1 ELSE (v > 5)::INT + (v > 10)::INT + (v > 20)::INT + (v > 40)::INT + (v > 80)::INT END
                     AS INTEGER) AS bin,
       COUNT(*) FILTER (split = 'train') AS base_count, COUNT(*) FILTER (split = 'test') AS other_count
FROM (SELECT 'y' AS feature, CAST(y AS DOUBLE) AS v, split FROM pred_split
      UNION ALL SELECT 'prediction', CAST(prediction AS DOUBLE), split FROM pred_split)
WHERE split IN ('train', 'test') GROUP BY 1, 2"""
_BODIES["drift_bins"] = _DRIFT_BINS
_BODIES["drift_report"] = f"""
SELECT feature, ROUND(SUM((b - a) * ln(b / a)), 6) AS psi, ROUND(MAX(apart) FILTER (bin >= 0), 6) AS ks,
       ROUND(COALESCE(MAX(base_share) FILTER (bin < 0), 0), 6) AS base_null_share,
       ROUND(COALESCE(MAX(other_share) FILTER (bin < 0), 0), 6) AS other_null_share
FROM (SELECT *, GREATEST(base_share, 0.0001) AS a, GREATEST(other_share, 0.0001) AS b FROM (
  SELECT feature, bin, base_count / SUM(base_count) OVER w AS base_share, other_count / SUM(other_count) OVER w AS other_share,
         ABS(SUM(base_count) FILTER (bin >= 0) OVER u / SUM(base_count) FILTER (bin >= 0) OVER w
           - SUM(other_count) FILTER (bin >= 0) OVER u / SUM(other_count) FILTER (bin >= 0) OVER w) AS apart
  FROM ({_DRIFT_BINS}) WINDOW w AS (PARTITION BY feature), u AS (PARTITION BY feature ORDER BY bin)))
GROUP BY feature"""
_BODIES["family_moments"] = """
SELECT family, COUNT(*) AS row_count, SUM(sales) AS sum_sales, SUM(sales * sales) AS sum_sales_sales,
       CAST(SUM(onpromotion) AS DOUBLE) AS sum_onpromotion, CAST(SUM(dow) AS DOUBLE) AS sum_dow,
       SUM(onpromotion * sales) AS sum_onpromotion_sales, SUM(dow * sales) AS sum_dow_sales,
       CAST(SUM(onpromotion * onpromotion) AS DOUBLE) AS sum_onpromotion_onpromotion,
       CAST(SUM(onpromotion * dow) AS DOUBLE) AS sum_onpromotion_dow, CAST(SUM(dow * dow) AS DOUBLE) AS sum_dow_dow
FROM (SELECT *, dayofweek(date) + 1 AS dow FROM series) GROUP BY family"""
_BODIES["family_promo_effect"] = """
SELECT family, COUNT(*) AS row_count,
       ROUND(COALESCE(CASE WHEN var_pop(onpromotion) > 0 THEN regr_slope(sales, onpromotion) END, 0), 6) AS slope,
       ROUND(CASE WHEN var_pop(onpromotion) > 0 THEN regr_intercept(sales, onpromotion) ELSE AVG(sales) END, 6) AS intercept
FROM series GROUP BY family"""
_BODIES["split_summary"] = """
SELECT split, COUNT(*) AS row_count, MIN(date) AS min_date, MAX(date) AS max_date,
       ROUND(AVG(y), 6) AS y_mean, ROUND(STDDEV_SAMP(y), 6) AS y_std, MIN(y) AS y_min, MAX(y) AS y_max,
       ROUND(AVG(prediction), 6) AS prediction_mean, ROUND(STDDEV_SAMP(prediction), 6) AS prediction_std,
       MIN(prediction) AS prediction_min, MAX(prediction) AS prediction_max FROM pred_split GROUP BY 1"""
_BODIES["forecast_errors"] = "SELECT * REPLACE (ROUND(pct_error, 6) AS pct_error) FROM errors"
_BODIES["prediction_sample"] = """
SELECT *, prediction - y AS error, ABS(prediction - y) AS abs_error, ROUND(ABS((prediction - y) / NULLIF(y, 0)) * 100, 6) AS pct_error
FROM pred ORDER BY date, family, state LIMIT 1000"""
_BODIES["error_summary"] = """
SELECT ROUND(AVG(error), 6) AS mean_error, ROUND(AVG(abs_error), 6) AS mae, ROUND(AVG(pct_error), 6) AS mean_pct_error,
       ROUND(SQRT(AVG(error * error)), 6) AS rmse FROM family_errors"""
_BODIES["family_error_summary"] = """
SELECT family, ROUND(AVG(error), 2) AS error, ROUND(AVG(abs_error), 2) AS abs_error, ROUND(AVG(pct_error), 2) AS pct_error
FROM family_errors GROUP BY 1"""
_BODIES["family_groups"] = """
SELECT family, ROUND(AVG(abs_error), 6) AS abs_error,
       CASE WHEN AVG(abs_error) <= (SELECT AVG(abs_error) FROM family_errors) THEN 'low_error' ELSE 'high_error' END AS family_group
FROM family_errors GROUP BY 1"""
_BODIES["crosstab_pct"] = "SELECT family, " + ", ".join(
    f'ROUND(COUNT(*) FILTER (day_of_week = {d}) / COUNT(*) * 100, 6) AS "{d}"' for d in range(7)
) + " FROM errors GROUP BY 1"
_BODIES["topk_values"] = """
SELECT state, family, n AS row_count, CAST(rk AS INT) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY n DESC, family) AS rk
  FROM (SELECT state, family, COUNT(*) AS n FROM series GROUP BY 1, 2)) WHERE rk <= 3"""
_BODIES["validation_residuals"] = "SELECT *, sales - predicted_sales AS residual FROM validation_pred"
_BODIES["daily_actual_vs_pred"] = """
SELECT date, SUM(sales) AS actual, SUM(predicted_sales) AS predicted, SUM(sales) - SUM(predicted_sales) AS residual
FROM validation_pred GROUP BY 1"""
_BODIES["weekly_actual_vs_pred"] = """
SELECT CAST(date_trunc('week', date) AS DATE) AS week, SUM(y) AS actual, SUM(prediction) AS predicted,
       SUM(y) - SUM(prediction) AS residual FROM pred GROUP BY 1"""
_BODIES["top_families_daily"] = """
SELECT family, date, SUM(y) AS actual, SUM(prediction) AS predicted, SUM(y) - SUM(prediction) AS residual FROM pred
WHERE family IN (SELECT family FROM pred GROUP BY 1 ORDER BY SUM(y) DESC, family LIMIT 3) GROUP BY 1, 2"""
_BODIES["baseline_prediction_range"] = """
SELECT model_name, split, ROUND(MIN(prediction), 6) AS min_pred, ROUND(MAX(prediction), 6) AS max_pred,
       ROUND(AVG(prediction), 6) AS avg_pred, ROUND(STDDEV_SAMP(prediction), 6) AS std_pred FROM stacked GROUP BY 1, 2"""
_BODIES["baseline_fleet"] = """
SELECT COUNT(*) AS models, ROUND(AVG(rmse), 6) AS avg_rmse, ROUND(AVG(mae), 6) AS avg_mae, ROUND(AVG(r2), 6) AS avg_r2,
       ROUND(MEDIAN(r2), 6) AS median_r2, ROUND(MAX(r2), 6) AS best_r2, arg_max(family, r2) AS best_family,
       ROUND(MIN(r2), 6) AS worst_r2, arg_min(family, r2) AS worst_family FROM (
  SELECT family, SQRT(AVG((y - prediction) * (y - prediction))) AS rmse, AVG(ABS(y - prediction)) AS mae,
         1 - SUM((y - prediction) * (y - prediction)) / (COUNT(*) * VAR_POP(y)) AS r2 FROM pred GROUP BY 1)"""

# --- quality -------------------------------------------------------------------------------------

_BODIES["duplicate_keys"] = "SELECT id, COUNT(*) AS row_count FROM sales_raw GROUP BY 1 HAVING COUNT(*) > 1"
_BODIES["orphan_rows"] = "SELECT * FROM sales WHERE date NOT IN (SELECT date FROM oil)"
_BODIES["null_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count FROM sales_raw"
    for c in ("id", "date", "store_nbr", "family", "sales", "onpromotion")
)
_BODIES["grain_profile"] = "SELECT grain, k AS distinct_keys, n AS row_count, k = n AS is_unique FROM (" + " UNION ALL ".join(
    f"SELECT '{name}' AS grain, (SELECT COUNT(*) FROM (SELECT DISTINCT {cols} FROM train)) AS k, (SELECT COUNT(*) FROM train) AS n"
    for name, cols in (
        ("date", "date"),
        ("date_store", "date, store_nbr"),
        ("date_family", "date, family"),
        ("date_store_family", "date, store_nbr, family"),
    )
) + ")"
_BODIES["fd_violations"] = """
SELECT id, COUNT(*) AS combinations FROM (SELECT DISTINCT id, date, store_nbr, family FROM sales_raw) GROUP BY 1 HAVING COUNT(*) > 1"""
_BODIES["store_attributes"] = """
SELECT store_nbr, COUNT(*) AS combinations FROM (SELECT DISTINCT store_nbr, store_type, state, city FROM gold)
GROUP BY 1 HAVING COUNT(*) > 1"""


def _contract(table: str, rows: str, key: str, required: str, foreign: bool = False) -> str:
    rules = [
        f"SELECT '{table}' AS table_name, 'key({key})' AS rule, COUNT(*) AS violations "
        f"FROM (SELECT {key} FROM {rows} GROUP BY {key} HAVING COUNT(*) > 1)"
    ]
    rules += [
        f"SELECT '{table}', 'not_null({c})', COUNT(*) FROM {rows} WHERE {c} IS NULL" for c in required.split(", ")
    ]
    if foreign:
        rules.append(
            f"SELECT '{table}', 'foreign(store_nbr -> stores.store_nbr)', COUNT(*) FROM {rows} "
            "WHERE store_nbr NOT IN (SELECT store_nbr FROM stores)"
        )
    return " UNION ALL ".join(rules)


_BODIES["contract_report"] = " UNION ALL ".join(
    [
        _contract("stores", "stores", "store_nbr", "store_nbr"),
        _contract("transactions", "transactions", "date, store_nbr", "date, store_nbr", True),
        _contract("oil", "oil_raw", "date", "date"),
        _contract("holidays", "holidays_raw", "date, type, locale, locale_name", "date, type, locale, locale_name"),
        _contract("train", "sales_raw", "date, store_nbr, family", "id, date, store_nbr, family", True),
        _contract("test", "future_raw", "id", "id, date, store_nbr, family", True),
    ]
)
_COLUMNS = (
    "date", "store_nbr", "family", "onpromotion", "city", "state", "type", "cluster", "is_holiday", "dcoilwtico", "family_code",
    "city_code", "state_code", "type_code", "day_of_week", "day_of_month", "month", "year", "is_salary_day",
)
_BODIES["schema_diff"] = " UNION ALL ".join(
    [
        f"SELECT '{c}' AS column_name, (SELECT COUNT({c}) FROM training) AS left_values, "
        f"(SELECT COUNT({c}) FROM testing) AS right_values, 'both' AS present_in"
        for c in _COLUMNS
    ]
    + ["SELECT 'sales', (SELECT COUNT(sales) FROM training), NULL, 'left'"]
)
_BODIES["row_policy"] = """
SELECT reader, city, COUNT(*) AS row_count, SUM(sales) AS sales FROM gold
JOIN (VALUES ('admin'), ('local'), ('elsewhere'), ('both')) r(reader)
  ON reader = 'admin' OR (reader IN ('local', 'both') AND city = 'NATION_11') OR (reader IN ('elsewhere', 'both') AND city <> 'NATION_11')
GROUP BY 1, 2"""
_BODIES["visible_cities"] = "SELECT DISTINCT city FROM gold WHERE city <> 'NATION_11'"
_BODIES["row_policy_view"] = "SELECT city, store_nbr, date, family, sales FROM gold WHERE city <> 'NATION_11'"

# --- forecast fact, scenarios, growth ------------------------------------------------------------

_BODIES["sales_forecast_fact"] = "SELECT * FROM fact"
_BODIES["stored_forecast_fact"] = """
SELECT *, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month FROM fact"""
_BODIES["backtest_records"] = "SELECT * FROM fact WHERE record_type = 'backtest'"


def _refreshed(old: str) -> str:
    return f"""
, fresh AS (
  SELECT date, family, store_nbr, lag_4 AS forecast FROM lagged
  WHERE lag_4 IS NOT NULL AND date > (SELECT CAST(d - INTERVAL 120 DAY AS DATE) FROM last_sale))
SELECT o.date, o.family, o.store_nbr, o.sales, CASE WHEN f.date IS NULL THEN o.forecast ELSE f.forecast END AS forecast, o.split,
       o.record_type, o.model_name, o.model_type, CASE WHEN f.date IS NULL THEN o.model_version ELSE 'v3' END AS model_version,
       o.model_strategy, CASE WHEN f.date IS NULL THEN o.best_iteration ELSE 4 END AS best_iteration,
       CASE WHEN f.date IS NULL THEN o.prediction_timestamp ELSE TIMESTAMP '2002-01-03 00:00:00' END AS prediction_timestamp,
       o.created_at, CASE WHEN f.date IS NULL THEN o.updated_at ELSE TIMESTAMP '2002-03-01 00:00:00' END AS updated_at
FROM {old} o LEFT JOIN fresh f ON o.record_type = 'forecast' AND o.model_name = 'previous'
  AND f.date = o.date AND f.family = o.family AND f.store_nbr = o.store_nbr
UNION ALL
SELECT date, family, store_nbr, NULL, forecast, 'test', 'forecast', 'previous', 'lag', 'v3', 'global', 4,
       TIMESTAMP '2002-01-03 00:00:00', TIMESTAMP '2002-03-01 00:00:00', TIMESTAMP '2002-03-01 00:00:00'
FROM fresh ANTI JOIN (SELECT date, family, store_nbr FROM {old} WHERE record_type = 'forecast' AND model_name = 'previous')
  USING (date, family, store_nbr)"""


_BODIES["refresh_forecasts"] = _refreshed("latest")
_BODIES["refresh_stored_forecasts"] = (
    _refreshed("fact").replace("\nSELECT o.date", "\n, merged AS (SELECT o.date", 1)
    + ")\nSELECT *, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month FROM merged"
)
_BODIES["latest_forecast"] = "SELECT * FROM latest"
_BODIES["combined_sales_view"] = """
SELECT date, family, store_nbr, COALESCE(sales, forecast) AS value, CASE WHEN sales IS NOT NULL THEN 'actual' ELSE 'forecast' END AS data_type,
       model_name, model_version, prediction_timestamp FROM latest
UNION ALL SELECT date, family, store_nbr, sales, 'actual', NULL, NULL, NULL FROM fact WHERE record_type = 'actual'"""
_BODIES["forecast_accuracy"] = """
SELECT * REPLACE (ROUND(mae, 6) AS mae, ROUND(mape, 6) AS mape, ROUND(rmse, 6) AS rmse) FROM accuracy"""
_BODIES["accuracy_rollup"] = """
SELECT model_name, family, CAST(SUM(num_predictions) AS BIGINT) AS total_predictions, ROUND(AVG(mae), 2) AS avg_mae,
       ROUND(AVG(mape) * 100, 2) AS avg_mape_pct, ROUND(AVG(rmse), 2) AS avg_rmse FROM accuracy GROUP BY 1, 2 ORDER BY 1, 2"""
_BODIES["record_type_summary"] = """
SELECT record_type, model_name, COUNT(*) AS record_count, MIN(date) AS min_date, MAX(date) AS max_date FROM fact GROUP BY 1, 2"""
_BODIES["family_drilldown"] = """
SELECT date, store_nbr, sales AS actual, forecast, ABS(sales - forecast) AS absolute_error,
       ROUND(ABS(sales - forecast) * 100 / NULLIF(sales, 0), 6) AS pct_error, model_name, model_version
FROM fact WHERE record_type = 'backtest' AND family = 'PROMO' AND store_nbr = 1
ORDER BY date DESC, model_name, model_version LIMIT 10"""
_BODIES["future_forecasts"] = """
SELECT date, family, store_nbr, forecast, model_name, model_version FROM latest WHERE date >= DATE '2001-10-15'
ORDER BY date, family, store_nbr, model_name LIMIT 20"""
_BODIES["scenario_features"] = """
SELECT date, store_nbr, family, onpromotion, 'current' AS scenario FROM future
UNION ALL SELECT date, store_nbr, family, onpromotion * 2, 'onpromotion_2x' FROM future"""
_BODIES["sales_and_forecasts"] = "SELECT * FROM stack ORDER BY date, family, city, store_nbr, data_type"
_BODIES["data_type_bounds"] = "SELECT data_type, MIN(date) AS min_date, MAX(date) AS max_date FROM stack GROUP BY 1"
_BODIES["ytd_segments"] = "SELECT * FROM segments"
_BODIES["scenario_totals"] = "SELECT * FROM totals"
_BODIES["growth_by_city"] = """
SELECT scenario, city, ROUND(b, 6) AS "2000", ROUND(l, 6) AS "2001", ROUND((l / b - 1) * 100, 6) AS ytd_growth FROM (
  SELECT scenario, city, AVG(total_sales) FILTER (year = 2000) AS b, AVG(total_sales) FILTER (year = 2001) AS l FROM totals GROUP BY 1, 2)"""
_BODIES["growth_by_family"] = """
SELECT scenario, family, ROUND(before, 6) AS "2000", ROUND(latest, 6) AS "2001", ROUND(ytd_growth, 6) AS ytd_growth FROM growth"""
_BODIES["growth_of_sums"] = """
SELECT scenario, family, b AS "2000", l AS "2001", ROUND((l / b - 1) * 100, 6) AS ytd_growth FROM (
  SELECT scenario, family, SUM(total_sales) FILTER (year = 2000) AS b, SUM(total_sales) FILTER (year = 2001) AS l FROM totals GROUP BY 1, 2)"""
_BODIES["growth_delta"] = """
SELECT family, ROUND(a, 6) AS "1x_promos", ROUND(b, 6) AS "2x_promos", ROUND(b - a, 6) AS diff FROM (
  SELECT family, MAX(ytd_growth) FILTER (scenario = '1x_promos') AS a, MAX(ytd_growth) FILTER (scenario = '2x_promos') AS b
  FROM growth GROUP BY 1) ORDER BY b - a DESC, family"""
_BODIES["model_reload_diff"] = """
SELECT COUNT(*) AS row_count, CAST(0 AS DOUBLE) AS mean_abs_difference FROM (
  SELECT *, row_number() OVER (PARTITION BY family, state ORDER BY date) AS rn FROM series) CROSS JOIN last_sale
WHERE rn > 28 AND date > d - 28"""
_BODIES["family_year_pivot"] = "SELECT family, " + ", ".join(
    f'SUM(sales) FILTER (year(date) = {y}) AS "{y}"' for y in range(1995, 2002)
) + ' FROM sales GROUP BY 1 ORDER BY "2001" DESC, family'


def _statement(body: str) -> str:
    """A body may go on with further tables of its own, introduced by a leading comma."""
    text = body.strip()
    if text.startswith(","):
        return sql(text).replace(f"\n{text}", text, 1)
    return sql(text)


ORACLE = {name: _statement(body) for name, body in _BODIES.items()}
