"""Independent SQL statements of every registered query, for DuckDB.

Written by hand from the pipeline's rules (not generated from the Spark
plans) over the raw test tables, which DuckDB sees as views named
``region nation customer supplier part orders lineitem events ...``.

Cross-engine conventions:
* ``R(x, n)`` rounds like Spark's ``round`` (HALF_UP on the shortest decimal
  form of the double) by going through VARCHAR -> DECIMAL before rounding.
* Averages of integers are SUM / COUNT in double (exact numerator); averages
  of doubles are rounded to 6 decimals on both sides.
* Fractional literals are cast to DOUBLE, as PySpark literals are doubles.
"""

from __future__ import annotations

import datetime as dt

from .. import config


def R(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,24)), {n}) AS DOUBLE)"


def D(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t.strftime('%Y-%m-%d %H:%M:%S')}'"


AS_OF = config.AS_OF
AS_OF_D = _date(AS_OF)
AS_OF_TS = _ts(dt.datetime.combine(AS_OF, dt.time()))
RUN = _ts(config.RUN_TS)
SKU = "printf('SKU-%05d', {})"


def _u(expr: str) -> str:
    """U[0,1) from the first 8 hex digits of md5(expr)."""
    return f"(CAST('0x' || substr(md5({expr}), 1, 8) AS BIGINT) / {D(4294967296.0)})"


# --- raw stand-ins --------------------------------------------------------------
RAW_CTES = {
    "product_catalog": f"""
product_catalog AS (
  SELECT {SKU.format('p_partkey')} AS sku_id, p_name AS product_name, p_type AS category,
         p_type || '-' || CAST(p_size % 3 AS VARCHAR) AS subcategory, p_type AS product_type,
         p_brand AS brand, p_retailprice * (1 + p_size) / 100 AS unit_cost,
         p_size * {D(0.5)} AS weight_lbs, TRUE AS is_active, CAST(NULL AS BIGINT) AS lead_time_days,
         'SUP-' || lpad(CAST(p_partkey % 30 + 1 AS VARCHAR), 3, '0') AS supplier_id,
         CAST(NULL AS VARCHAR) AS created_date
  FROM part)""",
    "competitor_prices": f"""
competitor_prices AS (
  SELECT 'CP-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS event_id,
         {SKU.format('l.l_partkey')} AS sku_id,
         'C' || CAST(l.l_suppkey % 5 AS VARCHAR) AS competitor,
         p.p_retailprice * (1 + p.p_size) / 100 * ({D(1.2)} + 4 * l.l_discount)
           * CASE WHEN l.l_quantity = 1 THEN {D(-1.0)} WHEN l.l_quantity = 2 THEN {D(1000.0)}
                  ELSE {D(1.0)} END AS competitor_price,
         CAST(NULL AS VARCHAR) AS scrape_url,
         CAST(l.l_shipdate AS TIMESTAMP) AS event_timestamp
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "inventory_events": f"""
inventory_events AS (
  SELECT 'IE-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
         {SKU.format('l_partkey')} AS sku_id,
         CASE WHEN l_returnflag = 'A' THEN 'restock' ELSE 'sale' END AS event_type,
         CAST(l_quantity AS BIGINT) AS stock_delta,
         CAST(l_quantity * 10 - 20 AS BIGINT) AS stock_after,
         'WH-0' || CAST(l_suppkey % 5 + 1 AS VARCHAR) AS warehouse_id,
         CAST(l_shipdate AS TIMESTAMP) AS event_timestamp
  FROM lineitem WHERE l_returnflag <> 'R')""",
    "daily_sales": f"""
daily_sales AS (
  SELECT {SKU.format('l_partkey')} AS sku_id, CAST(l_shipdate AS DATE) AS sale_date,
         CAST(l_quantity AS BIGINT) AS units_sold, l_extendedprice AS revenue,
         'ST-' || lpad(CAST(l_suppkey % 12 + 1 AS VARCHAR), 2, '0') AS store_id,
         CASE WHEN month(l_shipdate) IN (4, 5, 6, 7) THEN {D(1.3)}
              WHEN month(l_shipdate) IN (11, 12, 1) THEN {D(0.85)}
              ELSE {D(1.0)} END AS seasonality_index
  FROM lineitem)""",
    "customer_behavior": f"""
event_users AS (
  SELECT user_id, count_if(event_type = 'view') AS views, count_if(event_type = 'click') AS clicks,
         count_if(event_type = 'purchase') AS purchases, count_if(event_type = 'error') AS errors,
         count(*) AS n_events
  FROM events GROUP BY user_id),
customer_behavior AS (
  SELECT {SKU.format('p.p_partkey')} AS sku_id, CAST(u.views AS BIGINT) AS view_count,
         CAST(u.clicks AS DOUBLE) / u.n_events AS cart_add_rate,
         CAST(u.purchases AS DOUBLE) / u.n_events * CASE WHEN p.p_partkey % 3 = 0 THEN {D(0.2)} ELSE {D(1.0)} END AS conversion_rate,
         CAST(u.errors AS DOUBLE) / u.n_events AS return_rate,
         CAST(NULL AS BIGINT) AS avg_session_time_sec, {AS_OF_D} AS snapshot_date
  FROM part p
  CROSS JOIN (SELECT max(user_id) + 1 AS n_slots FROM event_users) s
  JOIN event_users u ON p.p_partkey % s.n_slots = u.user_id)""",
    "promotions": f"""
promotions AS (
  SELECT 'PR-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS promo_id,
         {SKU.format('l_partkey')} AS sku_id,
         'PROMO-' || CAST(l_linenumber % 5 AS VARCHAR) AS promo_type,
         l_discount + {D(0.05)} AS discount_pct,
         CAST(l_shipdate AS DATE) AS start_date,
         CAST(l_shipdate AS DATE) + 30 AS end_date,
         CAST(l_shipdate AS DATE) <= {AS_OF_D} AND {AS_OF_D} <= CAST(l_shipdate AS DATE) + 30 AS is_active,
         CAST(NULL AS VARCHAR) AS created_by
  FROM lineitem WHERE l_returnflag = 'A')""",
    "supplier_cost_changes": f"""
supplier_cost_changes AS (
  SELECT 'SC-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS event_id,
         {SKU.format('l_partkey')} AS sku_id,
         'SUP-' || lpad(CAST(l_partkey % 30 + 1 AS VARCHAR), 3, '0') AS supplier_id,
         l_tax * {D(2.875)} - {D(0.08)} AS cost_delta_pct,
         'REASON-' || CAST(l_linenumber % 5 AS VARCHAR) AS reason,
         CAST(l_shipdate AS TIMESTAMP) AS event_timestamp
  FROM lineitem WHERE l_returnflag = 'R')""",
    "macro_signals": f"""
macro_weeks AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS signal_week, count(*) AS n,
         SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
         count_if(o_orderstatus = 'O') AS n_open,
         count_if(o_orderpriority = '1-URGENT') AS n_urgent
  FROM orders GROUP BY 1),
macro_signals AS (
  SELECT signal_week,
         {D(100.0)} + CAST(cents AS DOUBLE) / CAST(n * 2500000 AS DOUBLE) AS ppi_steel,
         {D(60.0)} + {D(160.0)} * n_open / n AS ppi_copper,
         {D(70.0)} + {D(110.0)} * n_urgent / n AS ppi_pvc,
         'orders' AS source
  FROM macro_weeks)""",
}

_d = lambda n: _date(AS_OF - dt.timedelta(days=n))

# --- derived layers ---------------------------------------------------------------
DERIVED_CTES = {
    "bronze_prices": f"""
bronze_prices AS (
  SELECT *, {RUN} AS _ingested_at, 'raw.competitor_prices' AS _source FROM competitor_prices)""",
    "bronze_inventory": f"""
bronze_inventory AS (
  SELECT *, {RUN} AS _ingested_at, 'raw.inventory_events' AS _source FROM inventory_events)""",
    "silver_prices": f"""
silver_prices AS (
  SELECT d.*, c.category, c.subcategory, c.brand, c.unit_cost, c.product_name,
         {RUN} AS _validated_at,
         {R('d.competitor_price / NULLIF(c.unit_cost, 0)', 4)} AS _price_to_cost
  FROM (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sku_id, competitor, event_timestamp
                                   ORDER BY competitor_price ASC NULLS FIRST, event_id ASC NULLS FIRST, scrape_url ASC NULLS FIRST) AS rn
      FROM bronze_prices
      WHERE sku_id IS NOT NULL AND event_timestamp IS NOT NULL
        AND competitor_price > 0 AND competitor_price < 10000)
    WHERE rn = 1) d
  JOIN product_catalog c ON d.sku_id = c.sku_id)""",
    "velocity": f"""
velocity AS (
  SELECT sku_id, CAST(SUM(units_sold) AS DOUBLE) / COUNT(units_sold) AS avg_daily_units
  FROM daily_sales WHERE sale_date >= {_d(30)} AND sale_date <= {AS_OF_D}
  GROUP BY sku_id)""",
    "silver_inventory": f"""
silver_inventory AS (
  SELECT d.*, v.avg_daily_units,
         CASE WHEN v.avg_daily_units > 0 THEN {R('d.stock_after / v.avg_daily_units', 1)}
              ELSE CAST(NULL AS DOUBLE) END AS days_of_supply,
         d.stock_after AS current_stock,
         {RUN} AS _validated_at
  FROM (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY sku_id, event_timestamp
                                   ORDER BY stock_after ASC NULLS FIRST, warehouse_id ASC NULLS FIRST,
                                            event_id ASC NULLS FIRST, event_type ASC NULLS FIRST,
                                            stock_delta ASC NULLS FIRST) AS rn
      FROM bronze_inventory
      WHERE sku_id IS NOT NULL AND event_timestamp IS NOT NULL AND stock_after >= 0)
    WHERE rn = 1) d
  LEFT JOIN velocity v ON d.sku_id = v.sku_id)""",
    "latest_inventory": """
latest_inventory AS (
  SELECT sku_id, current_stock, days_of_supply FROM (
    SELECT *, row_number() OVER (PARTITION BY sku_id
                                 ORDER BY event_timestamp DESC NULLS LAST, event_id ASC NULLS FIRST) AS rn
    FROM silver_inventory)
  WHERE rn = 1)""",
    "demand_window": f"""
demand_window AS (
  SELECT sku_id,
         CAST(SUM(units_sold) FILTER (WHERE sale_date >= {_d(7)}) AS BIGINT) AS units_sold_7d,
         CAST(SUM(units_sold) AS BIGINT) AS units_sold_30d,
         CAST(SUM(units_sold) AS DOUBLE) / COUNT(units_sold) AS avg_daily_units,
         {R('AVG(seasonality_index)', 6)} AS seasonality_index
  FROM daily_sales
  WHERE sale_date >= {_d(30)} AND sale_date <= {AS_OF_D}
  GROUP BY sku_id)""",
    "best_promo": """
best_promo AS (
  SELECT sku_id, discount_pct, promo_type FROM (
    SELECT *, row_number() OVER (PARTITION BY sku_id
                                 ORDER BY discount_pct DESC NULLS LAST, promo_type ASC NULLS FIRST,
                                          promo_id ASC NULLS FIRST) AS rn
    FROM promotions WHERE is_active = TRUE)
  WHERE rn = 1)""",
    "supplier_pressure": f"""
supplier_pressure AS (
  SELECT sku_id, {R('AVG(cost_delta_pct)', 6)} AS cost_delta_pct
  FROM supplier_cost_changes
  WHERE event_timestamp >= {_ts(dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(days=90))}
    AND event_timestamp < {_ts(dt.datetime.combine(AS_OF, dt.time()) + dt.timedelta(days=1))}
  GROUP BY sku_id)""",
    "macro_trailing": f"""
macro_trailing AS (
  SELECT {R('AVG(ppi_steel)', 6)} AS ppi_steel, {R('AVG(ppi_copper)', 6)} AS ppi_copper,
         {R('AVG(ppi_pvc)', 6)} AS ppi_pvc
  FROM macro_signals WHERE signal_week >= {_d(28)} AND signal_week <= {AS_OF_D})""",
    # one row per catalog SKU with every non-competitor feature filled in
    "sku_dim": f"""
sku_dim AS (
  SELECT c.sku_id, c.product_name, c.category, c.subcategory, c.brand, c.supplier_id, c.unit_cost,
         c.weight_lbs,
         COALESCE(inv.current_stock, 0) AS current_stock,
         COALESCE(inv.days_of_supply, {D(-1.0)}) AS days_of_supply,
         COALESCE(dem.units_sold_7d, 0) AS units_sold_7d,
         COALESCE(dem.units_sold_30d, 0) AS units_sold_30d,
         COALESCE(dem.avg_daily_units, {D(0.0)}) AS avg_daily_units,
         COALESCE(dem.seasonality_index, {D(1.0)}) AS seasonality_index,
         COALESCE(cb.view_count, 0) AS view_count,
         COALESCE(cb.cart_add_rate, {D(0.0)}) AS cart_add_rate,
         COALESCE(cb.conversion_rate, {D(0.0)}) AS conversion_rate,
         COALESCE(cb.return_rate, {D(0.0)}) AS return_rate,
         COALESCE(pr.discount_pct, {D(0.0)}) AS discount_pct,
         COALESCE(pr.promo_type, 'NONE') AS promo_type,
         COALESCE(sc.cost_delta_pct, {D(0.0)}) AS cost_delta_pct,
         COALESCE(mac.ppi_steel, {D(100.0)}) AS ppi_steel,
         COALESCE(mac.ppi_copper, {D(100.0)}) AS ppi_copper,
         COALESCE(mac.ppi_pvc, {D(100.0)}) AS ppi_pvc,
         {R(f'c.unit_cost * {D(config.SHELF_MARKUP)}', 2)} AS current_price
  FROM product_catalog c
  LEFT JOIN latest_inventory inv USING (sku_id)
  LEFT JOIN demand_window dem USING (sku_id)
  LEFT JOIN customer_behavior cb USING (sku_id)
  LEFT JOIN best_promo pr USING (sku_id)
  LEFT JOIN supplier_pressure sc USING (sku_id)
  CROSS JOIN macro_trailing mac)""",
    # every validated price event with its SKU's features
    "gold_features": f"""
gold_features AS (
  SELECT d.*, e.competitor, e.competitor_price,
         {R('e.competitor_price / NULLIF(d.unit_cost, 0)', 4)} AS competitor_markup,
         e.event_timestamp AS source_event_timestamp,
         {RUN} AS _updated_at
  FROM silver_prices e JOIN sku_dim d USING (sku_id))""",
    "feature_mart": """
feature_mart AS (
  SELECT * EXCLUDE (row_num) FROM (
    SELECT *, row_number() OVER (PARTITION BY sku_id
                                 ORDER BY source_event_timestamp DESC NULLS LAST, _updated_at DESC NULLS LAST,
                                          competitor ASC NULLS FIRST, competitor_price ASC NULLS FIRST) AS row_num
    FROM gold_features)
  WHERE row_num = 1)""",
    "flag_inputs": f"""
flag_inputs AS (
  SELECT sku_id, conversion_rate, avg_daily_units,
         CASE WHEN current_price > 0 THEN (current_price - unit_cost) / current_price ELSE {D(0.0)} END AS gm,
         CASE WHEN competitor_price > 0 THEN (current_price - competitor_price) / competitor_price
              ELSE {D(0.0)} END AS comp_gap,
         {R(f'greatest({D(0.0)}, least({D(1.0)}, {D(1.0)} - (conversion_rate * {D(0.6)} + least(avg_daily_units / 10, {D(1.0)}) * {D(0.4)})))', 4)} AS elasticity
  FROM feature_mart)""",
    "price_flags": f"""
flag_gaps AS (
  SELECT *, {R(f'(gm - {D(config.TARGET_GM)}) * 100', 2)} AS margin_gap FROM flag_inputs),
flag_rules AS (
  SELECT *,
         margin_gap < -5 AND elasticity < {D(0.5)} AND comp_gap < {D(0.05)} AS is_raise,
         comp_gap > {D(config.RAISE_THRESHOLD)} AND conversion_rate < {D(config.CONVERSION_FLOOR)} AS is_disc
  FROM flag_gaps),
price_flags AS (
  SELECT sku_id,
         CASE WHEN is_raise THEN 'RAISE' WHEN is_disc THEN 'DISCOUNT' ELSE 'HOLD' END AS action,
         elasticity AS elasticity_score,
         margin_gap AS margin_gap_pct,
         {R('gm * 100', 2)} AS current_gm_pct,
         {R('comp_gap * 100', 2)} AS comp_gap_pct,
         CASE WHEN is_raise THEN printf('Margin %+.1fpts below target; low elasticity (%.2f); competitive',
                                        {R('margin_gap', 1)}, {R('elasticity', 2)})
              WHEN is_disc THEN printf('Priced %.1f%% above competitor; low conversion (%.3f)',
                                       {R('comp_gap * 100', 1)}, {R('conversion_rate', 3)})
              ELSE printf('Margin gap %+.1fpts; elasticity %.2f; monitor',
                          {R('margin_gap', 1)}, {R('elasticity', 2)}) END AS rationale,
         {RUN} AS generated_at,
         '{config.MODEL_VERSION}' AS model_version
  FROM flag_rules)""",
    "price_target": f"""
target_base AS (
  SELECT *, unit_cost / ({D(1.0)} - ({D(config.TARGET_GM_LOW)} + {D(0.17)} * {_u('sku_id')})) AS floor_price
  FROM feature_mart),
target_parts AS (
  SELECT *,
         CASE WHEN abs((competitor_price - floor_price) / floor_price) < {D(0.10)}
              THEN {D(0.4)} * (competitor_price - floor_price) ELSE {D(0.0)} END AS comp_adj,
         CASE WHEN avg_daily_units > 5 THEN floor_price * {D(0.03)}
              WHEN avg_daily_units < 1 THEN -floor_price * {D(0.04)} ELSE {D(0.0)} END AS demand_adj,
         CASE WHEN days_of_supply > 0 AND days_of_supply < 14 THEN floor_price * {D(0.02)}
              ELSE {D(0.0)} END AS scarcity_adj
  FROM target_base),
price_target AS (
  SELECT * EXCLUDE (floor_price, comp_adj, demand_adj, scarcity_adj),
         CASE WHEN discount_pct > 0 THEN {R(f'floor_price * ({D(1.0)} - discount_pct)', 2)}
              ELSE {R(f'greatest(unit_cost * {D(1.10)}, floor_price + comp_adj + demand_adj + scarcity_adj)', 2)}
         END AS optimal_price
  FROM target_parts)""",
    "price_target_noisy": f"""
target_draws AS (
  SELECT *, sqrt({D(-2.0)} * ln({D(1.0)} - {_u("'noise-a:' || sku_id")})) * cos(2 * pi() * {_u("'noise-b:' || sku_id")}) AS z
  FROM target_parts),
price_target_noisy AS (
  SELECT sku_id, discount_pct,
         CASE WHEN discount_pct > 0 THEN {R(f'floor_price * ({D(1.0)} - discount_pct) + {D(config.PROMO_NOISE)} * z', 2)}
              ELSE {R(f'greatest(unit_cost * {D(1.10)}, floor_price + comp_adj + demand_adj + scarcity_adj + floor_price * {D(config.LIST_NOISE)} * z)', 2)}
         END AS optimal_price
  FROM target_draws)""",
    "score_compare": f"""
score_rec AS (
  SELECT sku_id, product_name, category, unit_cost, current_price, competitor_price, units_sold_7d,
         {R('optimal_price', 2)} AS recommended_price
  FROM price_target),
score_compare AS (
  SELECT *,
         {R('(recommended_price - current_price) / NULLIF(current_price, 0) * 100', 1)} AS delta_pct,
         {R('(current_price - unit_cost) / NULLIF(current_price, 0) * 100', 1)} AS current_gm_pct,
         {R('(recommended_price - unit_cost) / NULLIF(recommended_price, 0) * 100', 1)} AS recommended_gm_pct
  FROM score_rec)""",
}

ORDER = [
    "product_catalog", "competitor_prices", "inventory_events", "daily_sales", "customer_behavior",
    "promotions", "supplier_cost_changes", "macro_signals",
    "bronze_prices", "bronze_inventory", "silver_prices", "velocity", "silver_inventory",
    "latest_inventory", "demand_window", "best_promo", "supplier_pressure", "macro_trailing",
    "sku_dim", "gold_features", "feature_mart", "flag_inputs", "price_flags", "price_target", "price_target_noisy", "score_compare",
]
ALL_CTES = {**RAW_CTES, **DERIVED_CTES}


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE (DuckDB drops the unused ones)."""
    return "WITH " + ",".join(ALL_CTES[k] for k in ORDER) + "\n" + body


SIGNAL = (f"CASE WHEN delta_pct > {D(config.SIGNAL_CUTOFF_PCT)} THEN '{config.SIGNAL_RAISE}' "
          f"WHEN delta_pct < -{D(config.SIGNAL_CUTOFF_PCT)} THEN '{config.SIGNAL_DISCOUNT}' "
          f"ELSE '{config.SIGNAL_HOLD}' END")

def _profile(table: str, name: str, ts: str | None, key: str | None = "sku_id") -> str:
    latest = f"CAST(max({ts}) AS TIMESTAMP)" if ts else "CAST(NULL AS TIMESTAMP)"
    keys = f"count(DISTINCT {key})" if key else "CAST(NULL AS BIGINT)"
    return f"SELECT '{name}' AS table_name, count(*) AS row_count, {latest} AS latest_ts, {keys} AS distinct_keys FROM {table}"


QUERIES = {
    "bronze_prices": "SELECT * FROM bronze_prices",
    "bronze_inventory": "SELECT * FROM bronze_inventory",
    "silver_prices": "SELECT * FROM silver_prices",
    "silver_inventory": "SELECT * FROM silver_inventory",
    "demand_window": "SELECT * FROM demand_window",
    "rolling_demand": "SELECT * FROM demand_window",
    "gold_lookup": "SELECT * FROM gold_features WHERE sku_id IN ('SKU-00003', 'SKU-00077', 'SKU-00150')",
    "profile_files": " UNION ALL ".join([
        _profile("competitor_prices", "raw.competitor_prices", "event_timestamp"),
        _profile("inventory_events", "raw.inventory_events", "event_timestamp")]),
    "supplier_pressure": "SELECT * FROM supplier_pressure",
    "macro_trailing": "SELECT * FROM macro_trailing",
    "latest_inventory": "SELECT * FROM latest_inventory",
    "best_promo": "SELECT * FROM best_promo",
    "gold_features": "SELECT * FROM gold_features",
    "feature_mart": "SELECT * FROM feature_mart",
    "mart_clustered": "SELECT * FROM feature_mart",
    "elasticity": ("SELECT sku_id, conversion_rate, avg_daily_units, elasticity AS elasticity_score "
                   "FROM flag_inputs"),
    "price_flags": "SELECT * FROM price_flags",
    "action_counts": "SELECT action, count(*) AS count FROM price_flags GROUP BY action",
    "top_flags": ("SELECT * FROM price_flags ORDER BY action ASC NULLS FIRST, margin_gap_pct ASC NULLS FIRST, "
                  "sku_id ASC NULLS FIRST LIMIT 20"),
    "price_target": ("SELECT sku_id, unit_cost, competitor_price, avg_daily_units, days_of_supply, "
                     "discount_pct, optimal_price FROM price_target"),
    "price_target_noisy": "SELECT * FROM price_target_noisy",
    "target_summary": f"""
SELECT count(optimal_price) AS count, {R('avg(optimal_price)', 2)} AS mean,
       {R('stddev_samp(optimal_price)', 2)} AS std, {R('min(optimal_price)', 2)} AS min,
       {R('quantile_cont(optimal_price, 0.25)', 2)} AS p25,
       {R('quantile_cont(optimal_price, 0.5)', 2)} AS p50,
       {R('quantile_cont(optimal_price, 0.75)', 2)} AS p75,
       {R('max(optimal_price)', 2)} AS max
FROM price_target""",
    "score_compare": f"SELECT *, {SIGNAL} AS signal FROM score_compare",
    "score_summary": f"""
SELECT count(*) AS total_skus,
       count_if(delta_pct > 3) AS raise_count,
       count_if(abs(delta_pct) <= 3) AS hold_count,
       count_if(delta_pct < -3) AS discount_count,
       {R('avg(delta_pct) FILTER (WHERE delta_pct > 3)', 6)} AS avg_delta_raise,
       {R('avg(delta_pct) FILTER (WHERE delta_pct < -3)', 6)} AS avg_delta_discount,
       {R('avg(current_gm_pct)', 6)} AS avg_gm_now,
       {R('avg(recommended_gm_pct)', 6)} AS avg_gm_recommended,
       {R('avg(recommended_gm_pct) - avg(current_gm_pct)', 6)} AS gm_change_pts
FROM score_compare""",
    "model_metrics": f"""
SELECT count(*) AS n,
       {R('avg(abs(optimal_price - current_price))', 6)} AS mae,
       {R('1.0 - sum((optimal_price - current_price) * (optimal_price - current_price)) / NULLIF(sum((optimal_price - m.mean_y) * (optimal_price - m.mean_y)), 0)', 6)} AS r2,
       {R(f'avg(abs((optimal_price - current_price) / greatest(optimal_price, {D(0.01)}))) * 100', 6)} AS mape_pct
FROM price_target CROSS JOIN (
  SELECT avg(optimal_price) AS mean_y FROM price_target
  WHERE {_u("'split:' || sku_id")} >= {D(0.8)}) m
WHERE {_u("'split:' || sku_id")} >= {D(0.8)}""",
    "sample_skus": (f"SELECT sku_id, product_name, category, brand, unit_cost, current_price, competitor_price, "
                    f"units_sold_7d, days_of_supply FROM feature_mart "
                    f"ORDER BY md5('{config.SAMPLE_SEED}' || sku_id), sku_id LIMIT 10"),
    "mart_preview": "SELECT * FROM feature_mart ORDER BY sku_id LIMIT 5",
    "recommendations_table": "SELECT * FROM price_flags",
    "table_profile": " UNION ALL ".join([
        _profile("product_catalog", "raw.product_catalog", None),
        _profile("inventory_events", "raw.inventory_events", "event_timestamp"),
        _profile("competitor_prices", "raw.competitor_prices", "event_timestamp"),
        _profile("daily_sales", "raw.daily_sales", "sale_date"),
        _profile("customer_behavior", "raw.customer_behavior", "snapshot_date"),
        _profile("promotions", "raw.promotions", "start_date"),
        _profile("supplier_cost_changes", "raw.supplier_cost_changes", "event_timestamp"),
        _profile("macro_signals", "raw.macro_signals", "signal_week", None),
        _profile("bronze_prices", "bronze.competitor_prices_raw", "_ingested_at"),
        _profile("bronze_inventory", "bronze.inventory_events_raw", "_ingested_at"),
        _profile("silver_prices", "silver.competitor_prices", "_validated_at"),
        _profile("silver_inventory", "silver.inventory", "_validated_at"),
        _profile("gold_features", "gold.gold_pricing_features", "source_event_timestamp"),
        _profile("feature_mart", "gold.gold_feature_mart", "source_event_timestamp"),
    ]),
    # what must hold of the model on the test split of the labelled mart
    "gbt_checks": (f"SELECT count(*) > 0 AS vectors_hold_columns, count(*) > 0 AS reloaded_scores_equal, "
                   f"count(*) > 0 AS beats_shelf_price, "
                   f"count(*) > 0 AS beats_four_rounds, count(*) > 0 AS best_rounds_kept, count(*) > 0 AS patience_kept FROM price_target WHERE {_u("'split:' || sku_id")} >= {D(0.8)}"),
    "sku_dimension": "SELECT * FROM sku_dim",
    "stream_bronze_silver_prices": "SELECT * FROM silver_prices",
    "stream_silver_inventory": "SELECT * FROM silver_inventory",
    "stream_late_data": """
SELECT DISTINCT sku_id, competitor, event_timestamp FROM (
  SELECT *, CAST(right(event_id, 1) AS INT) % 2 = 1 AS odd FROM bronze_prices
  WHERE sku_id IS NOT NULL AND event_timestamp IS NOT NULL AND competitor_price > 0 AND competitor_price < 10000) e
JOIN product_catalog USING (sku_id)
WHERE odd OR event_timestamp > (
  SELECT max(event_timestamp) - INTERVAL 30 MINUTE FROM bronze_prices
  WHERE CAST(right(event_id, 1) AS INT) % 2 = 1 AND sku_id IS NOT NULL
    AND competitor_price > 0 AND competitor_price < 10000)""",
    "stream_hot_prices": f"""
SELECT DISTINCT sku_id, competitor, event_timestamp FROM (
  SELECT CASE WHEN third < 2 THEN 'SKU-00001' ELSE sku_id END AS sku_id,
         CASE WHEN third = 0 THEN 'C0' ELSE competitor END AS competitor,
         CASE WHEN third = 0 THEN 10 ELSE competitor_price END AS competitor_price,
         CASE WHEN third = 0 THEN {AS_OF_TS}
              WHEN third = 1 THEN event_timestamp + to_seconds(CAST(split_part(event_id, '-', 2) AS BIGINT) % 86400)
              ELSE event_timestamp END AS event_timestamp
  FROM (SELECT *, CAST(right(event_id, 1) AS INT) % 3 AS third FROM competitor_prices))
JOIN product_catalog USING (sku_id) WHERE competitor_price > 0 AND competitor_price < 10000""",
    "stream_gold": "SELECT * FROM gold_features",
    "stream_feature_mart": "SELECT * FROM feature_mart",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(body) for name, body in QUERIES.items()}
