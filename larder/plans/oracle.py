"""An independent SQL text per registered query, for DuckDB over the same tables.

The texts start from the driver's tables and repeat the whole chain as common table
expressions; they share nothing with the Spark plans.
"""

from __future__ import annotations

YEAR = 1997

# Each entry: name -> (tables it needs, select).
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, needs: str, text: str) -> None:
    PARTS[name] = (tuple(needs.split()), text.strip())


def _sum(expression: str, kind: str = "DECIMAL(28,8)") -> str:
    return f"CAST(sum(CAST({expression} AS {kind})) AS DOUBLE)"


def _total(expression: str) -> str:
    return _sum(expression, "DECIMAL(28,8)")


def _mean(expression: str) -> str:
    return f"({_sum(expression, 'DECIMAL(18,8)')} / count({expression}))"


_part("sales", "", """
SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey, o_orderstatus,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'breakfast' WHEN '2' THEN 'lunch'
            WHEN '3' THEN 'dinner' ELSE 'snack' END AS meal_period,
       'LOC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS location_id,
       'MI' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS menu_item_id,
       n_name AS location_name, p_name AS menu_item_name,
       CASE p_type WHEN 'ECONOMY' THEN 'Salads' WHEN 'SMALL' THEN 'Dairy'
            WHEN 'MEDIUM' THEN 'Main Course' WHEN 'PROMO' THEN 'Starter'
            WHEN 'STANDARD' THEN 'Beverage' WHEN 'LARGE' THEN 'Breads' END AS category,
       p_retailprice AS cost_per_unit, lineitem.*
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN nation ON c_nationkey = n_nationkey
""")


def _production(where: str = "") -> str:
    return f"""
SELECT date, location_id, location_name, meal_period, menu_item_id, menu_item_name,
       upper(category) AS category, {_sum('l_quantity')} AS quantity_prepared,
       'portion' AS unit, cost_per_unit,
       {_sum('l_quantity * (1 + l_tax)')} AS planned_quantity,
       {_sum('l_quantity * (1 - l_discount)')} AS actual_served_estimate
FROM sales {where}
GROUP BY date, location_id, location_name, meal_period, menu_item_id, menu_item_name, category,
         cost_per_unit"""


_part("production", "sales", _production())
_part("production_not_p", "sales", _production("WHERE o_orderstatus <> 'P'"))

_part("waste_raw", "sales", """
SELECT date, location_id, location_name, meal_period, menu_item_id, menu_item_name, category,
       l_quantity * least(1.0::DOUBLE, l_discount * (1 + c_nationkey % 10)) AS quantity_wasted,
       CASE l_suppkey % 6 WHEN 0 THEN 'Overproduction' WHEN 1 THEN 'Spoilage'
            WHEN 2 THEN 'Low Demand' WHEN 3 THEN 'Plate Waste' WHEN 4 THEN 'Forecast Miss'
            ELSE 'Prep Error' END AS waste_reason,
       CASE l_linenumber % 4 WHEN 0 THEN 'Serving' WHEN 1 THEN 'Storage'
            WHEN 2 THEN 'Preparation' ELSE 'Portioning' END AS waste_stage
FROM sales WHERE l_returnflag IN ('R', 'A') AND l_discount > 0
""")
_part("waste", "waste_raw", """
SELECT * REPLACE (lower(waste_reason) AS waste_reason) FROM waste_raw
""")
_part("menu", "", """
SELECT 'MI' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS menu_item_id,
       p_name AS menu_item_name,
       CASE p_type WHEN 'ECONOMY' THEN 'SALADS' WHEN 'SMALL' THEN 'DAIRY'
            WHEN 'MEDIUM' THEN 'MAIN COURSE' WHEN 'PROMO' THEN 'STARTER'
            WHEN 'STANDARD' THEN 'BEVERAGE' WHEN 'LARGE' THEN 'BREADS' END AS category,
       p_brand AS sub_category, CASE p_size % 2 WHEN 0 THEN 'Yes' ELSE 'No' END AS veg_flag,
       '1' AS standard_portion_size, p_retailprice AS cost_per_unit,
       CAST(p_size AS INTEGER) AS shelf_life_hours,
       CASE p_size % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS prep_complexity
FROM part
""")
_part("location", "", """
SELECT 'LOC' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS location_id,
       n_name AS location_name, 'CITY_' || CAST(n_nationkey % 10 AS VARCHAR) AS city,
       r_name AS region,
       CASE n_nationkey % 4 WHEN 0 THEN 'Campus' WHEN 1 THEN 'Corporate' WHEN 2 THEN 'Hospital'
            ELSE 'Hostel' END AS location_type,
       CAST(200 + 40 * n_nationkey AS VARCHAR) AS capacity, '1990-01-01' AS open_date,
       CAST(NULL AS VARCHAR) AS manager_name,
       CASE n_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS storage_rating
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
_part("supplier_base", "", """
SELECT s_suppkey AS k, 'SUP' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS supplier_id,
       'MI' || lpad(CAST(CASE WHEN s_suppkey % 10 = 9 THEN s_suppkey - 1 ELSE s_suppkey END
                         AS VARCHAR), 7, '0') AS menu_item_id,
       s_name AS supplier_name, 'CITY_' || CAST(s_nationkey % 10 AS VARCHAR) AS supplier_city,
       CAST(s_acctbal AS VARCHAR) AS supplier_cost,
       CAST(1 + s_suppkey % 7 AS INTEGER) AS lead_time_days,
       1 + ((s_suppkey * 37) % 400) / 100.0::DOUBLE AS quality_score,
       CASE s_suppkey % 4 WHEN 0 THEN '1' WHEN 1 THEN 'True' WHEN 2 THEN 'true' ELSE '1.0' END
           AS is_current
FROM supplier
""")
_part("supplier_records", "supplier_base", """
SELECT 'A' || k AS supplier_record_id, * , DATE '1995-01-01' AS effective_from, 1 AS load_no
FROM supplier_base WHERE k % 10 <> 7
UNION ALL
SELECT 'B' || k, * REPLACE ('0' AS is_current, 0.0::DOUBLE AS quality_score),
       DATE '1999-01-01', 1
FROM supplier_base WHERE k % 10 <> 7 AND k % 6 = 0
UNION ALL
SELECT 'C' || k, * REPLACE (CASE WHEN k % 3 = 0 THEN quality_score + 0.5 ELSE quality_score END
                            AS quality_score),
       DATE '1998-01-01', 2
FROM supplier_base WHERE k % 5 <> 4
""")
_part("waste_grain", "waste", f"""
SELECT date, location_id, menu_item_id, meal_period, {_sum('quantity_wasted')} AS quantity_wasted,
       max(waste_reason) FILTER (WHERE pos = 1) AS waste_reason,
       max(waste_stage) FILTER (WHERE pos = 1) AS waste_stage
FROM (SELECT *, row_number() OVER (
          PARTITION BY date, location_id, menu_item_id, meal_period
          ORDER BY quantity_wasted DESC, waste_reason DESC, waste_stage DESC) AS pos
      FROM waste)
GROUP BY date, location_id, menu_item_id, meal_period
""")
_part("silver", "production waste_grain menu location", """
SELECT *, CASE WHEN quantity_prepared > 0 THEN quantity_wasted / quantity_prepared * 100
               ELSE 0 END AS waste_percentage,
       quantity_wasted * cost_per_unit AS waste_cost,
       quantity_prepared - quantity_wasted AS quantity_consumed,
       planned_quantity - actual_served_estimate AS demand_gap,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM (SELECT p.*, 'batch-1998-01-01' AS batch_id,
             coalesce(w.quantity_wasted, 0) AS quantity_wasted, w.waste_reason, w.waste_stage,
             m.sub_category, m.veg_flag, m.shelf_life_hours, m.prep_complexity,
             l.city, l.region, l.location_type, l.capacity, l.storage_rating
      FROM production p
      LEFT JOIN waste_grain w USING (date, location_id, menu_item_id, meal_period)
      LEFT JOIN menu m USING (menu_item_id)
      LEFT JOIN location l USING (location_id))
""")
_part("dim_date", "production", """
SELECT CAST(strftime(day, '%Y%m%d') AS BIGINT) AS date_sk, strftime(day, '%Y-%m-%d') AS full_date,
       CAST(isodow(day) AS INTEGER) AS day_of_week, dayname(day) AS day_name,
       CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name,
       CAST(quarter(day) AS INTEGER) AS quarter, CAST(year(day) AS INTEGER) AS year,
       isodow(day) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(
             CAST(make_date(CAST(min(year(date)) AS INTEGER), 1, 1) AS TIMESTAMP),
             CAST(make_date(CAST(max(year(date)) AS INTEGER), 12, 31) AS TIMESTAMP),
             INTERVAL 1 DAY)) AS DATE) AS day FROM production)
""")
_part("dim_category", "production", """
SELECT DISTINCT md5(category) AS category_sk, category AS category_name FROM production
""")
_part("dim_meal_period", "", """
SELECT md5(name) AS meal_period_sk, name AS meal_period_name
FROM (VALUES ('breakfast'), ('lunch'), ('dinner'), ('snack')) t(name)
""")
_part("dim_waste_reason", "", """
SELECT md5(name) AS waste_reason_sk, name AS waste_reason_name
FROM (VALUES ('overproduction'), ('spoilage'), ('low demand'), ('plate waste'),
             ('forecast miss'), ('prep error')) t(name)
""")
_part("dim_location", "silver location", """
SELECT md5(location_id) AS location_sk, location_id, location_name, city, region, location_type,
       capacity, storage_rating
FROM location WHERE location_id IN (SELECT location_id FROM silver)
""")
_part("dim_menu", "silver menu", """
SELECT md5(menu_item_id) AS menu_sk, menu_item_id, menu_item_name, category, sub_category,
       veg_flag, shelf_life_hours, prep_complexity
FROM menu WHERE menu_item_id IN (SELECT menu_item_id FROM silver)
""")
_part("dim_supplier", "supplier_base", """
SELECT md5(supplier_id || '|' || effective_date) AS supplier_sk, supplier_id, supplier_name,
       menu_item_id, supplier_city, lead_time_days, quality_score, effective_date, expiry_date,
       is_current
FROM (
    SELECT * EXCLUDE (is_current), '1995-01-01' AS effective_date,
           CASE WHEN k % 5 <> 4 AND k % 3 = 0 THEN '1997-12-31' ELSE '9999-12-31' END
               AS expiry_date,
           NOT (k % 5 <> 4 AND k % 3 = 0) AS is_current
    FROM supplier_base WHERE k % 10 <> 7
    UNION ALL
    SELECT * EXCLUDE (is_current) REPLACE (
               CASE WHEN k % 3 = 0 THEN quality_score + 0.5 ELSE quality_score END
               AS quality_score),
           '1998-01-01', '9999-12-31', true
    FROM supplier_base WHERE k % 5 <> 4 AND (k % 10 = 7 OR k % 3 = 0))
""")

_GRAIN_KEY = "CAST(s.date AS VARCHAR) || '|' || s.location_id || '|' || s.menu_item_id || '|' || s.meal_period"
_DATE_KEY = "CAST(strftime(s.date, '%Y%m%d') AS BIGINT)"

_part("fact_production", "silver", f"""
SELECT md5({_GRAIN_KEY}) AS production_sk, {_DATE_KEY} AS date_sk,
       md5(location_id) AS location_sk, md5(menu_item_id) AS menu_sk,
       md5(meal_period) AS meal_period_sk, quantity_prepared, cost_per_unit, batch_id, year, month
FROM silver s
""")


def _fact_waste(suppliers: str) -> str:
    return f"""
SELECT md5({_GRAIN_KEY} || '|' || coalesce(d.supplier_sk, '\\N')) AS waste_sk,
       {_DATE_KEY} AS date_sk, md5(s.location_id) AS location_sk,
       md5(s.menu_item_id) AS menu_sk, md5(s.meal_period) AS meal_period_sk,
       md5(s.waste_reason) AS waste_reason_sk, d.supplier_sk, s.quantity_wasted,
       s.waste_percentage, s.waste_cost, s.year, s.month
FROM silver s LEFT JOIN ({suppliers}) d ON s.menu_item_id = d.menu_item_id
WHERE s.waste_reason IS NOT NULL"""


_part("fact_waste", "silver dim_supplier", _fact_waste("SELECT * FROM dim_supplier WHERE is_current"))
_part("fact_waste_best", "silver dim_supplier", _fact_waste("""
    SELECT * FROM dim_supplier WHERE is_current
    QUALIFY row_number() OVER (PARTITION BY menu_item_id
                               ORDER BY quality_score DESC, supplier_sk) = 1"""))
_part("fact_consumption", "silver", f"""
SELECT md5({_GRAIN_KEY}) AS consumption_sk, {_DATE_KEY} AS date_sk,
       md5(location_id) AS location_sk, md5(menu_item_id) AS menu_sk, quantity_prepared,
       quantity_wasted, quantity_consumed, demand_gap, year, month
FROM silver s
""")
_part("fact_waste_summary", "silver", f"""
SELECT md5(location_id) AS location_sk, md5(category) AS category_sk, category,
       {_sum('quantity_wasted')} AS total_waste_quantity,
       {_sum('waste_cost')} AS total_waste_cost,
       {_mean('waste_percentage')} AS avg_waste_percentage,
       count(quantity_wasted) AS waste_event_count, year, month
FROM silver WHERE quantity_wasted > 0 GROUP BY location_id, category, year, month
""")
_part("summary", "fact_waste_summary", f"SELECT * FROM fact_waste_summary WHERE year = {YEAR}")
_part("wasted", "fact_waste", f"SELECT * FROM fact_waste WHERE year = {YEAR}")
_part("items", "wasted dim_menu", f"""
SELECT menu_item_name, category, {_sum('waste_cost')} AS total_waste_cost,
       {_sum('quantity_wasted')} AS total_waste_quantity,
       {_mean('waste_percentage')} AS avg_waste_pct,
       CAST(dense_rank() OVER (ORDER BY {_sum('waste_cost')} DESC) AS INTEGER) AS waste_rank
FROM wasted JOIN dim_menu USING (menu_sk) GROUP BY menu_item_name, category
""")
_part("months", "summary", f"""
SELECT year, month, {_total('total_waste_quantity')} AS total_waste_quantity,
       {_total('total_waste_cost')} AS total_waste_cost,
       {_mean('avg_waste_percentage')} AS avg_waste_percentage
FROM summary GROUP BY year, month
""")
_part("places", "summary dim_location", f"""
SELECT location_name, {_total('total_waste_cost')} AS total_waste_cost
FROM summary JOIN dim_location USING (location_sk) GROUP BY location_name
ORDER BY total_waste_cost DESC, location_name
""")
_part("trend", "summary dim_location", f"""
SELECT location_name, year, month, {_total('total_waste_cost')} AS total_waste_cost,
       {_total('total_waste_quantity')} AS total_waste_quantity,
       {_mean('avg_waste_percentage')} AS avg_waste_pct,
       CAST(make_date(year, month, 1) AS VARCHAR) AS period
FROM summary JOIN dim_location USING (location_sk) GROUP BY location_name, year, month
""")
_part("changes", "months", """
SELECT year, month, total_waste_cost, prev_month_cost,
       (total_waste_cost - prev_month_cost) * 100.0 / nullif(prev_month_cost, 0) AS mom_pct_change,
       make_date(year, month, 1) AS period
FROM (SELECT *, lag(total_waste_cost) OVER (ORDER BY year, month) AS prev_month_cost FROM months)
""")
_part("causes", "summary dim_location", """
SELECT location_name, city, region, category AS category_name, year, month,
       avg_waste_percentage AS waste_percentage, total_waste_cost, total_waste_quantity,
       waste_event_count,
       CASE WHEN avg_waste_percentage > 40
                 AND total_waste_quantity / nullif(waste_event_count, 0) > 5
            THEN 'Overproduction'
            WHEN category IN ('SALADS', 'DAIRY', 'FRESH JUICE', 'FRUITS')
                 AND avg_waste_percentage > 20 THEN 'Storage / Spoilage'
            WHEN avg_waste_percentage > 30
                 AND total_waste_quantity / nullif(waste_event_count, 0) <= 5
            THEN 'Portion Mismatch'
            ELSE 'Low Demand' END AS root_cause
FROM summary JOIN dim_location USING (location_sk)
""")


def _check_rows(table: str, label: str, checks: list[tuple[str, str]], nulls_fail: bool) -> str:
    """One row per check; a null condition fails only where ``nulls_fail``."""
    rows = []
    for name, condition in checks:
        failing = f"NOT coalesce({condition}, {'false' if nulls_fail else 'true'})"
        rows.append(
            f"SELECT {label}, '{name}' AS check_name, "
            f"CAST(count(*) FILTER (WHERE {failing}) AS BIGINT) AS failing_rows FROM {table}"
        )
    return "\nUNION ALL\n".join(rows)


_SILVER_CHECKS = [
    ("waste_lte_prepared", "quantity_wasted <= quantity_prepared"),
    ("waste_pct_0_to_100", "waste_percentage BETWEEN 0 AND 100"),
    ("location_id_not_null", "location_id IS NOT NULL"),
    ("menu_item_id_not_null", "menu_item_id IS NOT NULL"),
    ("date_not_null", "date IS NOT NULL"),
    ("valid_waste_reason", "waste_reason IS NULL OR waste_reason IN "
     "(SELECT waste_reason_name FROM dim_waste_reason)"),
    ("waste_cost_gte_0", "waste_cost >= 0"),
    ("quantity_consumed_gte_0", "quantity_consumed >= 0"),
    ("quantity_prepared_gt_0", "quantity_prepared > 0"),
    ("waste_pct_not_null", "waste_percentage IS NOT NULL"),
]
_part("silver_doubled", "silver", """
SELECT * REPLACE (quantity_wasted * 2 AS quantity_wasted, waste_percentage * 2 AS waste_percentage,
                  waste_cost * 2 AS waste_cost,
                  quantity_prepared - quantity_wasted * 2 AS quantity_consumed)
FROM silver
""")


def _not_null(*columns: str) -> list[tuple[str, str]]:
    return [(f"{c}_not_null", f"{c} IS NOT NULL") for c in columns]


_FACT_KEYS = ("date_sk", "location_sk", "menu_sk", "meal_period_sk")
_FACT_CHECKS = {
    "fact_production": _not_null(*_FACT_KEYS),
    "fact_waste": [*_not_null(*_FACT_KEYS), ("waste_cost_gte_0", "waste_cost >= 0")],
    "fact_consumption": [("consumed_gte_0", "quantity_consumed >= 0"), *_not_null("date_sk")],
    "fact_waste_summary": [
        ("totals_gt_0", "total_waste_quantity > 0"), *_not_null("location_sk"),
    ],
}

_KEYS = {
    "production": ("production_logs", ("date", "location_id", "menu_item_id", "meal_period")),
    "waste": ("waste_logs", ("date", "location_id", "menu_item_id", "meal_period")),
    "menu": ("menu_data", ("menu_item_id",)),
    "location": ("location_data", ("location_id",)),
    "supplier_records": ("supplier_data", ("supplier_record_id",)),
}


def _key_nulls() -> str:
    rows = []
    for table, (feed, key) in _KEYS.items():
        rows.append(
            f"SELECT '{feed}' AS source, 'not_empty' AS check_name, "
            f"CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failing_rows FROM {table}"
        )
        rows.append(_check_rows(table, f"'{feed}'", _not_null(*key), True))
    return "\nUNION ALL\n".join(rows)


def _unique(table: str, key: str) -> str:
    name = "unique_" + key.replace(", ", "_")
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
        f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS failing_rows "
        f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
    )


def _versions(case: str, table: str) -> str:
    return f"""
SELECT '{case}' AS case_name, 'one_current_per_supplier' AS check_name,
       CAST(count(*) AS BIGINT) AS failing_rows
FROM (SELECT supplier_id FROM {table} WHERE is_current GROUP BY supplier_id HAVING count(*) > 1)
UNION ALL
SELECT '{case}', 'unique_supplier_sk', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM {table} GROUP BY supplier_sk)
UNION ALL
SELECT '{case}', 'no_overlapping_versions', CAST(count(*) AS BIGINT)
FROM (SELECT effective_date, lag(expiry_date) OVER (
          PARTITION BY supplier_id ORDER BY effective_date, expiry_date, supplier_sk) AS ended
      FROM {table})
WHERE ended >= effective_date"""


_part("dim_supplier_open", "dim_supplier", """
SELECT * REPLACE (true AS is_current, '9999-12-31' AS expiry_date) FROM dim_supplier
""")

_COUNTED = (
    "silver", "dim_date", "dim_category", "dim_meal_period", "dim_waste_reason", "dim_location",
    "dim_menu", "dim_supplier", "fact_production", "fact_waste", "fact_consumption",
    "fact_waste_summary",
)
_OLD_KEY = "CASE WHEN CAST(right({key}, 1) AS INTEGER) % 2 = 0 THEN 'OLD-' || {key} ELSE {sk} END"

_GAP_TAIL = """
SELECT category, total_prepared, total_consumed, total_demand_gap, total_waste_cost,
       avg_waste_pct, total_demand_gap * 100.0 / nullif(total_prepared, 0) AS gap_pct
FROM supply JOIN (
    SELECT category, {cost} AS total_waste_cost, {pct} AS avg_waste_pct
    FROM summary GROUP BY category) USING (category)
""".format(cost=_total("total_waste_cost"), pct=_mean("avg_waste_percentage"))
_part("made", "fact_production", f"SELECT * FROM fact_production WHERE year = {YEAR}")
_part("supply_summed", "made fact_consumption dim_menu", f"""
SELECT category, {_total('prepared')} AS total_prepared, {_total('consumed')} AS total_consumed,
       {_total('gap')} AS total_demand_gap
FROM (SELECT date_sk, location_sk, menu_sk, sum(quantity_prepared) AS prepared FROM made
      GROUP BY ALL)
JOIN (SELECT date_sk, location_sk, menu_sk, {_sum('quantity_consumed')} AS consumed,
             {_sum('demand_gap')} AS gap FROM fact_consumption GROUP BY ALL)
     USING (date_sk, location_sk, menu_sk)
JOIN dim_menu USING (menu_sk) GROUP BY category
""")
_part("supply_paired", "made fact_consumption dim_menu", f"""
SELECT m.category, {_sum('p.quantity_prepared')} AS total_prepared,
       {_sum('c.quantity_consumed')} AS total_consumed, {_sum('c.demand_gap')} AS total_demand_gap
FROM made p JOIN dim_menu m ON p.menu_sk = m.menu_sk
JOIN fact_consumption c ON p.date_sk = c.date_sk AND p.location_sk = c.location_sk
                       AND p.menu_sk = c.menu_sk
GROUP BY m.category
""")


def _reasons(join_meal: str) -> str:
    return f"""
SELECT meal_period_name, waste_reason_name, year, month, count(waste_sk) AS event_count,
       {_sum('waste_cost')} AS total_cost,
       {_sum('waste_cost')} * 100.0 / nullif(CAST(sum(sum(CAST(waste_cost AS DECIMAL(28,8))))
           OVER (PARTITION BY year, month) AS DOUBLE), 0) AS pct_of_monthly_total
FROM wasted JOIN dim_waste_reason USING (waste_reason_sk)
{join_meal}
GROUP BY meal_period_name, waste_reason_name, year, month"""


def _change(rows: str, order: str) -> str:
    return f"""
SELECT location_name, year, month, total_waste_cost, prev_month_cost,
       (total_waste_cost - prev_month_cost) * 100.0 / nullif(prev_month_cost, 0) AS mom_pct_change
FROM (SELECT *, lag(total_waste_cost) OVER (PARTITION BY location_sk ORDER BY {order})
             AS prev_month_cost FROM ({rows}))
JOIN dim_location USING (location_sk)"""


# Recommendation texts, as the view and the page show them.
_LONG_TEXT = """CASE root_cause
  WHEN 'Overproduction' THEN 'You are cooking way more than guests are eating. Cut prep volume by 25% for the next 2 weeks and track whether plates run out — if they don''t, lock in the lower batch size permanently.'
  WHEN 'Storage / Spoilage' THEN 'This is a fridge or timing problem, not a demand problem. Check how long items sit before service and when the supplier delivers — if it''s arriving less than 12 hours before a meal, push for an earlier drop.'
  WHEN 'Portion Mismatch' THEN 'Portions are too generous for what guests actually want. Try a smaller default serving and let guests ask for more — most won''t, and waste will drop fast.'
  ELSE 'Guests are consistently skipping this item. Either pull it from the menu on low-traffic days or swap it out for something in the same category that actually moves.' END"""
_SHORT_TEXT = """CASE root_cause
  WHEN 'Overproduction' THEN 'Cut prep volume by 25% — you''re cooking more than guests eat.'
  WHEN 'Storage / Spoilage' THEN 'Fix fridge timing or push supplier to deliver closer to service.'
  WHEN 'Portion Mismatch' THEN 'Shrink the default portion — most guests won''t ask for more.'
  ELSE 'Pull this item on slow days or swap it for something that moves.' END"""

_DAY = "REPLACE (CAST(date AS VARCHAR) AS date)"

# Query -> (parts it needs, final select).
FINALS: dict[str, tuple[str, str]] = {
    "bronze_strip": (
        "waste_raw",
        "SELECT CAST(date AS VARCHAR) AS date, location_id, location_name, "
        "upper(left(meal_period, 1)) || substr(meal_period, 2) AS meal_period, menu_item_id, "
        "menu_item_name, category, CAST(quantity_wasted AS VARCHAR) AS quantity_wasted, "
        "'portion' AS unit, waste_reason, waste_stage FROM waste_raw",
    ),
    "bronze_key_nulls": (" ".join(_KEYS), _key_nulls()),
    "clean_production": ("production", f"SELECT * {_DAY} FROM production"),
    "clean_waste": (
        "waste",
        f"SELECT * {_DAY}, 'portion' AS unit FROM waste",
    ),
    "clean_menu": ("menu", "SELECT * FROM menu"),
    "clean_location": ("location", "SELECT * FROM location"),
    "clean_supplier": (
        "supplier_records",
        "SELECT * EXCLUDE (k, load_no) REPLACE (CAST(effective_from AS VARCHAR) AS effective_from), "
        "CAST(NULL AS VARCHAR) AS effective_to FROM supplier_records",
    ),
    "dedupe_latest": (
        "",
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
        "CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem "
        "QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
        "ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey, l_suppkey, l_quantity) = 1",
    ),
    "waste_to_grain": ("waste_grain", f"SELECT * {_DAY} FROM waste_grain"),
    "silver": ("silver", f"SELECT * {_DAY} FROM silver"),
    "orphan_waste": (
        "waste production_not_p",
        f"SELECT * {_DAY}, 'portion' AS unit FROM waste w WHERE NOT EXISTS ("
        "SELECT 1 FROM production_not_p p WHERE p.date = w.date "
        "AND p.location_id = w.location_id AND p.menu_item_id = w.menu_item_id "
        "AND p.meal_period = w.meal_period)",
    ),
    "waste_exceeds_prepared": (
        "waste production",
        f"SELECT w.* REPLACE (CAST(w.date AS VARCHAR) AS date, w.quantity_wasted * 2 AS quantity_wasted), "
        "'portion' AS unit, p.quantity_prepared FROM waste w JOIN production p "
        "ON p.date = w.date AND p.location_id = w.location_id "
        "AND p.menu_item_id = w.menu_item_id AND p.meal_period = w.meal_period "
        "WHERE w.quantity_wasted * 2 > p.quantity_prepared",
    ),
    "dq_silver_report": (
        "silver silver_doubled dim_waste_reason",
        _check_rows("silver", "'silver' AS case_name", _SILVER_CHECKS, False)
        + "\nUNION ALL\n"
        + _check_rows("silver_doubled", "'doubled'", _SILVER_CHECKS, False),
    ),
    "dq_fact_report": (
        " ".join(_FACT_CHECKS),
        "\nUNION ALL\n".join(
            _check_rows(fact, f"'{fact}' AS fact", checks, True)
            for fact, checks in _FACT_CHECKS.items()
        ),
    ),
    "dq_unique_report": (
        "dim_category dim_date dim_location dim_menu dim_supplier",
        "\nUNION ALL\n".join(
            _unique(t, k)
            for t, k in (
                ("lineitem", "l_orderkey, l_linenumber"), ("dim_category", "category_sk"),
                ("dim_date", "date_sk"), ("dim_location", "location_sk"),
                ("dim_menu", "menu_sk"), ("dim_supplier", "supplier_sk"),
            )
        ),
    ),
    "scd2_gate_report": (
        "dim_supplier dim_supplier_open",
        _versions("history", "dim_supplier")
        + "\nUNION ALL\n"
        + _versions("never_closed", "dim_supplier_open"),
    ),
    "scd1_location": (
        "dim_location",
        f"SELECT * REPLACE ({_OLD_KEY.format(key='location_id', sk='location_sk')} "
        "AS location_sk) FROM dim_location",
    ),
    "scd1_menu": (
        "dim_menu",
        f"SELECT * REPLACE ({_OLD_KEY.format(key='menu_item_id', sk='menu_sk')} "
        "AS menu_sk) FROM dim_menu",
    ),
    "supplier_latest": (
        "supplier_records",
        "SELECT supplier_id, supplier_name, menu_item_id, supplier_city, lead_time_days, "
        "quality_score FROM supplier_records WHERE is_current <> '0' "
        "QUALIFY row_number() OVER (PARTITION BY supplier_id ORDER BY effective_from DESC) = 1",
    ),
    "scd2_supplier": ("dim_supplier", "SELECT * FROM dim_supplier"),
    "supplier_as_of": (
        "silver dim_supplier",
        "SELECT CAST(s.date AS VARCHAR) AS date, s.location_id, s.menu_item_id, s.meal_period, "
        "s.waste_cost, d.supplier_sk, d.supplier_id, d.quality_score "
        "FROM silver s LEFT JOIN dim_supplier d ON s.menu_item_id = d.menu_item_id "
        "AND CAST(s.date AS VARCHAR) BETWEEN d.effective_date AND d.expiry_date "
        "WHERE s.waste_reason IS NOT NULL",
    ),
    "fact_waste_best_quality": ("fact_waste_best", "SELECT * FROM fact_waste_best"),
    "table_counts": (
        " ".join(_COUNTED),
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
            for t in _COUNTED
        ),
    ),
    "mom_by_location": (
        "summary dim_location",
        _change(
            f"SELECT location_sk, year, month, {_total('total_waste_cost')} AS total_waste_cost "
            "FROM summary GROUP BY location_sk, year, month",
            "year, month",
        ),
    ),
    "mom_by_location_literal": (
        "summary dim_location", _change("SELECT * FROM summary", "year, month, category"),
    ),
    "top_menu_items": (
        "items",
        "SELECT menu_item_name, category, total_waste_cost, waste_rank FROM items "
        "WHERE waste_rank <= 10",
    ),
    "demand_gap": ("supply_summed summary", _GAP_TAIL.replace("supply ", "supply_summed ")),
    "demand_gap_literal": ("supply_paired summary", _GAP_TAIL.replace("supply ", "supply_paired ")),
    "supplier_quality_vs_waste": (
        "wasted dim_supplier dim_menu",
        f"""
SELECT supplier_name, supplier_city, quality_score, menu_item_name, category, waste_percentage,
       CAST(sum(pct) OVER (PARTITION BY supplier_sk) AS DOUBLE)
           / count(pct) OVER (PARTITION BY supplier_sk) AS supplier_avg_waste_pct,
       CAST(sum(pct) OVER () AS DOUBLE) / count(pct) OVER () AS overall_avg_waste_pct
FROM (SELECT w.supplier_sk, d.supplier_name, d.supplier_city, d.quality_score,
             m.menu_item_name, m.category, w.waste_percentage,
             CAST(w.waste_percentage AS DECIMAL(18,8)) AS pct
      FROM wasted w JOIN dim_supplier d ON w.supplier_sk = d.supplier_sk AND d.is_current
      JOIN dim_menu m ON w.menu_sk = m.menu_sk)""",
    ),
    "reason_by_meal": (
        "wasted dim_waste_reason dim_meal_period",
        _reasons("JOIN dim_meal_period USING (meal_period_sk)"),
    ),
    "reason_by_meal_literal": (
        "wasted dim_waste_reason dim_meal_period", _reasons("JOIN dim_meal_period ON year = 1997"),
    ),
    "root_cause": ("causes", f"SELECT *, {_LONG_TEXT} AS recommendation FROM causes"),
    "available_years": ("fact_waste_summary", "SELECT DISTINCT year FROM fact_waste_summary"),
    "kpi_monthly": (
        "months",
        "SELECT *, strftime(make_date(year, month, 1), '%b') AS month_label FROM months",
    ),
    "kpi_totals": (
        "months",
        f"SELECT {_total('total_waste_quantity')} AS total_waste_quantity, "
        f"{_total('total_waste_cost')} AS total_waste_cost, "
        f"{_mean('avg_waste_percentage')} AS avg_waste_percentage FROM months",
    ),
    "waste_pct_weighted": (
        "silver",
        f"""
SELECT year, month, quantity_wasted, quantity_prepared, mean_waste_pct,
       quantity_wasted * 100.0 / nullif(quantity_prepared, 0) AS weighted_waste_pct
FROM (SELECT year, month, {_sum('quantity_wasted')} AS quantity_wasted,
             {_sum('quantity_prepared')} AS quantity_prepared,
             {_mean('waste_percentage')} AS mean_waste_pct
      FROM silver WHERE year = {YEAR} AND quantity_wasted > 0 GROUP BY year, month)""",
    ),
    "location_trend": ("trend", "SELECT * FROM trend"),
    "location_trend_topn": (
        "trend places",
        "SELECT * FROM trend WHERE location_name IN (SELECT location_name FROM places LIMIT 4)",
    ),
    "top_locations": ("places", "SELECT * FROM places LIMIT 5"),
    "costliest_location": ("places", "SELECT * FROM places LIMIT 1"),
    "top_items_by_category": (
        "items",
        "SELECT * FROM items WHERE category = 'DAIRY' "
        "ORDER BY total_waste_cost DESC, menu_item_name LIMIT 10",
    ),
    "top_items_by_qty": (
        "items",
        "SELECT * EXCLUDE (waste_rank) FROM items "
        "ORDER BY total_waste_quantity DESC, menu_item_name, category LIMIT 5",
    ),
    "worst_category": (
        "summary",
        f"SELECT category, {_mean('avg_waste_percentage')} AS avg_waste_pct FROM summary "
        "GROUP BY category ORDER BY avg_waste_pct DESC, category LIMIT 1",
    ),
    "category_slice": (
        "summary",
        f"SELECT category, year, month, {_total('total_waste_quantity')} AS total_waste_quantity, "
        f"{_total('total_waste_cost')} AS total_waste_cost, "
        f"{_mean('avg_waste_percentage')} AS avg_waste_percentage, "
        "CAST(sum(waste_event_count) AS BIGINT) AS waste_event_count "
        "FROM summary WHERE lower(category) = 'main course' GROUP BY category, year, month",
    ),
    "trend_mom": ("changes", "SELECT * REPLACE (CAST(period AS VARCHAR) AS period) FROM changes"),
    "trend_spikes": (
        "changes",
        "SELECT strftime(period, '%b %Y') AS month_label, total_waste_cost, mom_pct_change "
        "FROM changes WHERE mom_pct_change > 10",
    ),
    "root_cause_counts": (
        "causes", "SELECT root_cause, count(*) AS group_count FROM causes GROUP BY root_cause",
    ),
    "root_cause_filtered": (
        "causes",
        "SELECT location_name, category_name, year, month, waste_percentage, total_waste_cost, "
        f"root_cause, {_SHORT_TEXT} AS recommendation FROM causes "
        "WHERE location_name = 'NATION_3' AND root_cause = 'Storage / Spoilage'",
    ),
    "commonest_reason": (
        "wasted dim_waste_reason",
        "SELECT waste_reason_name, count(*) AS event_count FROM wasted "
        "JOIN dim_waste_reason USING (waste_reason_sk) GROUP BY waste_reason_name "
        "ORDER BY event_count DESC, waste_reason_name LIMIT 1",
    ),
    "costliest_supplier": (
        "wasted dim_supplier",
        f"SELECT supplier_id, supplier_name, {_sum('waste_cost')} AS total_waste_cost "
        "FROM wasted JOIN dim_supplier USING (supplier_sk) WHERE is_current "
        "GROUP BY supplier_id, supplier_name ORDER BY total_waste_cost DESC, supplier_id LIMIT 1",
    ),
}
FINALS |= {
    "unreadable_report": ("waste", """
        SELECT 'date_readable' AS check_name, count(*) FILTER (location_id LIKE '%7') AS failing_rows FROM waste
        UNION ALL
        SELECT 'quantity_wasted_readable', count(*) FILTER (menu_item_id LIKE '%3' OR menu_item_id LIKE '%4') FROM waste"""),
    "malformed_rows_report": ("waste", """
        SELECT 'well_formed' AS check_name, count(*) FILTER (menu_item_id LIKE '%3') AS failing_rows FROM waste"""),
    "batch_run_counts": (" ".join(_COUNTED) + " supplier_records", "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}"
        for t in _COUNTED if t not in ("dim_supplier", "fact_waste")
    ) + """
        UNION ALL SELECT 'dim_supplier', count(DISTINCT supplier_id) FROM supplier_records WHERE load_no = 1
        UNION ALL SELECT 'fact_waste', count(*) FROM silver s LEFT JOIN (
            SELECT DISTINCT supplier_id, menu_item_id FROM supplier_records WHERE load_no = 1) d
          ON s.menu_item_id = d.menu_item_id WHERE s.waste_reason IS NOT NULL"""),
    "fact_key_report": ("fact_production fact_waste fact_consumption", "UNION ALL ".join(
        f"SELECT '{fact}' AS table_name, 'unique_{key}' AS check_name, "
        f"count(*) - count(DISTINCT {key}) AS failing_rows FROM {fact} "
        for fact, key in (("fact_production", "production_sk"), ("fact_waste", "waste_sk"), ("fact_consumption", "consumption_sk"))
    ) + """UNION ALL
        SELECT 'production_january_twice', 'unique_production_sk', count(*) FROM fact_production WHERE month = 1"""),
    "supplier_fanout_report": ("silver fact_waste dim_supplier", """
        SELECT (SELECT count(*) FROM silver WHERE waste_reason IS NOT NULL) AS rows_before,
            (SELECT count(*) FROM fact_waste) AS rows_after,
            (SELECT count(*) FROM (SELECT menu_item_id FROM dim_supplier WHERE is_current
                GROUP BY menu_item_id HAVING count(*) > 1)) AS shared_items"""),
    "silver_two_loads": ("production waste_grain", """
        SELECT CAST(p.date AS VARCHAR) AS date, p.location_id, p.menu_item_id, p.meal_period,
            CASE WHEN p.menu_item_id SIMILAR TO '.*[02468]' THEN 2 ELSE 1 END * p.quantity_prepared AS quantity_prepared,
            coalesce(w.quantity_wasted, 0) AS quantity_wasted, w.waste_reason, w.waste_stage,
            coalesce(w.quantity_wasted, 0) * p.cost_per_unit AS waste_cost
        FROM production p LEFT JOIN waste_grain w
          ON p.date = w.date AND p.location_id = w.location_id AND p.menu_item_id = w.menu_item_id
         AND p.meal_period = w.meal_period
         AND (p.menu_item_id SIMILAR TO '.*[13579]' OR p.location_id SIMILAR TO '.*[13579]')"""),
    "filter_values": ("fact_waste_summary dim_category dim_location causes", """
        SELECT DISTINCT 'year' AS kind, CAST(year AS VARCHAR) AS value FROM fact_waste_summary
        UNION ALL SELECT DISTINCT 'category', category_name FROM dim_category
        UNION ALL SELECT DISTINCT 'location', location_name FROM dim_location
        UNION ALL SELECT DISTINCT 'cause', root_cause FROM causes"""),
}
# Month by month after a second run that brought the logs of March 1997 again, production doubled.
_FIRST_SUPPLIERS = "(SELECT DISTINCT supplier_id, menu_item_id FROM supplier_records WHERE load_no = 1)"
_AGAIN = "(year = 1997 AND month = 3)"


def _by_month(name: str, amount: str, table: str, factor: str = "1") -> str:
    return (
        f"SELECT '{name}' AS table_name, year, month, count(*) AS row_count, "
        f"{_sum(amount)} * {factor} AS amount, {_AGAIN} AS built_again FROM {table} GROUP BY year, month"
    )


_TWICE = f"(CASE WHEN {_AGAIN} THEN 2 ELSE 1 END)"
FINALS["incremental_run"] = ("silver supplier_records fact_waste_summary", " UNION ALL ".join((
    _by_month("silver", "quantity_prepared", "silver", _TWICE),
    _by_month("fact_production", "quantity_prepared", "silver", _TWICE),
    _by_month("fact_consumption", "quantity_prepared", "silver", _TWICE),
    _by_month("fact_waste", "quantity_wasted", f"silver s LEFT JOIN {_FIRST_SUPPLIERS} d "
              "ON s.menu_item_id = d.menu_item_id WHERE s.waste_reason IS NOT NULL"),
    _by_month("fact_waste_summary", "total_waste_quantity", "fact_waste_summary"),
)))
FINALS["bronze_month_index"] = ("production waste", " UNION ALL ".join(
    f"SELECT DISTINCT '{source}' AS source, '{day}' AS load_date, strftime(date, '%Y-%m') AS month, true AS read_again "
    f"FROM {table} {where}"
    for source, table in (("production_logs", "production"), ("waste_logs", "waste"))
    for day, where in (("1995-01-01", ""), ("1998-01-01", "WHERE strftime(date, '%Y-%m') = '1997-03'"))
))
FINALS["bronze_source_files"] = ("production waste menu location supplier_records", " UNION ALL ".join(
    f"SELECT '{source}' AS source, 2 AS files, count(*) AS row_count FROM {table}"
    for source, table in (("production_logs", "production"), ("waste_logs", "waste"), ("menu_data", "menu"),
                          ("location_data", "location"), ("supplier_data", "supplier_records WHERE load_no = 1"))
))
FINALS["scd2_history"] = ("supplier_base", """
SELECT md5(supplier_id || '|' || day) AS supplier_sk, supplier_id, supplier_name, menu_item_id, supplier_city,
       lead_time_days, quality_score, CAST(day AS VARCHAR) AS effective_date,
       CASE WHEN next IS NULL THEN '9999-12-31' ELSE CAST(next - 1 AS VARCHAR) END AS expiry_date, next IS NULL AS is_current
FROM (
    SELECT *, lead(day) OVER (PARTITION BY supplier_id ORDER BY day) AS next
    FROM (
        SELECT *, lag(quality_score) OVER (PARTITION BY supplier_id ORDER BY day) AS before
        FROM (
            SELECT *, DATE '1995-01-01' AS day FROM supplier_base WHERE k % 10 <> 7
            UNION ALL
            SELECT * REPLACE (quality_score + CASE WHEN k % 3 = 0 THEN 0.5 ELSE 0 END AS quality_score), DATE '1998-01-01'
            FROM supplier_base WHERE k % 5 <> 4
            UNION ALL
            SELECT * REPLACE (quality_score + CASE WHEN k % 3 = 0 THEN 0.5 ELSE 0 END
                              + CASE WHEN k % 4 = 0 THEN 0.25 ELSE 0 END AS quality_score), DATE '1998-06-01'
            FROM supplier_base WHERE k % 5 <> 4 AND k % 7 <> 0
        )
    )
    WHERE before IS NULL OR before <> quality_score
)""")


def _first_shown(mart: str, order: str, *columns: str) -> str:
    shown = " || '|' || ".join(columns)
    return (
        f"SELECT '{mart}' AS mart, position, shown FROM (SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) "
        f"AS position, {shown} AS shown FROM ({FINALS[mart][1]})) WHERE position < 20"
    )


def _four(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(28,4)) AS VARCHAR)"


_SHOWN = {
    "mom_by_location": ("location_name, year, month", "location_name", "year", "month"),
    "top_menu_items": ("waste_rank", "CAST(waste_rank AS VARCHAR)"),
    "demand_gap": ("total_demand_gap DESC NULLS LAST", _four("total_demand_gap")),
    "supplier_quality_vs_waste": (
        "quality_score, waste_percentage DESC NULLS LAST", _four("quality_score"), _four("waste_percentage")),
    "reason_by_meal": ("meal_period_name, total_cost DESC NULLS LAST", "meal_period_name", _four("total_cost")),
    "root_cause": ("waste_percentage DESC NULLS LAST", _four("waste_percentage")),
}
FINALS["display_orders"] = (
    " ".join(dict.fromkeys(" ".join(FINALS[mart][0] for mart in _SHOWN).split())),
    " UNION ALL ".join(_first_shown(mart, *how) for mart, how in _SHOWN.items()),
)
for _name in (
    "dim_date", "dim_category", "fact_production", "fact_waste", "fact_consumption",
    "fact_waste_summary",
):
    FINALS[_name] = (_name, f"SELECT * FROM {_name}")


def _ordered(needs: tuple[str, ...], done: list[str]) -> list[str]:
    for name in needs:
        if name not in done:
            _ordered(PARTS[name][0], done)
            done.append(name)
    return done


def sql(query: str) -> str:
    needs, final = FINALS[query]
    names = _ordered(tuple(needs.split()), [])
    if not names:
        return final.strip()
    tables = ",\n".join(f"{n} AS (\n{PARTS[n][1]}\n)" for n in names)
    return f"WITH {tables}\n{final.strip()}"


ORACLE = {name: sql(name) for name in FINALS}
