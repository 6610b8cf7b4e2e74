"""SQL counterparts of the registered queries, run by another engine over the same tables.

Written independently of the library: baseline by look-back joins, gap filling by calendar
join, newest row by row number.
"""

from __future__ import annotations


def months(x: str) -> str:
    return f"(year({x}) * 12 + month({x}))"


def shift(x: str, n: int) -> str:
    return f"last_day({x} + INTERVAL {n} MONTH)" if n >= 0 else f"last_day({x} - INTERVAL {-n} MONTH)"


def demand(by: str, source: str, last: str = "(SELECT last_ym FROM bounds)") -> str:
    """Interval, variability and recent mean of demand per group."""
    return f"""
    SELECT {by}, launch_ym, CAST(n AS INTEGER) AS months, hits AS nonzero_months,
           n / NULLIF(hits, 0) AS adi,
           CAST(hits * squares - total * total AS DOUBLE) / CAST(total * total AS DOUBLE) AS cv2,
           recent / least(12, n) AS mean_qty
    FROM (
      SELECT {by}, min(ym) FILTER (qty > 0) AS launch_ym, count(*) FILTER (qty > 0) AS hits,
             {months(last)} - {months('min(ym) FILTER (qty > 0)')} + 1 AS n,
             sum(CAST(qty AS HUGEINT)) FILTER (qty > 0) AS total, sum(CAST(qty AS HUGEINT) * qty) FILTER (qty > 0) AS squares,
             COALESCE(sum(qty) FILTER ({months('ym')} > {months(last)} - 12), 0) AS recent
      FROM (SELECT {by}, ym, sum(qty) AS qty FROM {source} GROUP BY ALL) GROUP BY {by})"""


CLASS = """CASE WHEN adi IS NULL THEN NULL WHEN cv2 >= 1.1 THEN 'lumpy_severe'
           WHEN adi < 1.32 AND cv2 < 0.49 THEN 'smooth' WHEN adi < 1.32 THEN 'erratic'
           WHEN cv2 < 0.49 THEN 'intermittent' ELSE 'lumpy' END"""

SCORE = """abs(a.qty - f.p50) AS abs_error,
           CASE WHEN a.qty > 0 THEN abs(a.qty - f.p50) / a.qty END AS ape,
           CASE WHEN a.qty BETWEEN f.lower_bound AND f.upper_bound THEN 1 ELSE 0 END AS within_interval"""


def shipments(prefix: str, item: str) -> str:
    """Sparse and gap-free shipments at one grain."""
    return f"""
    {prefix}sparse AS (
      SELECT {item} AS item_code, channel, ym, CAST(sum(l_quantity) AS BIGINT) AS qty
      FROM lines JOIN part ON p_partkey = l_partkey
      GROUP BY ALL),
    {prefix}ship AS (
      SELECT s.item_code, s.channel, c.ym, COALESCE(x.qty, 0) AS qty
      FROM (SELECT DISTINCT item_code, channel FROM {prefix}sparse) s CROSS JOIN cal c
      LEFT JOIN {prefix}sparse x ON x.item_code = s.item_code AND x.channel = s.channel AND x.ym = c.ym)"""


def naive(prefix: str) -> str:
    """Same month last year, else two years ago, for history and 18 months ahead."""
    return f"""
    {prefix}baseline AS (
      SELECT item_code, channel, target_ym,
             CASE WHEN target_ym > last_ym THEN last_ym ELSE {shift('target_ym', -1)} END AS forecast_run_ym,
             'baseline_seasonal_naive' AS model_name, p50,
             floor(p50 * 0.6 + 0.5) AS lower_bound, floor(p50 * 1.5 + 0.5) AS upper_bound
      FROM (
        SELECT t.item_code, t.channel, t.target_ym, CAST(COALESCE(a.qty, b.qty) AS DOUBLE) AS p50
        FROM (SELECT * FROM (SELECT DISTINCT item_code, channel FROM {prefix}ship) CROSS JOIN targets) t
        LEFT JOIN {prefix}ship a ON a.item_code = t.item_code AND a.channel = t.channel AND a.ym = {shift('t.target_ym', -12)}
        LEFT JOIN {prefix}ship b ON b.item_code = t.item_code AND b.channel = t.channel AND b.ym = {shift('t.target_ym', -24)})
      CROSS JOIN bounds WHERE p50 IS NOT NULL)"""


FEATURES = """
      SELECT item_code, channel, ym, qty,
             CAST(month(ym) AS INTEGER) AS month,
             CAST(year(ym) * 12 + month(ym) - (SELECT year(first_ym) FROM bounds) * 12 AS INTEGER) AS month_index,
             lag(qty, 1) OVER w AS lag_1, lag(qty, 2) OVER w AS lag_2, lag(qty, 3) OVER w AS lag_3,
             lag(qty, 12) OVER w AS lag_12,
             avg(qty) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS roll_mean_3,
             avg(qty) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS roll_mean_6,
             avg(qty) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS roll_mean_12,
             stddev_samp(qty) OVER (w ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS roll_std_6,
             COALESCE(sum(CASE WHEN qty > 0 THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 0)
               / least(row_number() OVER w, 12) AS nonzero_ratio_12
      FROM {source} WINDOW w AS (PARTITION BY item_code, channel ORDER BY ym)"""

# relations shared by the statements below, in order of dependence
RELATIONS = f"""
    lines AS (
      SELECT l_partkey, l_suppkey, l_linestatus, l_quantity, last_day(CAST(l_shipdate AS DATE)) AS ym,
             CASE l_returnflag WHEN 'N' THEN 'DOM' WHEN 'A' THEN 'EXP' ELSE 'RET' END AS channel
      FROM lineitem WHERE l_shipdate < (SELECT date_trunc('month', max(l_shipdate) + INTERVAL 1 DAY) FROM lineitem)),
    bounds AS (SELECT min(ym) AS first_ym, max(ym) AS last_ym FROM lines),
    cal AS (
      SELECT last_day(CAST(m AS DATE)) AS ym FROM (
        SELECT unnest(generate_series(date_trunc('month', first_ym), CAST(last_ym AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM bounds)),
    targets AS (
      SELECT last_day(CAST(m AS DATE)) AS target_ym FROM (
        SELECT unnest(generate_series(date_trunc('month', first_ym) + INTERVAL 12 MONTH,
                                      date_trunc('month', last_ym) + INTERVAL 18 MONTH, INTERVAL 1 MONTH)) AS m FROM bounds)),
    {shipments('', "p_brand || '_' || p_type")},
    {shipments('part_', 'CAST(p_partkey AS VARCHAR)')},
    stats AS ({demand('item_code', 'ship')}),
    series_stats AS ({demand('item_code, channel', 'ship')}),
    series_class AS (SELECT *, {CLASS} AS demand_class FROM series_stats),
    routes AS (
      SELECT *, CASE WHEN demand_class IN ('smooth', 'erratic') THEN 'main_pipeline' ELSE 'simple_rule' END AS forecast_source
      FROM series_class),
    items AS (
      SELECT item_code, brand || ' ' || cat AS item_name, cat AS item_category,
             CASE WHEN cat IN ('ECONOMY', 'STANDARD') THEN 'main' ELSE 'consumable' END AS item_type,
             unit_price, {CLASS} AS demand_class, adi, cv2, 
             item_code NOT IN (SELECT item_code FROM sparse WHERE channel = 'EXP' AND qty > 0) AS is_domestic_only, launch_ym
      FROM (SELECT p_brand || '_' || p_type AS item_code, max(p_brand) AS brand, max(p_type) AS cat,
                   CAST(floor(min(p_retailprice)) AS INTEGER) AS unit_price FROM part GROUP BY 1)
      JOIN stats USING (item_code)),
    channels AS (
      SELECT DISTINCT channel AS channel_code, CASE channel WHEN 'DOM' THEN 'Domestic' ELSE 'Export' END AS channel_name,
             CASE channel WHEN 'DOM' THEN 'Domestic dealers and direct sales' ELSE 'Overseas dealers' END AS description
      FROM lines WHERE channel IN ('DOM', 'EXP')),
    fct AS (
      SELECT s.item_code, s.channel, s.ym, s.qty, s.qty * CAST(i.unit_price AS BIGINT) AS amount
      FROM ship s LEFT JOIN items i ON i.item_code = s.item_code),
    supply AS (
      SELECT p_brand || '_' || p_type AS item_code, r_name AS site_code, ym, l_quantity, l_linestatus, l_suppkey
      FROM lines JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
    flows AS (
      SELECT item_code, site_code, ym, CAST(sum(l_quantity) AS BIGINT) AS qty,
             CAST(COALESCE(sum(l_quantity) FILTER (l_linestatus = 'O'), 0) AS BIGINT) AS closing_qty
      FROM supply GROUP BY ALL),
    positions AS (
      SELECT k.item_code, k.site_code, c.ym, COALESCE(f.qty, 0) AS qty, COALESCE(f.closing_qty, 0) AS closing_qty
      FROM (SELECT DISTINCT item_code, site_code FROM flows) k CROSS JOIN cal c
      LEFT JOIN flows f ON f.item_code = k.item_code AND f.site_code = k.site_code AND f.ym = c.ym),
    inventory AS (
      SELECT item_code, site_code, ym, closing_qty, safety_stock_qty,
             CASE WHEN closing_qty = 0 AND safety_stock_qty > 0 THEN 1 ELSE 0 END AS stockout_flag
      FROM (SELECT *, CAST(floor(avg(qty) OVER (PARTITION BY item_code, site_code ORDER BY ym
                                 ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) * 1.5 + 0.5) AS BIGINT) AS safety_stock_qty
            FROM positions)),
    stock AS (SELECT *, closing_qty - safety_stock_qty AS surplus_qty FROM inventory),
    lead_time AS (
      SELECT item_code, site_code, CAST(min(l_suppkey % 60) + 1 AS INTEGER) AS standard_lead_time_days
      FROM supply GROUP BY ALL),
    {naive('')},
    {naive('part_')},
    accuracy AS (
      SELECT f.item_code, f.channel, f.target_ym, f.forecast_run_ym, f.model_name,
             f.p50 AS forecast_qty, a.qty AS actual_qty, {SCORE}
      FROM baseline f JOIN ship a ON a.item_code = f.item_code AND a.channel = f.channel AND a.ym = f.target_ym),
    rolled AS (
      SELECT item_code, channel, ym, avg(qty) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS mean_12,
             CAST(lag(qty) OVER w AS DOUBLE) AS last_value, row_number() OVER w AS nth
      FROM ship WINDOW w AS (PARTITION BY item_code, channel ORDER BY ym)),
    mean_12 AS (
      SELECT item_code, channel, ym AS target_ym, {shift('ym', -1)} AS forecast_run_ym, 'mean_12' AS model_name,
             mean_12 AS p50, mean_12 * 0.7 AS lower_bound, mean_12 * 1.3 AS upper_bound FROM rolled WHERE nth > 12),
    last_value AS (
      SELECT item_code, channel, ym AS target_ym, {shift('ym', -1)} AS forecast_run_ym, 'last_value' AS model_name,
             last_value AS p50, last_value * 0.7 AS lower_bound, last_value * 1.3 AS upper_bound FROM rolled WHERE nth > 12),
    forecasts AS (
      SELECT item_code, channel, target_ym, model_name, p50, lower_bound, upper_bound FROM baseline
      UNION ALL SELECT item_code, channel, target_ym, model_name, p50, lower_bound, upper_bound FROM mean_12
      UNION ALL SELECT item_code, channel, target_ym, model_name, p50, lower_bound, upper_bound FROM last_value),
    scored AS (
      SELECT f.item_code, f.channel, f.target_ym, f.model_name, f.p50 AS forecast_qty, a.qty AS actual_qty, {SCORE}
      FROM forecasts f JOIN ship a ON a.item_code = f.item_code AND a.channel = f.channel AND a.ym = f.target_ym),
    versus AS (
      SELECT item_code, channel, target_ym, CASE model_name WHEN 'mean_12' THEN 'model' ELSE 'baseline' END AS src, abs_error
      FROM scored WHERE model_name <> 'last_value'),
    features AS ({FEATURES.format(source='ship')}),
    training AS (
      SELECT * FROM features WHERE lag_12 IS NOT NULL AND roll_mean_3 IS NOT NULL AND roll_mean_12 IS NOT NULL
        AND roll_std_6 IS NOT NULL),
    nth AS (SELECT ym, row_number() OVER (ORDER BY ym DESC) AS n FROM (SELECT DISTINCT ym FROM sparse)),
    split_6 AS (
      SELECT *, CASE WHEN ym > (SELECT ym FROM nth WHERE n = 7) THEN 'unseen'
                     WHEN ym >= (SELECT ym FROM nth WHERE n = 18) THEN 'valid' ELSE 'train' END AS split,
             ym >= (SELECT ym FROM nth WHERE n = 3) AS is_recent FROM training),
    newest AS (
      SELECT *, ym >= (SELECT ym FROM nth WHERE n = 3) AS is_recent
      FROM training WHERE ym >= (SELECT ym FROM nth WHERE n = 12)),
    bronze AS (
      SELECT item_code, channel, CAST(date_trunc('month', ym) AS DATE) AS ym, qty, 'a.csv' AS _source_file,
             TIMESTAMP '2001-11-02' AS _ingested_at FROM sparse
      UNION ALL SELECT item_code, channel, ym, qty + 1, 'b.csv', TIMESTAMP '2001-11-03' FROM sparse WHERE month(ym) = 6),
    messy AS (
      SELECT item_code, CASE WHEN month(ym) = 2 AND channel = 'DOM' THEN NULL ELSE ym END AS ym,
             CASE WHEN month(ym) = 2 AND channel = 'DOM' THEN '未定'
                  ELSE year(ym) || '年' || month(ym) || '月' END AS ym_raw,
             qty * 100 AS qty, format('{{:,}}', qty * 100) AS qty_raw FROM sparse),
    placed AS (SELECT *, row_number() OVER (PARTITION BY item_code, channel ORDER BY ym) AS t FROM ship),
    origins AS (
      SELECT window_no, (SELECT count(*) FROM cal) - 24 + 6 * window_no AS cut FROM (SELECT unnest([0, 1]) AS window_no)),
    rule_steps AS (
      SELECT a.item_code, a.channel, o.window_no, o.cut, a.qty AS actual, n.qty AS naive_12, l.qty AS last_value, m.mean_12
      FROM placed a JOIN origins o ON a.t BETWEEN o.cut + 1 AND o.cut + 18
      JOIN placed n ON n.item_code = a.item_code AND n.channel = a.channel
                   AND n.t = o.cut - 11 + (a.t - o.cut - 1) % 12
      JOIN placed l ON l.item_code = a.item_code AND l.channel = a.channel AND l.t = o.cut
      JOIN (SELECT item_code, channel, window_no, avg(qty) AS mean_12 FROM placed JOIN origins ON t BETWEEN cut - 11 AND cut
            GROUP BY ALL) m ON m.item_code = a.item_code AND m.channel = a.channel AND m.window_no = o.window_no),
    rule_scores AS (
      SELECT item_code || '|' || channel AS unique_id, model, CAST(window_no AS INTEGER) AS window_no,
             avg(CASE WHEN abs(actual) + abs(f) = 0 THEN 0 ELSE 2 * abs(actual - f) / (abs(actual) + abs(f)) END) AS metric_value
      FROM (SELECT *, unnest(['naive_12', 'last_value', 'mean_12', 'zero']) AS model,
                   unnest([CAST(naive_12 AS DOUBLE), CAST(last_value AS DOUBLE), mean_12, 0.0]) AS f FROM rule_steps)
      GROUP BY item_code, channel, model, window_no),
    rule_means AS (
      SELECT unique_id, model, round(avg(metric_value), 9) AS avg_metric FROM rule_scores GROUP BY ALL),
    best AS (
      SELECT unique_id, model, avg_metric, 'main_pipeline' AS forecast_source FROM rule_means
      QUALIFY rank() OVER (PARTITION BY unique_id ORDER BY avg_metric) = 1),
    best_first AS (
      SELECT unique_id, model, avg_metric FROM rule_means
      QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY avg_metric, model) = 1),
    routed AS (
      SELECT r.item_code || '|' || r.channel AS unique_id,
             CASE WHEN r.forecast_source = 'simple_rule' THEN 'naive_12' ELSE COALESCE(b.model, 'naive_12') END AS model,
             CASE WHEN r.forecast_source <> 'simple_rule' THEN b.avg_metric END AS avg_metric, r.forecast_source
      FROM routes r LEFT JOIN best_first b ON b.unique_id = r.item_code || '|' || r.channel),
    ahead AS (
      SELECT CAST(k AS INTEGER) AS k, last_day(CAST(date_trunc('month', last_ym) + to_months(CAST(k AS INTEGER)) AS DATE)) AS target_ym
      FROM bounds, (SELECT unnest(generate_series(1, 18)) AS k)),
    last_year AS (SELECT p.*, row_number() OVER (PARTITION BY item_code, channel ORDER BY ym) AS m
                  FROM (SELECT * FROM ship WHERE ym > (SELECT {shift('last_ym', -12)} FROM bounds)) p),
    year_mean AS (SELECT item_code, channel, avg(qty) AS mean_12, arg_max(qty, ym) AS last_value FROM last_year GROUP BY ALL)
"""


def ratio(a: str, b: str) -> str:
    return f"{a} / NULLIF({b}, 0)"


def six(x: str, name: str) -> str:
    return f"round({x}, 6) AS {name}"


def big(x: str, name: str) -> str:
    return f"CAST({x} AS BIGINT) AS {name}"


MEASURES = (f"count(*) AS n, {six('avg(ape) * 100', 'ape_pct')}, {six('avg(abs_error)', 'avg_abs_error')}, "
            f"{six('avg(within_interval) * 100', 'hit_pct')}")
ITEM_COLUMNS = ("item_code, item_name, item_category, item_type, unit_price, demand_class, "
                "round(adi, 6) AS adi, round(cv2, 6) AS cv2, is_domestic_only, launch_ym")
FORECAST = "item_code, channel, target_ym, forecast_run_ym, model_name, p50, lower_bound, upper_bound"
SCORED = ("forecast_qty, actual_qty, round(abs_error, 6) AS abs_error, round(ape, 6) AS ape, within_interval")
STATS = ("launch_ym, months, nonzero_months, round(adi, 6) AS adi, round(cv2, 6) AS cv2, round(mean_qty, 6) AS mean_qty")
METRIC = (f"{six('avg(ape)', 'avg_ape')}, {six('avg(abs_error)', 'avg_abs_error')}, "
          f"{six('avg(within_interval)', 'hit_rate')}, count(*) AS n")


def resent(source: str, columns: str, key: str, older: str) -> str:
    """Newest row per key of an older, altered copy and a later, right one."""
    return f"""
    SELECT {columns} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY copy_no DESC) AS rn FROM (
        SELECT {older}, 1 AS copy_no FROM {source} UNION ALL SELECT *, 2 AS copy_no FROM {source}))
    WHERE rn = 1"""


def rule_count(relation: str, source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, '{name}' AS rule, count(*) FILTER ({rule}) AS passed, "
        f"count(*) FILTER (NOT ({rule})) AS failed, count(*) FILTER (({rule}) IS NULL) AS unknown FROM {source}"
        for name, rule in rules.items())


def compared(by: str = "") -> str:
    """Two rules scored on the newest twelve and three months."""
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    errors = ("avg(abs(qty - lag_12)) AS b, avg(abs(qty - lag_12)) FILTER (is_recent) AS br, "
              "avg(abs(qty - lag_1)) AS c1, avg(abs(qty - lag_1)) FILTER (is_recent) AS c1r, "
              "avg(abs(qty - roll_mean_12)) AS c2, avg(abs(qty - roll_mean_12)) FILTER (is_recent) AS c2r")
    one = (f"SELECT {lead}'%s' AS name, %s AS mae, {ratio('%s', 'b')} AS mase, %s AS mae_recent, "
           f"{ratio('%s', 'br')} AS mase_recent, b AS baseline_mae, br AS baseline_mae_recent FROM e")
    return (f"(WITH e AS (SELECT {lead}{errors} FROM newest {group}) " + one % ("champion", "c1", "c1", "c1r", "c1r")
            + " UNION ALL " + one % ("challenger", "c2", "c2", "c2r", "c2r") + ")")


def grouped(value: str, low: str = "CAST(NULL AS DOUBLE)", high: str = "CAST(NULL AS DOUBLE)", extra: str = "") -> str:
    return f"""
    SELECT s.item_code, s.channel, a.target_ym, (SELECT last_ym FROM bounds) AS forecast_run_ym,
           'ai_forecast' AS model_name, round({value}, 6) AS p50, round({low}, 6) AS lower_bound, round({high}, 6) AS upper_bound
    FROM ahead a CROSS JOIN year_mean s
    JOIN last_year l ON l.item_code = s.item_code AND l.channel = s.channel AND l.m = (a.k - 1) % 12 + 1 {extra}"""


#: hard series of the finest grain, and what each sparse method makes of them at the ends of history named by {windows}
SPARSE = f"""
    hard AS (
      SELECT item_code, channel FROM ({demand('item_code, channel', 'part_sparse')}) WHERE COALESCE({CLASS} NOT IN ('smooth', 'erratic'), TRUE)),
    months AS (
      SELECT item_code || '|' || channel AS unique_id, qty, row_number() OVER (PARTITION BY item_code, channel ORDER BY ym) AS t,
             count(*) OVER (PARTITION BY item_code, channel) AS n FROM part_ship SEMI JOIN hard USING (item_code, channel)),
    seen AS (SELECT unique_id, window_no, n - 24 + 6 * window_no AS cut, t, qty FROM months, windows WHERE t <= n - 24 + 6 * window_no),
    hits AS (
      SELECT *, row_number() OVER (PARTITION BY unique_id, window_no ORDER BY t) AS i,
             count(*) OVER (PARTITION BY unique_id, window_no) AS h FROM seen WHERE qty > 0),
    tsb AS (
      SELECT unique_id, window_no, sum(qty * CASE WHEN i = 1 THEN power(CAST(0.8 AS DOUBLE), h - 1) ELSE 0.2 * power(CAST(0.8 AS DOUBLE), h - i) END)
               * (power(CAST(0.9 AS DOUBLE), cut) * h / cut + sum(0.1 * power(CAST(0.9 AS DOUBLE), cut - t))) AS level
      FROM hits GROUP BY unique_id, window_no, cut, h),
    spans AS (
      SELECT unique_id, window_no, cut, greatest(1, least(CAST(COALESCE(round(cut / NULLIF(count(*) FILTER (qty > 0), 0)), cut) AS BIGINT), cut // 2)) AS most
      FROM seen GROUP BY unique_id, window_no, cut),
    totals AS (
      SELECT unique_id, window_no, most, k, (cut - t) // k AS j, cut // k AS m, sum(qty) AS total
      FROM seen JOIN (SELECT *, unnest(generate_series(1, most)) AS k FROM spans) USING (unique_id, window_no, cut)
      WHERE (cut - t) // k < cut // k GROUP BY unique_id, window_no, most, k, (cut - t) // k, cut // k),
    levels AS (
      SELECT unique_id, window_no, most, k,
             sum(total * CASE WHEN j = m - 1 THEN power(CAST(0.8 AS DOUBLE), j) ELSE 0.2 * power(CAST(0.8 AS DOUBLE), j) END) / k AS level
      FROM totals GROUP BY unique_id, window_no, most, k),
    sparse_levels AS (
      SELECT unique_id, window_no, 'tsb' AS model, COALESCE(level, 0.0) AS level FROM spans LEFT JOIN tsb USING (unique_id, window_no)
      UNION ALL SELECT unique_id, window_no, 'adida', level FROM levels WHERE k = most
      UNION ALL SELECT unique_id, window_no, 'imapa', avg(level) FROM levels GROUP BY unique_id, window_no),
    sparse_scores AS (
      SELECT unique_id, model, window_no,
             avg(CASE WHEN abs(qty) + abs(level) = 0 THEN 0 ELSE 2 * abs(qty - level) / (abs(qty) + abs(level)) END) AS metric_value
      FROM sparse_levels JOIN months USING (unique_id) WHERE t BETWEEN n - 23 + 6 * window_no AND n - 6 + 6 * window_no
      GROUP BY unique_id, model, window_no)"""


def sparse(windows: str, select: str) -> str:
    return f"WITH windows AS (SELECT CAST(unnest([{windows}]) AS INTEGER) AS window_no), {SPARSE} {select}"


def _statements() -> dict[str, str]:
    q: dict[str, str] = {}
    q["load_set_a"] = "SELECT * FROM ship WHERE ym < (SELECT last_ym FROM bounds)"
    q["load_set_b"] = "SELECT * FROM ship WHERE ym = (SELECT last_ym FROM bounds)"
    q["scan_shipments"] = "SELECT item_code, channel, ym, qty FROM fct"
    q["messy_ingest"] = "SELECT item_code, ym, ym_raw, qty, qty_raw FROM messy"
    q["ingest_report"] = """
    SELECT CAST(sum(n) AS BIGINT) AS rows_in, CAST(sum(bad) AS BIGINT) AS rows_failed,
           CAST(sum(n - 1) AS BIGINT) AS duplicate_rows, count(*) FILTER (n > 1) AS duplicate_keys
    FROM (SELECT item_code, ym, count(*) AS n, count(*) FILTER (ym IS NULL) AS bad FROM messy GROUP BY ALL)"""
    q["reconcile_counts"] = """
    SELECT *, n_mine = n_reference AS matches FROM (
      SELECT 'fct_shipments' AS relation, (SELECT count(*) FROM ship) AS n_mine,
             (SELECT count(*) FROM ship WHERE ym < (SELECT last_ym FROM bounds)) AS n_reference
      UNION ALL SELECT 'dim_item', (SELECT count(*) FROM items), (SELECT count(*) FROM items)
      UNION ALL SELECT 'dim_lead_time', (SELECT count(*) FROM lead_time), (SELECT count(*) FROM lead_time)
      UNION ALL SELECT 'fct_forecast_baseline', (SELECT count(*) FROM baseline), -1)"""
    q["silver_shipments"] = """
    SELECT item_code, channel, ym, qty, _source_file, _ingested_at FROM (
      SELECT item_code, channel, last_day(ym) AS ym, qty, _source_file, _ingested_at,
             row_number() OVER (PARTITION BY item_code, channel, last_day(ym)
                                ORDER BY _ingested_at DESC, _source_file DESC) AS rn FROM bronze) WHERE rn = 1"""
    q["silver_items"] = resent(
        "items", "item_code, item_name, item_category, item_type, unit_price, demand_class, round(adi, 6) AS adi, "
        "round(cv2, 6) AS cv2, is_domestic_only, last_day(launch_ym) AS launch_ym", "item_code",
        "* REPLACE (unit_price + 1 AS unit_price, CAST(date_trunc('month', launch_ym) AS DATE) AS launch_ym)")
    q["silver_channels"] = resent(
        "channels", "channel_code, channel_name, description", "channel_code",
        "* REPLACE (upper(channel_name) AS channel_name)")
    q["silver_inventory"] = resent(
        "inventory", "item_code, site_code, last_day(ym) AS ym, closing_qty, safety_stock_qty, stockout_flag",
        "item_code, site_code, last_day(ym)",
        "* REPLACE (closing_qty + 1 AS closing_qty, CAST(date_trunc('month', ym) AS DATE) AS ym)")
    q["silver_lead_time"] = resent(
        "lead_time", "item_code, site_code, standard_lead_time_days", "item_code, site_code",
        "* REPLACE (standard_lead_time_days + 1 AS standard_lead_time_days)")
    q["silver_baseline"] = resent(
        "baseline", "item_code, channel, last_day(target_ym) AS target_ym, forecast_run_ym, model_name, p50, lower_bound, upper_bound",
        "item_code, channel, last_day(target_ym), forecast_run_ym, model_name",
        "* REPLACE (p50 + 1 AS p50, CAST(date_trunc('month', target_ym) AS DATE) AS target_ym)")
    q["dedup_lineitem"] = """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1"""
    q["month_end"] = "SELECT item_code, channel, ym AS received, last_day(ym) AS ym, qty FROM bronze"
    q["dq_counts"] = " UNION ALL ".join([
        rule_count("shipments", "bronze", {
            "item_code_not_null": "item_code IS NOT NULL", "channel_is_known": "channel IN ('DOM', 'EXP')",
            "ym_not_null": "ym IS NOT NULL", "qty_not_negative": "qty >= 0"}),
        rule_count("items", "items", {
            "item_code_not_null": "item_code IS NOT NULL",
            "demand_class_is_known": "demand_class IN ('smooth', 'erratic', 'intermittent', 'lumpy', 'lumpy_severe')"}),
        rule_count("inventory", "inventory", {"closing_qty_not_negative": "closing_qty >= 0"})])
    earlier = f"(SELECT * FROM ship WHERE ym <= (SELECT {shift('last_ym', -12)} FROM bounds))"
    target = demand("item_code", earlier, f"(SELECT {shift('last_ym', -12)} FROM bounds)")

    def near(n: str, tolerance: float) -> str:
        return (f"CASE WHEN t.{n} = 0 THEN s.{n} = 0 ELSE abs(s.{n} - t.{n}) / abs(t.{n}) <= {tolerance} END AS {n}_ok")

    q["tolerance_check"] = f"""
    SELECT *, adi_ok AND cv2_ok AND mean_qty_ok AS all_ok FROM (
      SELECT item_code, round(t.adi, 6) AS target_adi, round(t.cv2, 6) AS target_cv2, round(t.mean_qty, 6) AS target_mean_qty,
             round(s.adi, 6) AS actual_adi, round(s.cv2, 6) AS actual_cv2, round(s.mean_qty, 6) AS actual_mean_qty,
             {near('adi', 0.25)}, {near('cv2', 0.35)}, {near('mean_qty', 0.20)}
      FROM ({target}) t JOIN stats s USING (item_code))"""

    q["fct_shipments"] = "SELECT * FROM fct"
    q["dim_item"] = f"SELECT {ITEM_COLUMNS} FROM items"
    q["dim_channel"] = "SELECT * FROM channels"
    q["dim_lead_time"] = "SELECT * FROM lead_time"
    q["fct_inventory"] = "SELECT * FROM stock"
    q["fct_forecast_baseline"] = f"SELECT {FORECAST} FROM baseline"
    q["fct_accuracy"] = f"SELECT item_code, channel, target_ym, forecast_run_ym, model_name, {SCORED} FROM accuracy"

    q["densify"] = "SELECT * FROM ship"
    q["horizon"] = f"SELECT last_ym, {shift('last_ym', 18)} AS horizon_ym, {shift('last_ym', -12)} AS cutoff_ym FROM bounds"
    q["nth_month"] = """
    SELECT max(ym) FILTER (n = 1) AS latest_1, max(ym) FILTER (n = 3) AS latest_3, max(ym) FILTER (n = 12) AS latest_12 FROM nth"""
    q["as_of"] = f"SELECT * FROM ship WHERE ym <= (SELECT {shift('last_ym', -12)} FROM bounds)"
    q["series_id"] = """
    SELECT u AS unique_id, split_part(u, '|', 1) AS item_code, split_part(u, '|', 2) AS channel
    FROM (SELECT DISTINCT item_code || '|' || channel AS u FROM ship)"""
    q["series_list"] = "SELECT DISTINCT item_code, channel FROM ship"
    q["series_slice"] = """
    SELECT ym, 'actual' AS kind, CAST(qty AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
    FROM ship WHERE item_code = 'Brand#1_ECONOMY' AND channel = 'DOM'
    UNION ALL SELECT target_ym, 'forecast', p50, lower_bound, upper_bound
    FROM baseline WHERE item_code = 'Brand#1_ECONOMY' AND channel = 'DOM'"""
    q["demand_stats"] = f"SELECT item_code, {STATS} FROM stats"
    q["demand_class"] = f"SELECT item_code, channel, {STATS}, demand_class FROM series_class"
    q["route_series"] = f"SELECT item_code, channel, {STATS}, demand_class, forecast_source FROM routes"
    q["history_gate"] = f"""
    SELECT *, months >= 24 AS enough_history FROM (
      SELECT item_code, channel, {months('max(ym)')} - {months('min(ym)')} + 1 AS months FROM sparse GROUP BY ALL)"""
    q["enough_history"] = f"""
    SELECT * FROM sparse WHERE (item_code, channel) IN (
      SELECT (item_code, channel) FROM sparse GROUP BY item_code, channel HAVING {months('max(ym)')} - {months('min(ym)')} + 1 >= 24)"""
    q["safety_stock"] = """
    SELECT item_code, site_code, ym, qty AS demand_qty,
           CAST(CASE WHEN ym >= launch_ym THEN floor(avg(CASE WHEN ym >= launch_ym THEN qty END) OVER (
             PARTITION BY item_code, site_code ORDER BY ym ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) * share * 1.5 + 0.5)
             ELSE 0 END AS BIGINT) AS safety_stock_qty
    FROM ship JOIN items USING (item_code)
    JOIN (VALUES ('DOM', 'TOKYO_DC', CAST(0.6 AS DOUBLE)), ('DOM', 'OSAKA_DC', CAST(0.4 AS DOUBLE)), ('EXP', 'OVERSEAS_HUB', CAST(1.0 AS DOUBLE)))
      v(channel, site_code, share) USING (channel)"""

    q["baseline_naive"] = f"SELECT {FORECAST} FROM baseline WHERE target_ym <= (SELECT last_ym FROM bounds)"
    q["baseline_future"] = f"SELECT {FORECAST} FROM baseline WHERE target_ym > (SELECT last_ym FROM bounds)"
    q["all_forecasts"] = """
    SELECT item_code, channel, target_ym, model_name, round(p50, 6) AS p50, round(lower_bound, 6) AS lower_bound,
           round(upper_bound, 6) AS upper_bound FROM forecasts"""
    q["accuracy_all"] = f"""
    SELECT item_code, channel, target_ym, model_name, {SCORED.replace('forecast_qty,', 'round(forecast_qty, 6) AS forecast_qty,')} FROM scored"""
    q["unscorable_forecasts"] = """
    SELECT model_name, min(target_ym) AS first_ym, max(target_ym) AS last_ym, count(*) AS n FROM baseline f
    WHERE NOT EXISTS (SELECT 1 FROM ship a WHERE a.item_code = f.item_code AND a.channel = f.channel AND a.ym = f.target_ym)
    GROUP BY model_name"""
    q["forecast_coverage"] = """
    SELECT CASE WHEN target_ym > (SELECT last_ym FROM bounds) THEN 'future' ELSE 'scorable' END AS bucket,
           min(target_ym) AS first_ym, max(target_ym) AS last_ym, count(*) AS n FROM baseline GROUP BY 1"""
    q["source_spans"] = " UNION ALL ".join(
        f"SELECT '{n}' AS relation, min(target_ym) AS first_ym, max(target_ym) AS last_ym, count(*) AS n FROM {n}"
        for n in ("baseline", "mean_12", "last_value"))
    q["accuracy_by_class"] = f"SELECT demand_class, {MEASURES} FROM accuracy JOIN items USING (item_code) GROUP BY 1"
    q["accuracy_by_model"] = f"SELECT model_name, {MEASURES} FROM scored GROUP BY 1"
    q["accuracy_by_model_common"] = f"""
    SELECT model_name, {MEASURES} FROM scored WHERE (item_code, channel, target_ym) IN (
      SELECT (item_code, channel, target_ym) FROM scored GROUP BY item_code, channel, target_ym
      HAVING count(DISTINCT model_name) = 3) GROUP BY 1"""
    q["accuracy_by_series"] = f"SELECT item_code, channel, {MEASURES} FROM accuracy GROUP BY 1, 2"
    q["distinct_counts"] = """
    SELECT count(DISTINCT model_name) AS models, count(DISTINCT (item_code, channel)) AS series,
           count(DISTINCT target_ym) AS months FROM scored"""
    q["vs_baseline"] = f"""
    WITH per AS (SELECT model_name, avg(abs_error) AS e, count(*) AS n FROM scored GROUP BY 1)
    SELECT model_name, {six('e', 'err_qty')}, n,
           {six(ratio('e', "(SELECT e FROM per WHERE model_name = 'baseline_seasonal_naive')"), 'vs_baseline')} FROM per"""
    q["smape"] = f"""
    SELECT model_name, {six('avg(CASE WHEN abs(actual_qty) + abs(forecast_qty) = 0 THEN 0 ELSE 2 * abs(actual_qty - forecast_qty) / (abs(actual_qty) + abs(forecast_qty)) END)', 'smape')}
    FROM scored GROUP BY 1"""
    sides = ("avg(abs_error) FILTER (src = 'model') AS m, avg(abs_error) FILTER (src = 'baseline') AS b")
    q["class_judge"] = f"""
    SELECT demand_class, {six('m', 'model_err')}, {six('b', 'baseline_err')}, {six(ratio('m', 'b'), 'vs_baseline')},
           CASE WHEN m < b THEN 'model' ELSE 'baseline' END AS judge
    FROM (SELECT demand_class, {sides} FROM versus JOIN items USING (item_code) GROUP BY 1)"""
    q["error_by_month"] = f"""
    SELECT target_ym, {six('m', 'model_err')}, {six('b', 'baseline_err')} FROM (SELECT target_ym, {sides} FROM versus GROUP BY 1)"""
    q["pred_vs_actual"] = """
    SELECT item_code, channel, target_ym, actual_qty, round(forecast_qty, 6) AS forecast_qty FROM scored
    WHERE model_name = 'mean_12' AND actual_qty > 0"""
    q["forecast_summary"] = f"""
    SELECT item_code, channel, {six('avg(p50)', 'avg_forecast_qty')}, min(lower_bound) AS min_lower,
           max(upper_bound) AS max_upper, count(*) AS months
    FROM baseline GROUP BY 1, 2 ORDER BY avg(p50) DESC, item_code, channel LIMIT 15"""
    q["interval_width"] = f"""
    SELECT demand_class, {six('avg(p50)', 'avg_forecast')}, {six('avg(upper_bound - lower_bound)', 'interval_width')},
           {six('avg((upper_bound - lower_bound) / NULLIF(p50, 0))', 'width_per_forecast')}
    FROM baseline JOIN items USING (item_code) GROUP BY 1"""
    q["freshness"] = """
    SELECT 'fct_shipments' AS relation, min(ym) AS first_ym, max(ym) AS last_ym FROM ship
    UNION ALL SELECT 'fct_forecast_accuracy_all', min(target_ym), max(target_ym) FROM scored"""
    q["ape_by_month"] = f"SELECT target_ym, {six('avg(ape)', 'avg_ape')} FROM accuracy GROUP BY 1"
    q["top_error_items"] = f"""
    SELECT item_code, {six('avg(abs_error)', 'avg_abs_error')} FROM accuracy GROUP BY 1
    ORDER BY avg(abs_error) DESC, item_code LIMIT 10"""
    q["ds_accuracy"] = """
    SELECT target_ym, model_name, item_code, item_category, demand_class, actual_qty, forecast_qty, abs_error,
           round(ape, 6) AS ape, within_interval FROM accuracy JOIN items USING (item_code)"""
    q["w_err_by_class"] = f"""
    SELECT demand_class, {six('avg(ape)', 'avg_ape')}, {six('avg(abs_error)', 'avg_abs_error')}
    FROM accuracy JOIN items USING (item_code) GROUP BY 1"""
    q["next_month_top"] = f"""
    SELECT item_code, target_ym, sum(p50) AS forecast_qty FROM baseline
    WHERE target_ym = (SELECT {shift('last_ym', 1)} FROM bounds) GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1"""

    q["ds_demand"] = """
    SELECT ym, channel, item_code, item_name, item_category, item_type, demand_class, is_domestic_only, qty, amount
    FROM fct JOIN items USING (item_code)"""
    q["monthly_totals"] = f"SELECT ym, {big('sum(qty)', 'qty')}, {big('sum(amount)', 'amount')} FROM fct GROUP BY 1"
    q["last12_trend"] = f"""
    SELECT ym, {big('sum(qty)', 'qty')} FROM ship WHERE ym > (SELECT {shift('last_ym', -12)} FROM bounds) GROUP BY 1"""
    q["class_profile"] = f"""
    SELECT demand_class, count(*) AS n_items, {six('min(adi)', 'min_adi')}, {six('max(adi)', 'max_adi')},
           {six('min(cv2)', 'min_cv2')}, {six('max(cv2)', 'max_cv2')} FROM items GROUP BY 1"""
    q["channel_share"] = f"""
    SELECT channel, {big('sum(qty)', 'qty')},
           {six('CAST(sum(qty) AS DOUBLE) / CAST((SELECT sum(qty) FROM ship) AS DOUBLE)', 'share')}
    FROM ship GROUP BY 1"""
    q["domestic_items"] = f"""
    SELECT item_code, item_name, {six('sum(qty) / count(DISTINCT ym)', 'avg_monthly_qty')}
    FROM ship JOIN items USING (item_code) WHERE is_domestic_only GROUP BY 1, 2"""
    q["top_items"] = f"SELECT item_code, {big('sum(qty)', 'qty')} FROM ship GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    q["most_intermittent"] = f"""
    SELECT item_code, demand_class, {six('adi', 'adi')} FROM items
    WHERE demand_class IN ('intermittent', 'lumpy', 'lumpy_severe') ORDER BY items.adi DESC, item_code LIMIT 1"""
    first_day = "CAST(date_trunc('month', {}) AS DATE) AS month"
    q["w_kpi_qty"] = f"SELECT {first_day.format('ym')}, {big('sum(qty)', 'qty')} FROM ship GROUP BY 1"
    q["w_kpi_amount"] = f"SELECT {first_day.format('ym')}, {big('sum(amount)', 'amount')} FROM fct GROUP BY 1"
    q["w_kpi_error"] = f"SELECT {first_day.format('target_ym')}, {six('avg(abs_error)', 'avg_abs_error')} FROM accuracy GROUP BY 1"
    q["w_trend_by_channel"] = f"SELECT {first_day.format('ym')}, channel, {big('sum(qty)', 'qty')} FROM ship GROUP BY 1, 2"
    q["w_qty_by_category"] = f"SELECT item_category, {big('sum(qty)', 'qty')} FROM ship JOIN items USING (item_code) GROUP BY 1"
    stocked = "FROM stock JOIN items USING (item_code) WHERE safety_stock_qty > 0"
    q["ds_inventory"] = f"""
    SELECT ym, site_code, item_code, item_name, item_category, closing_qty, safety_stock_qty, surplus_qty, stockout_flag {stocked}"""
    q["w_stock_by_site"] = f"""
    SELECT site_code, {six('avg(closing_qty)', 'avg_closing')}, {six('avg(safety_stock_qty)', 'avg_safety')} {stocked} GROUP BY 1"""
    q["w_stockouts"] = f"SELECT item_code, site_code, {big('sum(stockout_flag)', 'stockout_months')} {stocked} GROUP BY 1, 2"
    newest = "ym = (SELECT last_ym FROM bounds)"
    q["inventory_health"] = f"""
    SELECT item_code, site_code, ym, item_name, item_category, closing_qty, safety_stock_qty, surplus_qty, stockout_flag,
           standard_lead_time_days
    FROM stock LEFT JOIN lead_time USING (item_code, site_code) JOIN items USING (item_code) WHERE {newest}"""
    q["latest_stockouts"] = f"""
    SELECT item_code, item_name, site_code, safety_stock_qty FROM stock JOIN items USING (item_code)
    WHERE {newest} AND stockout_flag = 1"""
    q["surplus_sites"] = f"""
    SELECT site_code, {big('sum(surplus_qty)', 'surplus_qty')} FROM stock WHERE {newest} GROUP BY 1 HAVING sum(surplus_qty) > 0"""
    q["top_lead_times"] = "SELECT * FROM lead_time ORDER BY standard_lead_time_days DESC, item_code, site_code LIMIT 10"

    totals = f"{big('sum(qty)', 'qty')}, {big('sum(amount)', 'amount')}"
    monthly = six("sum(qty) / count(DISTINCT ym)", "avg_monthly_qty")
    q["mv_demand_by_category"] = f"""
    SELECT item_category AS category, {totals}, count(DISTINCT ym) AS months, {monthly}
    FROM fct LEFT JOIN items USING (item_code) GROUP BY 1"""
    q["mv_demand_by_channel"] = f"""
    SELECT channel_name AS channel, {totals} FROM fct f LEFT JOIN channels c ON c.channel_code = f.channel GROUP BY 1"""
    q["mv_demand_by_month"] = f"SELECT ym AS month, {totals} FROM fct GROUP BY 1"
    q["mv_demand_domestic"] = f"""
    SELECT item_category AS category, {big('sum(qty)', 'qty')}, {monthly}
    FROM fct LEFT JOIN items USING (item_code) WHERE NOT is_domestic_only GROUP BY 1"""
    q["mv_accuracy_by_class"] = f"SELECT demand_class, {METRIC} FROM accuracy LEFT JOIN items USING (item_code) GROUP BY 1"
    q["mv_accuracy_by_category"] = f"""
    SELECT item_category AS category, model_name AS method, {METRIC} FROM accuracy LEFT JOIN items USING (item_code) GROUP BY 1, 2"""

    rolled = ("round(roll_mean_3, 6) AS roll_mean_3, round(roll_mean_6, 6) AS roll_mean_6, round(roll_mean_12, 6) AS roll_mean_12, "
              "round(roll_std_6, 6) AS roll_std_6, round(nonzero_ratio_12, 6) AS nonzero_ratio_12")
    q["features_lag"] = "SELECT item_code, channel, ym, lag_1, lag_2, lag_3, lag_12 FROM features"
    q["features_roll"] = f"SELECT item_code, channel, ym, {rolled} FROM features"
    q["features_cal"] = "SELECT item_code, channel, ym, month, month_index FROM features"
    q["training_frame"] = f"""
    SELECT item_code, channel, ym, qty, month, month_index, lag_1, lag_2, lag_3, lag_12, {rolled} FROM training"""
    q["split_counts"] = """
    SELECT split, count(*) AS n, count(DISTINCT (item_code, channel)) AS series, min(ym) AS first_ym, max(ym) AS last_ym,
           count(*) FILTER (is_recent) AS n_recent FROM split_6 GROUP BY 1"""
    q["baseline_mae"] = f"SELECT {six('avg(abs(qty - lag_12))', 'baseline_mae')} FROM split_6 WHERE split = 'valid'"
    errors = ", ".join(six(c, c) for c in ("mae", "mase", "mae_recent", "mase_recent", "baseline_mae", "baseline_mae_recent"))
    q["mase"] = f"SELECT name, {errors} FROM {compared()}"
    q["promotion_rule"] = f"""
    SELECT item_code, round(o, 6) AS champion_mae_recent, round(n, 6) AS challenger_mae_recent,
           round(s, 6) AS challenger_mase_recent, COALESCE(n < o AND s < 1.0, FALSE) AS promote
    FROM (SELECT item_code, max(mae_recent) FILTER (name = 'champion') AS o, max(mae_recent) FILTER (name = 'challenger') AS n,
                 max(mase_recent) FILTER (name = 'challenger') AS s FROM {compared('item_code')} GROUP BY 1)"""

    q["mm_train"] = "SELECT item_code || '|' || channel AS unique_id, ym AS ds, CAST(qty AS DOUBLE) AS y FROM ship"
    q["mm_evaluate_rules"] = f"""
    SELECT unique_id, model, window_no, last_day(CAST(date_trunc('month', last_ym) - to_months(CAST(24 - 6 * window_no AS INTEGER)) AS DATE)) AS cutoff_ym,
           round(metric_value, 6) AS metric_value FROM rule_scores CROSS JOIN bounds"""
    q["best_models"] = "SELECT unique_id, model, round(avg_metric, 6) AS avg_metric, forecast_source FROM best"
    q["best_model_counts"] = f"""
    SELECT model, forecast_source, count(*) AS wins, {six('avg(avg_metric)', 'avg_metric')} FROM best GROUP BY 1, 2"""
    q["evaluation_summary"] = f"""
    SELECT demand_class, model, count(*) AS series_count, {six('avg(avg_metric)', 'avg_metric')}
    FROM best JOIN items ON items.item_code = split_part(unique_id, '|', 1) GROUP BY 1, 2"""
    q["routed_models"] = "SELECT unique_id, model, round(avg_metric, 6) AS avg_metric, forecast_source FROM routed"
    q["routed_forecasts"] = """
    SELECT r.unique_id, r.model, r.forecast_source, a.target_ym,
           round(CASE r.model WHEN 'naive_12' THEN CAST(l.qty AS DOUBLE) WHEN 'mean_12' THEN y.mean_12 WHEN 'zero' THEN 0.0
                 ELSE CAST(y.last_value AS DOUBLE) END, 6) AS p50,
           CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
    FROM routed r CROSS JOIN ahead a JOIN year_mean y ON y.item_code || '|' || y.channel = r.unique_id
    JOIN last_year l ON l.item_code = y.item_code AND l.channel = y.channel AND l.m = (a.k - 1) % 12 + 1"""
    q["group_forecast_rule"] = grouped("CAST(l.qty AS DOUBLE)")
    spread = "1.96 * d.sd * sqrt((a.k - 1) // 12 + 1)"
    q["group_forecast_seasonal"] = grouped(
        "CAST(l.qty AS DOUBLE)", f"greatest(l.qty - {spread}, 0)", f"greatest(l.qty + {spread}, 0)",
        """JOIN (SELECT item_code, channel, stddev_samp(qty - lag_12) AS sd FROM features WHERE lag_12 IS NOT NULL GROUP BY ALL) d
           ON d.item_code = s.item_code AND d.channel = s.channel""")
    q["group_forecast_croston"] = """
    WITH RECURSIVE croston AS (
      SELECT DISTINCT item_code, channel, CAST(0 AS BIGINT) AS t, CAST(NULL AS DOUBLE) AS size, CAST(NULL AS DOUBLE) AS gap,
             CAST(1 AS DOUBLE) AS since FROM ship
      UNION ALL
      SELECT p.item_code, p.channel, p.t, CASE WHEN p.qty > 0 THEN COALESCE(size + CAST(0.1 AS DOUBLE) * (p.qty - size), p.qty) ELSE size END,
             CASE WHEN p.qty > 0 THEN COALESCE(gap + CAST(0.1 AS DOUBLE) * (since - gap), p.t) ELSE gap END,
             CASE WHEN p.qty > 0 THEN 1 ELSE since + 1 END
      FROM croston c JOIN placed p ON p.item_code = c.item_code AND p.channel = c.channel AND p.t = c.t + 1)
    SELECT item_code, channel, target_ym, round(COALESCE(CAST(0.95 AS DOUBLE) * size / gap, 0), 6) AS p50
    FROM croston CROSS JOIN ahead WHERE t = (SELECT count(*) FROM cal)"""
    q["group_backtest_rule"] = f"""
    SELECT s.item_code, s.channel, l.ym AS target_ym, (SELECT {shift('last_ym', -12)} FROM bounds) AS forecast_run_ym,
           'ai_forecast' AS model_name, round(m.mean_12, 6) AS p50, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
    FROM last_year l JOIN year_mean s ON s.item_code = l.item_code AND s.channel = l.channel
    JOIN (SELECT item_code, channel, avg(qty) AS mean_12 FROM ship
          WHERE ym <= (SELECT {shift('last_ym', -12)} FROM bounds) AND ym > (SELECT {shift('last_ym', -24)} FROM bounds)
          GROUP BY ALL) m ON m.item_code = s.item_code AND m.channel = s.channel"""

    q["mm_airline"] = """
    WITH RECURSIVE lists AS (
      SELECT item_code || '|' || channel AS unique_id, list(CAST(qty AS DOUBLE) ORDER BY ym) AS ys, count(*) AS n FROM ship GROUP BY item_code, channel),
    walk AS (
      SELECT unique_id, ys, n, CAST(13 AS BIGINT) AS t, list_transform(range(13), lambda x: CAST(0 AS DOUBLE)) AS es FROM lists
      UNION ALL
      SELECT unique_id, CASE WHEN t < n THEN ys ELSE list_append(ys, f) END, n, t + 1,
             list_append(es, CASE WHEN t < n THEN ys[t + 1] - f ELSE CAST(0 AS DOUBLE) END)
      FROM (SELECT *, ys[t] + ys[t - 11] - ys[t - 12] - 0.4 * es[t] - 0.6 * es[t - 11] + 0.24 * es[t - 12] AS f FROM walk) WHERE t < n + 18)
    SELECT unique_id, 'airline' AS model, target_ym, round(greatest(ys[n + k], 0), 6) AS p50 FROM walk CROSS JOIN ahead WHERE t = n + 18"""
    q["conformal_rule"] = """
    WITH starts AS (
      SELECT p.item_code, p.channel, n - o AS cut, o FROM (SELECT item_code, channel, count(*) AS n FROM placed GROUP BY ALL) p,
             (SELECT unnest(generate_series(1, 36)) AS o) WHERE o < n),
    guesses AS (
      SELECT item_code, channel, cut, o, avg(qty) AS f FROM starts JOIN placed USING (item_code, channel)
      WHERE t BETWEEN cut - 11 AND cut GROUP BY item_code, channel, cut, o),
    misses AS (
      SELECT item_code, channel, t - cut AS k, abs(qty - f) AS miss FROM guesses JOIN placed USING (item_code, channel) WHERE t BETWEEN cut + 1 AND cut + 18),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY item_code, channel, k ORDER BY miss) AS place, count(*) OVER (PARTITION BY item_code, channel, k) AS m FROM misses),
    widths AS (
      SELECT item_code, channel, k, miss AS width FROM ranked WHERE place = least(m, CAST(ceil((m + 1) * CAST(0.95 AS DOUBLE)) AS BIGINT)))
    SELECT item_code || '|' || channel AS unique_id, 'mean_12' AS model, target_ym, round(mean_12, 6) AS p50,
           round(greatest(mean_12 - width, 0), 6) AS lower_bound, round(mean_12 + width, 6) AS upper_bound
    FROM year_mean JOIN widths USING (item_code, channel) JOIN ahead USING (k)"""
    q["route_series_a"] = f"SELECT item_code, channel, {STATS}, demand_class, 'main_pipeline' AS forecast_source FROM series_class"
    q["route_series_c"] = f"""
    SELECT item_code, channel, {STATS}, demand_class,
           CASE WHEN demand_class IN ('smooth', 'erratic') THEN 'main_pipeline' ELSE 'separate_pipeline' END AS forecast_source FROM series_class"""
    q["sparse_forecasts"] = sparse("4", """
    SELECT unique_id, model, target_ym, round(level, 6) AS p50, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound
    FROM sparse_levels CROSS JOIN ahead""")
    q["sparse_evaluate"] = sparse("0, 1", """
    SELECT unique_id, model, window_no, last_day(CAST(date_trunc('month', last_ym) - to_months(CAST(24 - 6 * window_no AS INTEGER)) AS DATE)) AS cutoff_ym,
           round(metric_value, 6) AS metric_value FROM sparse_scores CROSS JOIN bounds""")
    q["sparse_winners"] = sparse("0, 1", """
    SELECT unique_id, model, round(avg_metric, 6) AS avg_metric, 'separate_pipeline' AS forecast_source
    FROM (SELECT unique_id, model, round(avg(metric_value), 9) AS avg_metric FROM sparse_scores GROUP BY unique_id, model)
    QUALIFY row_number() OVER (PARTITION BY unique_id ORDER BY avg_metric, model) = 1""")

    q["part_demand_class"] = f"""
    SELECT item_code, {STATS}, {CLASS} AS demand_class FROM ({demand('item_code', 'part_sparse')})"""
    q["part_accuracy"] = f"""
    SELECT f.item_code, {MEASURES} FROM (
      SELECT f.item_code, {SCORE} FROM part_baseline f
      JOIN part_ship a ON a.item_code = f.item_code AND a.channel = f.channel AND a.ym = f.target_ym) f GROUP BY 1"""
    q["part_features"] = f"""
    SELECT item_code, channel, ym, lag_12, round(roll_mean_12, 6) AS roll_mean_12, round(roll_std_6, 6) AS roll_std_6,
           round(nonzero_ratio_12, 6) AS nonzero_ratio_12 FROM ({FEATURES.format(source='part_ship')})"""
    return q


def statements() -> dict[str, str]:
    """Each statement with the relations it builds on, ready to run by itself."""
    return {name: f"WITH {RELATIONS} SELECT * FROM ({sql})" for name, sql in _statements().items()}
