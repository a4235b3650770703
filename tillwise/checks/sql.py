"""The registered queries again, in SQL for another engine.

Each statement is put together from named parts; a part may use other parts and
the bundled tables. The parts say what is computed in the most direct way
(self-joins, full calendars, enumeration) rather than how the operators do it.
"""

from __future__ import annotations

import re

from tillwise import config
from tillwise.checks import queries as q
from tillwise.plans import quality
from tillwise.sources.marketdata import DUCKDB, view_sql

ITEM = "store, calculation_group, product"
DAILY = "store, department, space, category, product, date, price"


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _cut(expression: str, unit: str = "1e6") -> str:
    return f"floor(({expression}) * {unit} + {q.CUT}) / {unit}"


def _r6(expression: str, name: str | None = None) -> str:
    return f"{_cut(expression)} AS {name or expression.split('.')[-1]}"


def _r4(expression: str, name: str | None = None) -> str:
    return f"{_cut(expression, '1e4')} AS {name or expression.split('.')[-1]}"


def _strip(title: str) -> str:
    return f"substring({title}, strpos({title}, '-') + 2)"


def _daily(condition: str = "true") -> str:
    return f"""
        SELECT shop_title AS store, {_strip("department_title")} AS department,
               {_strip("space_title")} AS space, {_strip("category_title")} AS category,
               product_title AS product,
               cast((transacted_at AT TIME ZONE 'UTC') AT TIME ZONE '{config.LOCAL_ZONE}' AS date) AS date,
               cast(round(price_sell, 2) AS double) AS price,
               coalesce(sum(quantity), 0) AS qty
        FROM transaction_items WHERE {condition} GROUP BY ALL"""


def _between(start: str, end: str) -> str:
    def utc(day: str, time: str) -> str:
        return f"(timestamptz '{day} {time}{config.RANGE_OFFSET}' AT TIME ZONE 'UTC')"

    return f"transacted_at BETWEEN {utc(start, '00:00:00')} AND {utc(end, '23:59:59')}"


def _group() -> str:
    rules = config.GroupRules()
    labels = " ".join(f"WHEN category IN ({_quoted(m)}) THEN '{label}'" for label, m in rules.by_label.items())
    return f"""CASE WHEN category IN ({_quoted(rules.by_space)}) THEN space
        WHEN category IN ({_quoted(rules.by_category)}) THEN category {labels} ELSE '{rules.default}' END"""


def _t_tail(t: str, nu: str) -> str:
    """Two-sided Student-t tail; the series terms in log form."""
    cos2 = f"({nu} / ({nu} + {t} * {t}))"
    sin = f"(abs({t}) / sqrt({nu} + {t} * {t}))"
    even = f"""{sin} * list_sum(list_transform(range(0, cast({nu} // 2 AS bigint)),
        lambda j: exp(lgamma(2*j+1) - 2*lgamma(j+1) - j*ln(4) + j*ln({cos2}))))"""
    odd = f"""(atan(abs({t}) / sqrt({nu})) + CASE WHEN {nu} = 1 THEN 0 ELSE
        {sin} * sqrt({cos2}) * list_sum(list_transform(range(0, cast(({nu} - 1) // 2 AS bigint)),
        lambda j: exp(j*ln(4) + 2*lgamma(j+1) - lgamma(2*j+2) + j*ln({cos2})))) END) * 2 / pi()"""
    return f"""CASE WHEN {nu} < 1 THEN NULL ELSE greatest(0, 1 - CASE WHEN {nu} % 2 = 0 THEN {even} ELSE {odd} END) END"""


def _band(r2: str) -> str:
    return f"""CASE WHEN {r2} IS NULL OR {r2} < 0 OR {r2} > 1 THEN 'No_R-Square'
        WHEN {r2} <= {config.R2_LOW} THEN 'Low' WHEN {r2} <= {config.R2_MEDIUM} THEN 'Medium' ELSE 'High' END"""


def _corr(x: str, y: str) -> str:
    return f"""CASE WHEN count(*) < 2 OR var_pop({x}) <= 1e-12 * avg({x}) * avg({x})
          OR var_pop({y}) <= 1e-12 * avg({y}) * avg({y}) THEN NULL
        ELSE round(covar_pop({x}, {y}) / sqrt(var_pop({x}) * var_pop({y})), 12) END"""


_SWEPT = """list_reduce(list_transform(active, lambda a: [cast(a AS double)]),
    lambda m, p: list_transform(range(0, n * n), lambda t:
      CASE WHEN t // n = p[1] - 1 AND t % n = p[1] - 1 THEN -1 / m[t + 1]
           WHEN t // n = p[1] - 1 OR t % n = p[1] - 1
             THEN m[t + 1] / m[cast((p[1] - 1) * n + p[1] AS bigint)]
           ELSE m[t + 1] - m[cast(t // n * n + p[1] AS bigint)] * m[cast((p[1] - 1) * n + t % n + 1 AS bigint)]
                / m[cast((p[1] - 1) * n + p[1] AS bigint)] END),
    g)"""
_DIAG = "cast((a - 1) * n + a AS bigint)"
_STAT = f"(s[cast((a - 1) * n + n AS bigint)] / sqrt(-s[{_DIAG}] * s[n * n] / (rows - len(active) - 1)))"


def _fit(name: str, first: str, start: str) -> str:
    """Elimination as a recursion over the moments of each product: the moment
    matrix is swept on the active columns, which gives inverse, coefficients and
    residual at once; offenders leave, until a round finds none."""
    return f"""
        SELECT {ITEM}, rivals, n, rows, g, means, {first} AS active, '{start}' AS phase
        FROM moments WHERE g[1] > 0
        UNION ALL
        SELECT {ITEM}, rivals, n, rows, g, means,
               list_filter(active, lambda a: NOT list_contains(bad, a)) AS active,
               CASE WHEN len(bad) > 0 THEN phase WHEN phase = 'vif' THEN 'p' ELSE 'done' END AS phase
        FROM (SELECT *, CASE WHEN phase = 'vif'
                  THEN list_filter(active, lambda a: a > 1 AND len(active) > 1 AND -s[{_DIAG}] * g[{_DIAG}] > {config.MAX_VIF})
                  ELSE list_filter(active, lambda a: a > 1 AND ({_t_tail(_STAT, "(rows - len(active) - 1)")}) > {config.ALPHA}) END AS bad
              FROM (SELECT *, {_SWEPT} AS s FROM {name} WHERE phase <> 'done'))"""


def _model(fit: str) -> str:
    solved = f"(SELECT *, {_SWEPT} AS s FROM {fit} WHERE phase = 'done')"
    beta = "s[cast((a - 1) * n + n AS bigint)]"
    nu = "(rows - len(active) - 1)"
    leverage = "list_sum(list_transform(active, lambda a: list_sum(list_transform(active, lambda b: -s[cast((a - 1) * n + b AS bigint)] * means[a] * means[b]))))"
    return f"""
        SELECT {ITEM}, variable, coefficient, intercept, {_t_tail("t", "nu")} AS p_value, r_squared, vif
        FROM (
          SELECT {ITEM}, CASE WHEN a = 1 THEN 'Price' ELSE rivals[a - 1] END AS variable,
                 {beta} AS coefficient, c0 AS intercept, {_STAT} AS t, {nu} AS nu,
                 1 - s[n * n] / g[n * n] AS r_squared, -s[{_DIAG}] * g[{_DIAG}] AS vif
          FROM (SELECT *, unnest(active) AS a,
                       means[n] - list_sum(list_transform(active, lambda a: {beta} * means[a])) AS c0 FROM {solved})
          UNION ALL
          SELECT {ITEM}, 'const', c0, c0, c0 / sqrt(s[n * n] / {nu} * (1.0 / rows + lev)), {nu},
                 1 - s[n * n] / g[n * n], NULL
          FROM (SELECT *, means[n] - list_sum(list_transform(active, lambda a: {beta} * means[a])) AS c0,
                       {leverage} AS lev FROM {solved}))"""


def _joint(scope: str, pull: str) -> str:
    return f"""
        SELECT {ITEM}, o.grid_idx, o.simulation_prices, cost_lowest, simulation_profit, base,
               predicted, predicted * simulation_profit AS profit_predicted,
               predicted * simulation_profit + earned AS profit_predicted_all, competitor_prices
        FROM (
          SELECT *, CASE WHEN base + pulled < 0 THEN 0 ELSE base + pulled END AS predicted
          FROM (
            SELECT o.*, coalesce(CASE WHEN sells >= alone THEN a.pulled ELSE b.pulled END, 0) AS pulled,
                   coalesce(CASE WHEN sells >= alone THEN a.earned ELSE b.earned END, 0) AS earned,
                   coalesce(CASE WHEN sells >= alone THEN a.prices ELSE b.prices END, '') AS competitor_prices,
                   rank() OVER (PARTITION BY {ITEM} ORDER BY round(greatest(sells, alone), 9) DESC) AS place
            FROM (SELECT o.*, o.simulation_profit * base + coalesce(a.value, 0) AS sells, coalesce(b.value, 0) AS alone
                  FROM own_rows{scope} o LEFT JOIN reply_selling{scope}{pull} a USING ({ITEM}, grid_idx)
                  LEFT JOIN reply_alone{scope}{pull} b USING ({ITEM}, grid_idx)) o
            LEFT JOIN reply_selling{scope}{pull} a USING ({ITEM}, grid_idx)
            LEFT JOIN reply_alone{scope}{pull} b USING ({ITEM}, grid_idx))
          WHERE place = 1) o"""


def _reply(scope: str, value: str, pull: str) -> str:
    return f"""
        SELECT {ITEM}, grid_idx, sum(value) AS value, sum(profit) AS earned, sum(pulled) AS pulled,
               string_agg(concat(variable, '=', cast(round(price * 10) AS bigint)), '|' ORDER BY variable) AS prices
        FROM (
          SELECT o.store, o.calculation_group, o.product, o.grid_idx, r.variable, c.simulation_prices AS price,
                 c.profit_predicted AS profit, r.coefficient * {pull} AS pulled, {value} AS value,
                 row_number() OVER (PARTITION BY o.store, o.calculation_group, o.product, o.grid_idx, r.variable
                                    ORDER BY {value} DESC, c.grid_idx) AS place
          FROM own_rows{scope} o JOIN rivals{scope} r USING ({ITEM})
          JOIN outcome c ON c.store = o.store AND c.calculation_group = o.calculation_group AND c.product = r.variable)
        WHERE place = 1 GROUP BY ALL"""


def _joint_parts(scope: str, better: str, priced: str) -> dict[str, str]:
    parts = {
        f"own_rows{scope}": f"""
        SELECT p.*, coefficient, intercept, coefficient * simulation_prices AS qty_adjustment,
               intercept + coefficient * simulation_prices AS base
        FROM {priced} p JOIN {better} b USING ({ITEM}) WHERE b.variable = 'Price'""",
        f"rivals{scope}": f"SELECT {ITEM}, variable, coefficient FROM {better} WHERE variable NOT IN ('const', 'Price')",
        f"members{scope}_of": f"""
        SELECT m.store, m.calculation_group, m.product, m.member, b.simulation_prices, b.qty_predicted, b.profit_predicted
        FROM (SELECT DISTINCT {ITEM}, product AS member FROM {better} UNION SELECT {ITEM}, variable FROM rivals{scope}) m
        JOIN best b ON b.store = m.store AND b.calculation_group = m.calculation_group AND b.product = m.member""",
        f"baseline{scope}": f"""
        SELECT {ITEM}, sum(profit_predicted) AS profit_predicted_all_reg, count(*) AS members FROM members{scope}_of GROUP BY ALL""",
    }
    for name, pull in (("", _LITERAL_PULL), ("_consistent", _CONSISTENT_PULL)):
        value = f"o.simulation_profit * r.coefficient * {pull} + c.profit_predicted"
        parts[f"reply_selling{scope}{name}"] = _reply(scope, value, pull)
        parts[f"reply_alone{scope}{name}"] = _reply(scope, "c.profit_predicted", pull)
        parts[f"joint{scope}{name}"] = _joint(scope, name)
    return parts


_LITERAL_PULL, _CONSISTENT_PULL = "c.simulation_prices", "(o.simulation_prices - c.simulation_prices)"


def _scoped(part: str) -> str:
    return f"""SELECT * FROM {part} WHERE store IN ({_quoted(config.SAMPLE_STORES)})
        AND calculation_group IN ({_quoted(config.TEST_GROUPS)})"""


def _thresholds(limits: dict[str, tuple[float, float]], which: int) -> str:
    whens = " ".join(f"WHEN '{store}' THEN {pair[which]}" for store, pair in limits.items())
    return f"CASE store {whens} ELSE {config.DEFAULT_PAIR_THRESHOLD} END"


def _below(limits: dict[str, tuple[float, float]]) -> str:
    return f"""SELECT store, product_1, product_2 FROM ranked
        WHERE correlation_coefficient_p < {_thresholds(limits, 0)}
          AND correlation_coefficient_q_rank < {_thresholds(limits, 1)}"""


def _window_bounds() -> tuple[str, str]:
    start, end = q.DEAL_WINDOW
    return (
        f"(timestamptz '{start} 00:00:00{config.RANGE_OFFSET}' AT TIME ZONE 'UTC')",
        f"(timestamptz '{end} 23:59:59{config.RANGE_OFFSET}' AT TIME ZONE 'UTC')",
    )


def _latest_costs(condition: str) -> str:
    return f"""
        SELECT DISTINCT store, product, cost_txn FROM (
          SELECT shop_title AS store, product_title AS product, category, min(cost) AS cost_txn
          FROM (SELECT *, {_strip("category_title")} AS category, cast(price_sell - price_margin AS double) AS cost,
                       rank() OVER (PARTITION BY shop_title, product_id, product_title, category_title
                                    ORDER BY transacted_at DESC) AS place
                FROM transaction_items WHERE {condition})
          WHERE place = 1 GROUP BY ALL)"""


_LO, _HI = _window_bounds()
_LAST_KEYS = "shop_title, product_id, product_title, category"

PARTS: dict[str, str] = {
    **view_sql(DUCKDB),
    "daily": _daily(),
    "grouped": f"SELECT *, {_group()} AS calculation_group FROM daily",
    "sales": f"""SELECT * FROM grouped WHERE space IN ({_quoted(config.SPACES)}) AND store IS NOT NULL
        AND calculation_group NOT IN ({_quoted(config.EXCLUDED_GROUPS)})""",
    "weekly_all": """
        SELECT store, department, space, category, product, calculation_group, week_start,
               cast((week_start - date '1969-12-31') // 7 AS int) AS week_index,
               cast((dayofyear(week_start) - 1) // 7 AS int) AS week_number,
               sum(cast(round(price * 100) AS bigint)) / (100.0 * count(price)) AS avg_price, sum(qty) AS qty
        FROM (SELECT *, date - cast((isodow(date) + 4) % 7 AS int) AS week_start FROM sales) GROUP BY ALL""",
    "weekly": """SELECT * FROM weekly_all SEMI JOIN
        (SELECT store, product FROM weekly_all GROUP BY ALL HAVING count(DISTINCT avg_price) > 1) USING (store, product)""",
    "activity": """
        SELECT DISTINCT 1 AS threshold_id, store, calculation_group, 45.0 AS threshold, 10 AS needed FROM sales
        UNION ALL
        SELECT DISTINCT 2, store, calculation_group, 60.0, 3 FROM sales WHERE store = 'Metro Store'""",
    "moving": """SELECT * FROM sales SEMI JOIN
        (SELECT store, product FROM sales GROUP BY ALL HAVING count(DISTINCT price) > 1) USING (store, product)""",
    "capped": f"""
        SELECT {DAILY}, calculation_group, qty FROM moving WHERE qty <= {q.OUTLIER_QTY}
        UNION ALL
        SELECT {DAILY}, calculation_group, top FROM
          (SELECT DISTINCT {DAILY}, calculation_group FROM moving WHERE qty > {q.OUTLIER_QTY})
          LEFT JOIN (SELECT {ITEM}, max(qty) AS top FROM moving WHERE qty <= {q.OUTLIER_QTY} GROUP BY ALL) USING ({ITEM})""",
    "selling_days": f"SELECT {ITEM}, date, min(price) AS low, max(price) AS high FROM sales GROUP BY ALL",
    "calendar": "SELECT cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS date) AS date FROM sales",
    "filled": f"""
        SELECT {ITEM}, date, price, qty, 1 AS original_ind FROM sales
        UNION ALL
        SELECT {ITEM}, date, coalesce(carried, first_price), 0.0, 0
        FROM (SELECT {ITEM}, date, high,
                     last_value(high IGNORE NULLS) OVER (PARTITION BY {ITEM} ORDER BY date) AS carried,
                     arg_min(low, date) OVER (PARTITION BY {ITEM}) AS first_price
              FROM (SELECT * FROM (SELECT DISTINCT {ITEM} FROM sales) CROSS JOIN calendar)
              LEFT JOIN selling_days USING ({ITEM}, date))
        WHERE high IS NULL""",
    "points": f"""
        SELECT *, total_qty / unique_days AS avg_qty, count(*) OVER (PARTITION BY store, product) AS unique_prices
        FROM (SELECT {ITEM}, price, count(DISTINCT date) AS unique_days, sum(qty) AS total_qty FROM filled GROUP BY ALL)""",
    "curve": """SELECT *, sum(avg_qty) OVER (PARTITION BY store, product ORDER BY price DESC
        ROWS UNBOUNDED PRECEDING) AS inverted_qty FROM points""",
    "simple_raw": f"""
        SELECT {ITEM}, count(*) AS n, regr_sxx(inverted_qty, price) AS sxx, regr_syy(inverted_qty, price) AS syy,
               regr_sxy(inverted_qty, price) AS sxy, avg(price) AS mx, avg(inverted_qty) AS my
        FROM curve GROUP BY ALL""",
    "simple": f"""
        SELECT {ITEM}, CASE WHEN n >= 2 THEN 'Price' END AS variable, coefficient, intercept, p_value, r_squared,
               CASE WHEN n < 2 THEN 'Less than 2 data points' WHEN p_value < {config.ALPHA} THEN 'Linear'
                    ELSE 'Not Linear' END AS linearity,
               {_band("r_squared")} AS r_squared_group
        FROM (SELECT {ITEM}, n, CASE WHEN n >= 2 THEN sxy / sxx END AS coefficient,
                     CASE WHEN n >= 2 THEN my - sxy / sxx * mx END AS intercept,
                     CASE WHEN n >= 2 AND syy > 0 THEN least(sxy * sxy / (sxx * syy), 1.0) END AS r_squared,
                     CASE WHEN n > 2 AND syy - sxy * sxy / sxx <= 0 THEN 0.0
                          WHEN n > 2 THEN {_t_tail("(sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx))", "(n - 2)")}
                     END AS p_value
              FROM simple_raw)""",
    "features": f"""
        SELECT {ITEM}, count(DISTINCT price) AS unique_prices, count(*) FILTER (qty > 0) AS days_with_sales,
               sum(qty) AS total_qty, sum(qty) / count(DISTINCT date) AS avg_qty
        FROM filled GROUP BY ALL""",
    "elasticity": f"SELECT {ITEM}, avg(qty) AS qty_mean, avg(price) AS price_mean, -1.0::double AS elasticity FROM sales GROUP BY ALL",
    "costs_txn": _latest_costs("true"),
    "costs_txn_back": f"""
        SELECT DISTINCT store, product, cost_txn FROM (
          SELECT l.shop_title AS store, l.product_title AS product, l.category,
                 min(cast(t.price_sell - t.price_margin AS double)) AS cost_txn
          FROM (SELECT shop_title, product_id, product_title, {_strip("category_title")} AS category,
                       max(transacted_at) AS at FROM transaction_items GROUP BY ALL) l
          LEFT JOIN transaction_items t
            ON t.shop_title = l.shop_title AND t.product_id = l.product_id AND t.transacted_at = l.at
          GROUP BY ALL)""",
    "members": f"SELECT shop_id FROM shop_group WHERE group_id = '{q.GROUP_ID}'",
    "deals": f"SELECT * FROM thread_deal WHERE event_start >= {_LO} AND event_end >= {_HI}",
    "costs_deal": """
        SELECT DISTINCT sh.title AS store, p.title AS product,
               cast(coalesce(cast(d.price AS double), cast(p.unit_price_cost AS double)) AS double) AS cost_deal
        FROM deals d
        JOIN relationships db ON db.parent_type = 'deal' AND db.child_type = 'baseproduct' AND db.parent_id = d.id
        JOIN relationships bp ON bp.parent_type = 'baseproduct' AND bp.child_type = 'product' AND bp.parent_id = db.child_id
        JOIN relationships sp ON sp.parent_type = 'shop' AND sp.child_type = 'product' AND sp.child_id = bp.child_id
        JOIN members m ON m.shop_id = sp.parent_id
        JOIN shops sh ON sh.id = sp.parent_id
        JOIN thread_product p ON p.id = sp.child_id AND p.unit_price_cost > 0""",
    "costs_product": """
        SELECT DISTINCT s.title AS store, p.title AS product, cast(price_cost AS double) AS cost_product
        FROM thread_product p SEMI JOIN members m ON m.shop_id = p.shop_id LEFT JOIN shops s ON s.id = p.shop_id
        WHERE NOT removed AND is_stocked AND price_cost > 0 AND p.title IS NOT NULL""",
    "costs": """
        SELECT store, product, least(min(cost_product), min(d.c), min(t.c)) AS cost_lowest
        FROM costs_product
        LEFT JOIN (SELECT store, product, min(cost_deal) AS c FROM costs_deal WHERE cost_deal > 0 GROUP BY ALL) d USING (store, product)
        LEFT JOIN (SELECT store, product, min(cost_txn) AS c FROM costs_txn WHERE cost_txn > 0 GROUP BY ALL) t USING (store, product)
        WHERE cost_product > 0 GROUP BY store, product""",
    "grid_bare": f"""
        SELECT {ITEM}, lo, cast(unnest(range(0, cast(round((hi - lo) * 10) AS bigint) + 1)) AS int) AS grid_idx
        FROM (SELECT {ITEM}, floor(min(price) * 10) / 10 AS lo, ceil(max(price) * 10) / 10 AS hi FROM capped GROUP BY ALL)""",
    "grid": f"SELECT {ITEM}, grid_idx, round(lo + grid_idx * 0.1, 4) AS simulation_prices FROM grid_bare",
    "priced": """SELECT g.*, cost_lowest, simulation_prices - cost_lowest AS simulation_profit
        FROM grid g JOIN costs USING (store, product) WHERE simulation_prices - cost_lowest > 0""",
    "outcome": f"""
        SELECT {ITEM}, grid_idx, simulation_prices, qty_predicted, qty_predicted * simulation_profit AS profit_predicted
        FROM (SELECT p.*, CASE WHEN intercept + coefficient * simulation_prices < 0 THEN 0.0
                     ELSE intercept + coefficient * simulation_prices END AS qty_predicted
              FROM priced p JOIN simple USING ({ITEM}))""",
    "elastic_outcome": f"""
        SELECT {ITEM}, grid_idx, simulation_prices, qty_predicted, qty_predicted * simulation_profit AS profit_predicted
        FROM (SELECT p.*, qty_mean * pow(simulation_prices / price_mean, elasticity) AS qty_predicted
              FROM priced p JOIN elasticity USING ({ITEM}))""",
    "best": f"""
        SELECT {ITEM}, simulation_prices, qty_predicted, profit_predicted FROM outcome WHERE profit_predicted IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY {ITEM} ORDER BY round(profit_predicted, 9) DESC, grid_idx) = 1""",
    "listed": f"SELECT DISTINCT {ITEM} FROM weekly",
    "listed_pairs": """SELECT store, calculation_group, a.product AS product_1, b.product AS product_2
        FROM listed a JOIN listed b USING (store, calculation_group) WHERE a.product <> b.product""",
    "pair_weeks": """SELECT store, calculation_group, a.product AS product_1, b.product AS product_2,
               a.avg_price AS p1, b.avg_price AS p2, a.qty AS q1, b.qty AS q2
        FROM weekly a JOIN weekly b USING (store, calculation_group, week_index) WHERE a.product <> b.product""",
    "correlated": f"""
        SELECT l.*, p AS correlation_coefficient_p, q AS correlation_coefficient_q, p + q AS total_correlation
        FROM listed_pairs l LEFT JOIN (
          SELECT store, calculation_group, product_1, product_2, {_corr("p1", "p2")} AS p, {_corr("q1", "q2")} AS q
          FROM pair_weeks GROUP BY ALL) c USING (store, calculation_group, product_1, product_2)""",
    "correlated_all": f"""
        SELECT l.*, p AS correlation_coefficient_p, q AS correlation_coefficient_q, p + q AS total_correlation
        FROM listed_pairs l LEFT JOIN (
          SELECT calculation_group, product_1, product_2, {_corr("p1", "p2")} AS p, {_corr("q1", "q2")} AS q
          FROM (SELECT l.calculation_group, l.product_1, l.product_2, a.avg_price AS p1, b.avg_price AS p2, a.qty AS q1, b.qty AS q2
                FROM (SELECT DISTINCT calculation_group, product_1, product_2 FROM listed_pairs) l
                JOIN weekly a ON a.product = l.product_1
                JOIN weekly b ON b.product = l.product_2 AND b.week_index = a.week_index)
          GROUP BY ALL) c USING (calculation_group, product_1, product_2)""",
    "ranked": f"""
        SELECT c.*, r AS correlation_coefficient_q_rank
        FROM correlated c LEFT JOIN (
          SELECT store, calculation_group, product_1, product_2, {_corr("r1", "r2")} AS r
          FROM (SELECT *, rank() OVER (PARTITION BY store, calculation_group, product_1, product_2 ORDER BY q1)
                         + (count(*) OVER (PARTITION BY store, calculation_group, product_1, product_2, q1) - 1) / 2.0 AS r1,
                       rank() OVER (PARTITION BY store, calculation_group, product_1, product_2 ORDER BY q2)
                         + (count(*) OVER (PARTITION BY store, calculation_group, product_1, product_2, q2) - 1) / 2.0 AS r2
                FROM pair_weeks) GROUP BY ALL) USING (store, calculation_group, product_1, product_2)""",
    "chosen": _below(q.PAIR_THRESHOLDS),
    "differences": f"""
        SELECT f.store, f.calculation_group, f.product, f.date, f.price, f.qty, c.product_2,
               round(f.price - r.price, 6) AS price_difference
        FROM filled f JOIN chosen c ON c.store = f.store AND c.product_1 = f.product
        LEFT JOIN (SELECT {ITEM}, date, avg(price) AS price
                   FROM (SELECT DISTINCT {ITEM}, date, price FROM filled) GROUP BY ALL) r
          ON r.store = f.store AND r.calculation_group = f.calculation_group AND r.product = c.product_2 AND r.date = f.date""",
    "selling_differences": f"""
        SELECT f.store, f.calculation_group, f.product, f.date, f.price, f.qty, c.product_2,
               round(f.price - r.price, 6) AS price_difference
        FROM sales f JOIN chosen c ON c.store = f.store AND c.product_1 = f.product
        LEFT JOIN (SELECT {ITEM}, date, avg(price) AS price
                   FROM (SELECT DISTINCT {ITEM}, date, price FROM filled) GROUP BY ALL) r
          ON r.store = f.store AND r.calculation_group = f.calculation_group AND r.product = c.product_2 AND r.date = f.date""",
    "cross_days": f"""
        SELECT {ITEM}, date, price, qty, list(product_2 ORDER BY product_2) AS rivals,
               list(price_difference ORDER BY product_2) AS d FROM differences GROUP BY ALL""",
    "cross_points": f"""
        SELECT *, sum(total_qty / unique_days) OVER (PARTITION BY store, product ORDER BY price DESC, d DESC
                   ROWS UNBOUNDED PRECEDING) AS inverted_qty
        FROM (SELECT {ITEM}, price, rivals, d, count(DISTINCT date) AS unique_days, sum(qty) AS total_qty
              FROM cross_days GROUP BY ALL)""",
    "cross_vectors": f"""SELECT {ITEM}, rivals, len(d) + 2 AS n, row_number() OVER () AS point,
        list_concat([price], d, [inverted_qty]) AS v FROM cross_points""",
    "cross_means": f"""
        SELECT {ITEM}, list(m ORDER BY i) AS means
        FROM (SELECT {ITEM}, i, avg(x) AS m
              FROM (SELECT {ITEM}, unnest(v) AS x, unnest(range(1, n + 1)) AS i FROM cross_vectors) GROUP BY ALL)
        GROUP BY ALL""",
    "cross_centred": f"""SELECT {ITEM}, rivals, n, means, point,
        list_transform(range(1, n + 1), lambda i: v[i] - means[i]) AS v FROM cross_vectors JOIN cross_means USING ({ITEM})""",
    "moments": f"""
        SELECT {ITEM}, any_value(rivals) AS rivals, any_value(n) AS n, any_value(rows) AS rows,
               any_value(means) AS means, list(x ORDER BY t) AS g
        FROM (SELECT {ITEM}, t, any_value(rivals) AS rivals, any_value(n) AS n, count(*) AS rows, any_value(means) AS means,
                     sum(v[t // n + 1] * v[t % n + 1]) AS x
              FROM (SELECT *, unnest(range(0, n * n)) AS t FROM cross_centred) GROUP BY {ITEM}, t)
        GROUP BY {ITEM}""",
    "fit": _fit("fit", "range(1, n)", "vif"),
    "fit_literal": _fit("fit_literal", "[cast(1 AS bigint)]", "p"),
    "crossed": f"""SELECT *, CASE WHEN p_value < {config.ALPHA} THEN 'Linear' ELSE 'Not Linear' END AS linearity,
        {_band("r_squared")} AS r_squared_group FROM ({_model("fit")})""",
    "cross_literal": f"""SELECT *, CASE WHEN p_value < {config.ALPHA} THEN 'Linear' ELSE 'Not Linear' END AS linearity,
        {_band("r_squared")} AS r_squared_group FROM ({_model("fit_literal")})""",
    "compared": f"""
        SELECT f.*, s.variable, {", ".join(f"s.{m} AS {m}_simple, c.{m} AS {m}_cross" for m in [*q._MODEL, "linearity", "r_squared_group"])},
               c.vif AS vif_cross, CASE WHEN c.r_squared IS NULL THEN 0 ELSE 1 END AS cannibalization_ind,
               c.r_squared - s.r_squared AS lift_by_cannibalization,
               CASE WHEN c.r_squared - s.r_squared > 0 THEN 1 ELSE 0 END AS uplift_ind,
               row_number() OVER (ORDER BY f.store, f.calculation_group, f.product) AS row_id
        FROM features f LEFT JOIN simple s USING ({ITEM}) LEFT JOIN crossed c USING ({ITEM}, variable)""",
    "better": f"""
        SELECT c.*, f.* EXCLUDE ({ITEM}), r_squared_simple, r_squared_cross, lift_by_cannibalization, uplift_ind
        FROM crossed c JOIN features f USING ({ITEM})
        JOIN (SELECT {ITEM}, r_squared_simple, r_squared_cross, lift_by_cannibalization, uplift_ind
              FROM compared WHERE lift_by_cannibalization > 0) USING ({ITEM})""",
    **_joint_parts("", "better", "priced"),
    "better_sample": _scoped("better"),
    "priced_sample": _scoped("priced"),
    **_joint_parts("_sample", "better_sample", "priced_sample"),
}

# The pairs of active products: the same parts over other weeks.
PARTS["weekly_active"] = """
    SELECT * FROM (SELECT w.* FROM weekly_all w SEMI JOIN (
        SELECT store, calculation_group, product FROM weekly_all JOIN activity USING (store, calculation_group)
        WHERE week_number < 13 GROUP BY threshold_id, store, calculation_group, product, needed
        HAVING count(*) FILTER (qty >= threshold) >= needed - 2) a USING (store, calculation_group, product)
        WHERE week_number < 13)
    SEMI JOIN (SELECT store, product FROM weekly_all SEMI JOIN (
        SELECT store, calculation_group, product FROM weekly_all JOIN activity USING (store, calculation_group)
        WHERE week_number < 13 GROUP BY threshold_id, store, calculation_group, product, needed
        HAVING count(*) FILTER (qty >= threshold) >= needed - 2) a USING (store, calculation_group, product)
        WHERE week_number < 13 GROUP BY ALL HAVING count(DISTINCT avg_price) > 1) USING (store, product)"""
for _name in ("listed", "listed_pairs", "pair_weeks", "correlated", "ranked"):
    PARTS[f"{_name}_active"] = re.sub(r"\b(weekly|listed_pairs|listed|pair_weeks|correlated)\b", r"\1_active", PARTS[_name])

_RECURSIVE = {"fit", "fit_literal"}


def _compose(body: str) -> str:
    """The statement with the parts it needs, each before its users."""
    ordered: list[str] = []

    def visit(text: str, own: str | None) -> None:
        words = set(re.findall(r"(?:FROM|JOIN)\s+\(?\s*(\w+)", text))
        for name in PARTS:
            if name in words and name != own and name not in ordered:
                visit(PARTS[name], name)
                ordered.append(name)

    visit(body, None)
    if not ordered:
        return body
    parts = ",\n".join(
        f"{name} AS ({PARTS[name]})" if name in _RECURSIVE else f"{name} AS MATERIALIZED ({PARTS[name]})"
        for name in ordered
    )
    return f"WITH RECURSIVE {parts}\n{body}"


def _rounded(part: str, columns: list[str], cut=_r6) -> str:
    listed = ", ".join(cut(c) for c in columns)
    return f"SELECT * REPLACE ({listed}) FROM {part}"


_CORRELATIONS = ["correlation_coefficient_p", "correlation_coefficient_q", "total_correlation"]
_JOINT = f"""SELECT {ITEM}, simulation_prices, cost_lowest, {_r4("simulation_profit")},
    {_r4("predicted", "predicted_qty")}, {_r4("profit_predicted")}, {_r4("profit_predicted_all")}, competitor_prices FROM """
_COMPARED = [f"{m}_{kind}" for m in q._MODEL for kind in ("simple", "cross")]



def _uplift(scope: str) -> str:
    return f"""
        SELECT {ITEM}, {_r4("j.profit_predicted")}, {_r4("profit_predicted_all", "profit_predicted_all_cnbl")},
               {_r4("profit_predicted_all_reg")}, {_r4("profit_predicted_all - profit_predicted_all_reg", "profit_predicted_all_uplift")}
        FROM joint{scope} j JOIN baseline{scope} USING ({ITEM}) JOIN store_ref s ON s.store_name = store"""


_IS_TEST = "('0x' || substr(md5(concat_ws('|', store, calculation_group, product, '42')), 1, 8))::BIGINT % 1000 < 200"

BODIES: dict[str, str] = {
    "daily_sales": "SELECT * FROM daily",
    "extract_daily": "SELECT * FROM ("
    + _daily(f"category_title IN ({_quoted(q.CATEGORIES)}) AND {_between(*q.RANGE)}")
    + ")",
    "local_date_range": "SELECT * FROM (" + _daily(_between(*q.RANGE)) + ")",
    "row_count": "SELECT count(*) AS row_count FROM daily",
    "page_assign": f"""SELECT *, (row_number - 1) // {config.PAGE_SIZE} AS page_number
        FROM (SELECT *, row_number() OVER (ORDER BY {DAILY}) AS row_number FROM daily)""",
    "strip_code_prefix": f"""SELECT category_title, product_title, {_strip("category_title")} AS category,
        {_strip("product_title")} AS product_literal,
        CASE WHEN strpos(product_title, '-') > 0 THEN {_strip("product_title")} ELSE product_title END AS product_kept,
        count(*) AS n FROM transaction_items GROUP BY ALL""",
    "sanitize_key": r"""SELECT DISTINCT product_title, regexp_replace(product_title, '[^A-Za-z0-9\s]', '', 'g') AS product_key,
        regexp_replace(concat(category_title, '/', product_title), '[\\/:*?"<>|]', '_', 'g') AS file_name FROM transaction_items""",
    "scope_filter": "SELECT * FROM sales",
    "calculation_group": "SELECT * FROM grouped",
    "group_check": "SELECT DISTINCT department, space, category, calculation_group FROM grouped",
    "tolerant_cast": """SELECT event_id, raw, try_cast(raw AS double) AS number FROM (
        SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN ''
               ELSE cast(value AS varchar) END AS raw FROM events)""",
    "weekly_sales": "SELECT * FROM weekly_all",
    "weekly_sales_quarter": "SELECT * FROM weekly_all WHERE week_number < 13",
    "activity_threshold": """
        SELECT w.*, a.threshold_id, a.weeks_above_threshold FROM weekly_all w JOIN (
          SELECT threshold_id, store, calculation_group, product,
                 count(*) FILTER (qty >= threshold) AS weeks_above_threshold
          FROM weekly_all JOIN activity USING (store, calculation_group)
          GROUP BY threshold_id, store, calculation_group, product, needed
          HAVING count(*) FILTER (qty >= threshold) >= needed) a USING (store, calculation_group, product)""",
    "price_change_filter": "SELECT * FROM moving",
    "cap_outliers": f"""
        SELECT {DAILY}, calculation_group, qty FROM sales WHERE qty <= {q.OUTLIER_QTY}
        UNION ALL
        SELECT {DAILY}, calculation_group, top FROM
          (SELECT DISTINCT {DAILY}, calculation_group FROM sales WHERE qty > {q.OUTLIER_QTY})
          LEFT JOIN (SELECT {ITEM}, max(qty) AS top FROM sales WHERE qty <= {q.OUTLIER_QTY} GROUP BY ALL) USING ({ITEM})""",
    "fill_daily": f"""SELECT {ITEM}, price, original_ind, count(*) AS days, min(date) AS first_date,
        max(date) AS last_date, sum(qty) AS qty FROM filled GROUP BY ALL""",
    "csv_roundtrip": "SELECT * FROM daily",
    "workbook_roundtrip": """SELECT w.*, groups FROM weekly_all w JOIN (
        SELECT department, space, category, count(DISTINCT calculation_group) AS groups FROM sales GROUP BY ALL)
        USING (department, space, category)""",
    "top_rows": f"SELECT * FROM daily ORDER BY {DAILY} LIMIT 60",
    "duplicate_rows": """SELECT * EXCLUDE (copies) FROM (
        SELECT *, count(*) OVER (PARTITION BY shop_title, product_id, product_title, category_title, cost_txn) AS copies
        FROM (SELECT shop_title, product_id, product_title, category_title,
                     cast(price_sell - price_margin AS double) AS cost_txn FROM transaction_items))
        WHERE copies > 1""",
    "null_audit": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows, count(*) FILTER ({c} IS NULL) > 0 AS has_null FROM thread_deal"
        for c in ("id", "price", "title", "minimum_qty", "event_start", "event_end")
    ),
    "coverage_stats": """SELECT min(date) AS min_date, max(date) AS max_date, count(DISTINCT store) AS stores,
        count(DISTINCT calculation_group) AS groups, count(DISTINCT product) AS products, count(*) AS rows FROM sales""",
    "quantile_bounds": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {_r6("q1")}, {_r6("q3")}, {_r6("q99")}, {_r6("q3 - q1", "iqr")},
        {_r6("q1 - 3 * (q3 - q1)", "lower_bound")}, {_r6("q3 + 3 * (q3 - q1)", "upper_bound")}
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.99) AS q99 FROM moving)"""
        for c in ("qty", "price")
    ),
    "cost_from_transactions": "SELECT * FROM costs_txn",
    "cost_extract": "SELECT * FROM ("
    + _latest_costs(f"category_title IN ({_quoted(q.CATEGORIES)}) AND {_between(*q.RANGE)}")
    + ")",
    "cost_from_transactions_join_back": "SELECT * FROM costs_txn_back",
    "shop_group_filter": "SELECT id, shop_id, title FROM thread_product WHERE shop_id IN (SELECT shop_id FROM members)",
    "deal_window": "SELECT id, cast(price AS double) AS price, title FROM deals",
    "deal_window_overlap": f"""SELECT id, cast(price AS double) AS price, title FROM thread_deal
        WHERE event_start <= {_HI} AND event_end >= {_LO}""",
    "deal_cost": "SELECT * FROM costs_deal",
    "lowest_deal_cost": "SELECT store, product, min(cost_deal) AS cost_deal FROM costs_deal WHERE cost_deal > 0 GROUP BY ALL",
    "product_cost": "SELECT * FROM costs_product",
    "cost_sources_union": """SELECT store, product, cost_product AS cost, 'product' AS source FROM costs_product
        UNION ALL SELECT store, product, cost_deal, 'deal' FROM costs_deal
        UNION ALL SELECT store, product, cost_txn, 'transaction' FROM costs_txn""",
    "lowest_cost": "SELECT * FROM costs",
    "feasible_cost": """SELECT store, product, coalesce(least(min(cost_product), min(cost_txn)), 0.0) AS feasible_cost
        FROM (SELECT DISTINCT store, product FROM sales) LEFT JOIN costs_product USING (store, product)
        LEFT JOIN costs_txn USING (store, product) GROUP BY ALL""",
    "pair_correlation": _rounded("correlated", _CORRELATIONS),
    "pair_correlation_all_stores": _rounded("correlated_all", _CORRELATIONS),
    "pair_rank_correlation": _rounded("ranked", [*_CORRELATIONS, "correlation_coefficient_q_rank"]),
    "pairs_of_active": _rounded("ranked_active", [*_CORRELATIONS, "correlation_coefficient_q_rank"]),
    "select_pairs": _below(config.PAIR_THRESHOLDS),
    "unique_prices_window": """
        SELECT s.*, unique_days, total_qty, unique_prices FROM sales s
        JOIN (SELECT store, product, price, count(DISTINCT date) AS unique_days, sum(qty) AS total_qty
              FROM sales GROUP BY ALL) USING (store, product, price)
        JOIN (SELECT store, product, count(DISTINCT price) AS unique_prices FROM sales GROUP BY ALL) USING (store, product)""",
    "demand_points": "SELECT * FROM points",
    "demand_points_observed": f"""
        SELECT *, total_qty / unique_days AS avg_qty, count(*) OVER (PARTITION BY store, product) AS unique_prices
        FROM (SELECT {ITEM}, price, count(DISTINCT date) AS unique_days, sum(qty) AS total_qty FROM sales GROUP BY ALL)""",
    "cumulative_demand": _rounded("curve", ["inverted_qty"]),
    "simple_regression": _rounded("simple", q._MODEL),
    "r2_band": "SELECT calculation_group, r_squared_group, linearity, count(*) AS models FROM simple GROUP BY ALL",
    "product_features": "SELECT * FROM features",
    "constant_elasticity": _rounded("elasticity", ["qty_mean", "price_mean"]),
    "price_difference_features": f"""SELECT {ITEM}, product_2, count(*) AS days, count(price_difference) AS priced_days,
        round(sum(price_difference), 4) + 0.0 AS difference_sum, min(price_difference) AS difference_min,
        max(price_difference) AS difference_max, sum(qty) AS qty FROM differences GROUP BY ALL""",
    "price_differences_carried": f"SELECT * EXCLUDE (price_difference), {_r6('price_difference')} FROM selling_differences",
    "demand_points_cross": f"""SELECT {ITEM}, price, array_to_string(list_transform(d, lambda x: cast(round(x * 100) AS bigint)), '|') AS differences_in_cents,
        len(rivals) AS rivals, round(list_sum(d), 6) + 0.0 AS price_diff_all, unique_days, total_qty, {_r6("inverted_qty")}
        FROM cross_points""",
    "vif": f"""
        SELECT {ITEM}, CASE WHEN a = 1 THEN 'Price' ELSE rivals[a - 1] END AS variable,
               {_r4(f"-s[{_DIAG}] * g[{_DIAG}]", "vif")}
        FROM (SELECT *, unnest(active) AS a, {_SWEPT} AS s FROM (SELECT *, range(1, n) AS active FROM moments))""",
    "ols_model": _rounded("crossed", [*q._MODEL, "vif"], _r4),
    "ols_model_literal": _rounded("cross_literal", [*q._MODEL, "vif"], _r4),
    "model_comparison": _rounded("compared", [*_COMPARED, "vif_cross", "lift_by_cannibalization"], _r4),
    "uplift_models": _rounded(
        "better", [*q._MODEL, "vif", "r_squared_simple", "r_squared_cross", "lift_by_cannibalization"], _r4
    ),
    "model_report_roundtrip": " UNION ALL ".join(
        f"SELECT store, '{sheet}' AS sheet, count(*) AS rows, count(DISTINCT (calculation_group, product)) AS products FROM {part} GROUP BY store"
        for sheet, part in (
            ("model_comparison", "compared"),
            ("simple_regression", f"(SELECT * FROM simple JOIN features USING ({ITEM}))"),
            ("ols", f"(SELECT * FROM crossed JOIN features USING ({ITEM}))"),
        )
    ),
    "quality_tree_split": f"SELECT {ITEM}, {_IS_TEST} AS is_test FROM compared",
    "quality_tree_features": f"""
        SELECT cast(row_number() OVER (ORDER BY part, place) - 1 AS int) AS feature_idx, feature, 1.0::DOUBLE AS importance_sum FROM (
          SELECT 0 AS part, unnest(range(0, {len(quality.NUMBERS)})) AS place, unnest([{_quoted(quality.NUMBERS)}]) AS feature
          UNION ALL SELECT 1, row_number() OVER (ORDER BY store DESC), concat('store_', store)
            FROM (SELECT DISTINCT store FROM compared) QUALIFY row_number() OVER (ORDER BY store) > 1
          UNION ALL SELECT 2, row_number() OVER (ORDER BY calculation_group DESC), concat('calculation_group_', calculation_group)
            FROM (SELECT DISTINCT calculation_group FROM compared) QUALIFY row_number() OVER (ORDER BY calculation_group) > 1)""",
    "quality_tree_support": f"SELECT r_squared_group_simple AS label, count(*) FILTER ({_IS_TEST}) AS support FROM compared GROUP BY label",
    "price_grid": "SELECT * FROM grid",
    "grid_with_cost": _rounded("priced", ["simulation_profit"]),
    "simulate_simple": _rounded("outcome", q._OUTCOME),
    "best_price_simple": _rounded("best", q._OUTCOME),
    "simulate_constant_elasticity": _rounded("elastic_outcome", q._OUTCOME),
    "strategy_best_price": f"""
        SELECT {ITEM}, simulation_prices, {_r6("qty_predicted")}, {_r6("profit_predicted")}
        FROM (SELECT *, qty_predicted * (simulation_prices - cost) AS profit_predicted
              FROM (SELECT {ITEM}, grid_idx, round(lo + grid_idx * 0.1, 4) AS simulation_prices, coalesce(cost_lowest, 0) AS cost,
                           qty_mean * pow(round(lo + grid_idx * 0.1, 4) / price_mean, -1) AS qty_predicted
                    FROM (SELECT {ITEM}, avg(qty) AS qty_mean, avg(price) AS price_mean, floor(min(price) * 10) / 10 AS lo,
                                 unnest(range(0, cast(ceil(max(price) * 10) - floor(min(price) * 10) AS bigint) + 1)) AS grid_idx
                          FROM moving GROUP BY {ITEM})
                    LEFT JOIN costs USING (store, product)))
        WHERE simulation_prices > cost AND profit_predicted > 0
        QUALIFY row_number() OVER (PARTITION BY {ITEM} ORDER BY round(profit_predicted, 9) DESC, grid_idx) = 1""",
    "own_effect": f"""SELECT {ITEM}, {_r4("coefficient")}, {_r4("intercept")}, grid_idx, simulation_prices, cost_lowest,
        {_r4("simulation_profit")}, {_r4("qty_adjustment")} FROM own_rows""",
    "competitor_effect": f"""
        SELECT r.store, r.calculation_group, r.product, r.variable, {_r4("r.coefficient")}, c.grid_idx, c.simulation_prices,
               {_r4("c.profit_predicted")}, {_r4("r.coefficient * c.simulation_prices", "qty_adjustment")}
        FROM rivals r JOIN outcome c ON c.store = r.store AND c.calculation_group = r.calculation_group AND c.product = r.variable""",
    "joint_best_price": _JOINT + "joint_sample",
    "joint_best_price_all": _JOINT + "joint",
    "joint_best_price_consistent": _JOINT + "joint_consistent",
    "baseline_members": _rounded("members_of", q._OUTCOME, _r4),
    "baseline_profit": _rounded("baseline", ["profit_predicted_all_reg"], _r4),
    "profit_uplift": _uplift("_sample"),
    "profit_uplift_all": _uplift(""),
    "joint_result_files": f"""
        SELECT j.store, j.calculation_group, j.product, j.simulation_prices, {_r4("j.predicted", "predicted_qty")},
               {_r4("j.profit_predicted")}, {_r4("profit_predicted_all")}, j.member, j.member_price,
               {_r4("c.qty_predicted", "member_qty")}, {_r4("c.profit_predicted", "member_profit")},
               {_r4("profit_predicted_all_reg")}, {_r4("profit_predicted_all - profit_predicted_all_reg", "profit_predicted_all_uplift")},
               store_codes, regexp_replace(j.product, '[^A-Za-z0-9\\s]', '', 'g') AS product_key
        FROM (SELECT *, nullif(string_split(pair, '=')[1], '') AS member, cast(string_split(pair, '=')[2] AS bigint) / 10.0 AS member_price
              FROM (SELECT *, unnest(string_split(competitor_prices, '|')) AS pair FROM joint)) j
        LEFT JOIN outcome c ON c.store = j.store AND c.calculation_group = j.calculation_group AND c.product = j.member
            AND round(c.simulation_prices * 10) = round(j.member_price * 10)
        JOIN baseline b ON b.store = j.store AND b.calculation_group = j.calculation_group AND b.product = j.product
        JOIN store_ref s ON s.store_name = j.store""",
    "result_pivot": f"""SELECT store, calculation_group, {", ".join(
        f'''{_cut(f"max(profit_predicted) FILTER (product = '{p}')")} AS "profit_predicted_{p}"''' for p in q.PRODUCTS
    )}, {_r6("sum(profit_predicted)", "profit_predicted_all")} FROM best GROUP BY store, calculation_group""",
    "partitioned_result": f"""SELECT {ITEM}, simulation_prices, {_r6("qty_predicted")}, {_r6("profit_predicted")}, store_codes,
        regexp_replace(product, '[^A-Za-z0-9\\s]', '', 'g') AS product_key
        FROM best JOIN store_ref ON store_name = store""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _compose(body) for name, body in BODIES.items()}
