import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise import config
from tillwise.operators import audit, cost, crosseffects, demand, ordinal, pairs, prep, simulate
from tillwise.plans import quality, steps, strategy
from tillwise.sources import tables

DAY = dt.date(2024, 1, 1)


def daily(spark, rows):
    """rows: (store, product, day, price, qty)"""
    full = [
        (s, "D", "EDIBLE", "CHOCOLATES", p, DAY + dt.timedelta(days=d), float(x), float(q), "CHOCOLATES")
        for s, p, d, x, q in rows
    ]
    schema = (
        "store string, department string, space string, category string, product string, date date, "
        "price double, qty double, calculation_group string"
    )
    return spark.createDataFrame(full, schema)


def random_daily(spark, products=7, days=60, seed=1):
    rng = np.random.default_rng(seed)
    rows = [
        ("S", f"P{p}", d, rng.integers(20, 60) / 10, int(rng.integers(1, 20)))
        for p in range(products)
        for d in range(days)
        if rng.random() < 0.7
    ]
    return daily(spark, rows)


def test_fill_carries_prices_both_ways(spark):
    sales = daily(spark, [("S", "A", 1, 2.0, 3), ("S", "A", 1, 3.0, 1), ("S", "A", 4, 5.0, 2), ("S", "B", 0, 1, 1), ("S", "B", 6, 1, 1)])
    rows = prep.fill_daily(sales).filter("product = 'A'").orderBy("date", "price").collect()
    got = [((r.date - DAY).days, r.price, r.qty, r.original_ind) for r in rows]
    assert got == [
        (0, 2.0, 0.0, 0), (1, 2.0, 3.0, 1), (1, 3.0, 1.0, 1), (2, 3.0, 0.0, 0), (3, 3.0, 0.0, 0),
        (4, 5.0, 2.0, 1), (5, 5.0, 0.0, 0), (6, 5.0, 0.0, 0),
    ]


def test_carried_points_equal_points_of_filled_sales(spark):
    sales = random_daily(spark)
    short, full = demand.demand_points_carried(sales), demand.demand_points(prep.fill_daily(sales))
    assert short.exceptAll(full).isEmpty() and full.exceptAll(short).isEmpty()


def test_cumulative_demand_is_monotone(spark):
    curve = demand.cumulative_demand(demand.demand_points(random_daily(spark))).toPandas()
    for _, product in curve.groupby("product"):
        assert product.sort_values("price", ascending=False)["inverted_qty"].is_monotonic_increasing


def test_outliers_take_the_largest_value_in_range(spark):
    sales = daily(spark, [("S", "A", 0, 1, 500), ("S", "A", 1, 1, 40), ("S", "A", 2, 1, 90), ("S", "B", 0, 1, 300)])
    got = {(r["product"], (r["date"] - DAY).days): r["qty"] for r in prep.cap_outliers(sales).collect()}
    assert got == {("A", 0): 90.0, ("A", 1): 40.0, ("A", 2): 90.0, ("B", 0): None}


def test_page_union_is_the_whole_and_numbers_are_dense(spark):
    rows = spark.createDataFrame([(a, b, c) for a in "xyz" for b in ("q", None) for c in range(5)], "a string, b string, c int")
    paged = ordinal.assign_pages(rows, [["a"], ["b"], ["c"]], 7)
    ordered = paged.orderBy("row_number").collect()
    assert [r.row_number for r in ordered] == list(range(1, 31))
    assert [(r.a, r.b is None, r.b or "", r.c) for r in ordered] == sorted((r.a, r.b is None, r.b or "", r.c) for r in ordered)
    assert sum(ordinal.fetch_page(paged, p).count() for p in range(5)) == 30


def test_duplicates_come_back_in_pieces(spark):
    rows = spark.createDataFrame([("a", 1)] * 7 + [("b", 2)] + [(None, 3)] * 2, "k string, v int")
    got = sorted(((r.k or ""), r.v) for r in audit.duplicate_rows(rows, copies_per_piece=3).collect())
    assert got == [("", 3)] * 2 + [("a", 1)] * 7


@pytest.mark.parametrize("block", [2, 100])
def test_pairs_against_pandas(spark, block):
    weekly = prep.weekly_sales(random_daily(spark, products=6, days=120))
    frame = weekly.toPandas().pivot(index="week_index", columns="product", values=["avg_price", "qty"])
    got = pairs.pair_rank_correlation(weekly, block=block).toPandas()
    assert len(got) == 30
    for r in got.itertuples():
        both = frame[[("avg_price", r.product_1), ("avg_price", r.product_2), ("qty", r.product_1), ("qty", r.product_2)]].dropna().to_numpy()
        ranks = pd.DataFrame(both[:, 2:]).rank().to_numpy()
        assert np.isclose(r.correlation_coefficient_p, np.corrcoef(both[:, 0], both[:, 1])[0, 1])
        assert np.isclose(r.correlation_coefficient_q, np.corrcoef(both[:, 2], both[:, 3])[0, 1])
        assert np.isclose(r.correlation_coefficient_q_rank, np.corrcoef(ranks[:, 0], ranks[:, 1])[0, 1])


def test_selected_pairs_equal_filtered_table(spark):
    weekly = prep.weekly_sales(random_daily(spark, products=8, days=90))
    limits = {"S": (-0.05, -0.05)}
    keys = ["product_1", "product_2"]
    chosen = pairs.select_pairs(weekly, limits, block=3).select(*keys)
    filtered = pairs.filter_pairs(pairs.pair_rank_correlation(weekly), limits).select(*keys)
    assert chosen.count() > 0
    assert chosen.exceptAll(filtered).isEmpty() and filtered.exceptAll(chosen).isEmpty()


def test_constant_series_has_no_correlation(spark):
    rows = [("S", p, 7 * w, 2.0 if p == "A" else 2 + w / 10, w + 1) for p in "AB" for w in range(6)]
    got = pairs.pair_correlation(prep.weekly_sales(daily(spark, rows))).collect()
    assert all(r.correlation_coefficient_p is None and r.total_correlation is None for r in got)


def _points(spark, products=4):
    sales = random_daily(spark, products=products, days=90, seed=3)
    names = [f"P{i}" for i in range(products)]
    chosen = spark.createDataFrame([("S", a, b) for a in names[:2] for b in names if a != b], "store string, product_1 string, product_2 string")
    return sales, chosen, crosseffects.demand_points_cross(prep.fill_daily(sales), chosen)


def test_cross_points_equal_the_long_features(spark):
    sales, chosen, points = _points(spark)
    long = crosseffects.price_difference_features(prep.fill_daily(sales), chosen).toPandas()
    wide = long.pivot_table(index=["product", "date", "price", "qty"], columns="product_2", values="price_difference").reset_index()
    for name, rows in points.toPandas().groupby("product"):
        own = wide[wide["product"] == name]
        rivals = list(rows["rivals"].iloc[0])
        keyed = own.groupby(["price", *rivals])["date"].nunique()
        assert len(rows) == len(keyed)
        for r in rows.itertuples():
            assert keyed[(r.price, *r.differences)] == r.unique_days


def test_model_without_elimination_is_least_squares(spark):
    _, _, points = _points(spark)
    fitted = crosseffects.cross_model(points, max_vif=float("inf"), alpha=1.0).toPandas()
    for name, rows in points.toPandas().groupby("product"):
        x = np.column_stack([np.ones(len(rows)), rows["price"], np.vstack(rows["differences"])])
        beta = np.linalg.lstsq(x, rows["inverted_qty"].to_numpy(), rcond=None)[0]
        mine = fitted[fitted["product"] == name].set_index("variable")["coefficient"]
        assert np.allclose(mine[["const", "Price", *rows["rivals"].iloc[0]]], beta)


def test_literal_total_leaves_the_price_alone(spark):
    _, _, points = _points(spark)
    left = crosseffects.cross_model(points, features="literal").select("variable").distinct().collect()
    assert {r.variable for r in left} == {"const", "Price"}
    vif = crosseffects.variance_inflation(points, features="literal").filter("variable <> 'Price'")
    assert vif.filter("vif is not null").isEmpty()


def test_inflation_of_a_repeated_column_is_infinite():
    x = np.random.default_rng(0).normal(size=(30, 2))
    assert np.isinf(crosseffects.inflation_factors(np.column_stack([x, x[:, 0]]))[[0, 2]]).all()
    r = np.corrcoef(x.T)[0, 1]
    assert np.allclose(crosseffects.inflation_factors(x), 1 / (1 - r * r))


@pytest.mark.parametrize("consistent", [False, True])
def test_joint_optimum_equals_enumeration(spark, consistent):
    rng = np.random.default_rng(7)
    key = ("S", "G")
    names = ["A", "B", "C", "D"]
    grid = [(*key, n, i, round(2 + i / 10, 4), 1.5, round(2 + i / 10, 4) - 1.5) for n in names for i in range(6)]
    profit = {(n, i): float(max(0, rng.normal(2, 3))) for n in names for i in range(6)}
    coefficient = {(a, b): float(rng.normal(0, 4)) for a in names for b in names if a != b}
    own = {n: (float(rng.normal(10, 15)), float(rng.normal(-4, 2))) for n in names}
    models = [(*key, n, v, c, own[n][0]) for n in names for v, c in [("const", own[n][0]), ("Price", own[n][1])]]
    models += [(*key, a, b, c, own[a][0]) for (a, b), c in coefficient.items()]
    item = "store string, calculation_group string, product string, "
    best = simulate.joint_best_price(
        spark.createDataFrame(models, item + "variable string, coefficient double, intercept double"),
        spark.createDataFrame(grid, item + "grid_idx int, simulation_prices double, cost_lowest double, simulation_profit double"),
        spark.createDataFrame(
            [(*key, n, i, round(2 + i / 10, 4), 0.0, p) for (n, i), p in profit.items()],
            item + "grid_idx int, simulation_prices double, qty_predicted double, profit_predicted double",
        ),
        consistent,
    ).collect()
    assert {r["product"] for r in best} == set(names)
    for r in best:
        a, others, top = r["product"], [n for n in names if n != r["product"]], -np.inf
        for i in range(6):
            p = 2 + i / 10
            for js in itertools.product(range(6), repeat=3):
                q = own[a][0] + own[a][1] * p
                for b, j in zip(others, js):
                    q += coefficient[a, b] * (p - (2 + j / 10) if consistent else 2 + j / 10)
                top = max(top, (p - 1.5) * max(0, q) + sum(profit[b, j] for b, j in zip(others, js)))
        assert np.isclose(r["profit_predicted_all"], top)


# store, price, cost, quantity, joint profit, separate profit, uplift of three published results
GOLDEN = [
    ("Country Store", 4.6, 2.172, 20.83968674, 50.5987594, 3.429712756, 47.16904664),
    ("Metro Discount", 7.7, 5.2325, 2.411742904, 5.950975615, 2.265254767, 3.685720849),
    ("Metro Store", 4.1, 2.172, 2.457551472, 4.738159238, 2.264894699, 2.473264539),
]


@pytest.mark.parametrize("store,price,unit_cost,qty,joint,separate,uplift", GOLDEN)
def test_golden_rows(spark, store, price, unit_cost, qty, joint, separate, uplift):
    item = "store string, calculation_group string, product string, "
    key = (store, "CONFECTIONERY", "A")
    grid = spark.createDataFrame([(*key, 0, price, unit_cost, price - unit_cost)], item + "grid_idx int, simulation_prices double, cost_lowest double, simulation_profit double")
    model = spark.createDataFrame([(*key, "Price", 0.0, qty)], item + "variable string, coefficient double, intercept double")
    simulated = grid.selectExpr("store", "calculation_group", "product", "grid_idx", "simulation_prices", "0D AS qty_predicted", "0D AS profit_predicted")
    best = simulate.joint_best_price(model, grid, simulated)
    base = spark.createDataFrame([(*key, separate)], item + "profit_predicted_all_reg double")
    ref = spark.createDataFrame([(store, "X")], "store_name string, store_codes string")
    row = simulate.common_result(simulate.profit_uplift(best, base, ref)).first()
    assert np.isclose(row.profit_predicted_all_cnbl, joint, atol=1e-6)
    assert np.isclose(row.profit_predicted_all_uplift, uplift, atol=1e-6)


def test_join_back_takes_same_instant_rows_of_other_titles(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("S", "1", "old", "300 - X", at, 5.0, 1.0), ("S", "1", "new", "300 - X", at, 5.0, 3.0)]
    schema = "shop_title string, product_id string, product_title string, category_title string, transacted_at timestamp_ntz, price_sell double, price_margin double"
    sold = spark.createDataFrame(rows, schema)

    def costs(join_back):
        return {r["product"]: r.cost_txn for r in cost.cost_from_transactions(sold, join_back).collect()}

    assert costs(False) == {"old": 4.0, "new": 2.0}
    assert costs(True) == {"old": 2.0, "new": 2.0}


def test_feasible_cost_falls_back_to_zero(spark):
    products = spark.createDataFrame([("S", "A"), ("S", "B")], "store string, product string")
    costs = spark.createDataFrame([("S", "A", None, 3.0), ("S", "A", 4.0, None)], "store string, product string, cost_x double, Cost_Y double")
    got = {r["product"]: r.feasible_cost for r in cost.feasible_cost(products, costs).collect()}
    assert got == {"A": 3.0, "B": 0.0}


def test_pivot_has_a_column_per_product(spark):
    best = spark.createDataFrame([("S", "G", "A", 1.0, 5.0), ("S", "G", "B", 2.0, 7.0)], "store string, calculation_group string, product string, qty_predicted double, profit_predicted double")
    row = simulate.result_pivot(best, ["A", "B"], ("profit_predicted", "qty_predicted")).first().asDict()
    assert row["profit_predicted_A"] == 5.0 and row["qty_predicted_B"] == 2.0 and row["profit_predicted_all"] == 12.0


def test_stock_strategy_has_no_pairs(spark):
    sales = random_daily(spark, products=3, days=40)
    assert strategy.candidate_pairs(sales).isEmpty()
    by_correlation = strategy.PricingStrategy(select_pairs=strategy.correlated_pairs)
    assert strategy.candidate_pairs(sales, by_correlation).columns == ["store", "product_1", "product_2"]
    costs = spark.createDataFrame([("S", "P0", 1.0)], "store string, product string, cost_lowest double")
    assert strategy.best_prices(sales, costs).count() == 3


def test_quality_tree(spark):
    rows = [("SRT"[i % 3], "GH"[i % 2], f"P{i}", i % 2, i, float(i), float(i) / 9, i, "High" if i % 2 else "Low") for i in range(120)]
    schema = "store string, calculation_group string, product string, cannibalization_ind int, unique_prices int, total_qty double, avg_qty double, days_with_sales int, r_squared_group_simple string"
    comparison = spark.createDataFrame(rows, schema)
    train, test = quality.split_rows(comparison)
    assert train.count() + test.count() == 120 and 0 < test.count() < 60
    tree = quality.fit_quality_tree(comparison, train)
    assert list(tree.features) == quality.feature_names(comparison) == [*quality.NUMBERS, "store_T", "store_S", "calculation_group_H"]
    assert np.isclose(tree.importances().agg(F.sum("importance")).first()[0], 1.0)
    report = {r.label: r for r in tree.report(test).collect()}
    assert set(report) == {"High", "Low", "accuracy", "macro avg", "weighted avg"} and all(r.recall == 1.0 for r in report.values())
    assert report["accuracy"].support == test.count()


def test_report_names_labels_that_are_only_predicted(spark):
    rows = [("S", "G", f"P{i}", 0, 1, float(i >= 40), 1.0, 1, "High" if i >= 40 else "Low") for i in range(80)]
    schema = "store string, calculation_group string, product string, cannibalization_ind int, unique_prices int, total_qty double, avg_qty double, days_with_sales int, r_squared_group_simple string"
    comparison = spark.createDataFrame(rows, schema)
    tree = quality.fit_quality_tree(comparison, comparison, max_depth=quality.DRAWN_DEPTH)
    wrong = comparison.filter("total_qty = 1").limit(3).withColumn("r_squared_group_simple", F.lit("Low"))
    report = {r.label: r for r in tree.report(wrong).collect()}
    assert (report["High"].support, report["Low"].support, report["accuracy"].recall) == (0, 3, 0.0)


def test_categories_by_name(spark):
    sold = spark.createDataFrame([("311 - SOFT DRINKS",), ("BISCUITS",), ("999 - OTHER",)], "category_title string")
    kept = prep.select_transactions(sold, names=["SOFT DRINKS", "BISCUITS"]).collect()
    assert [r.category_title for r in kept] == ["311 - SOFT DRINKS", "BISCUITS"]


def test_plan_prunes_and_pushes(spark):
    path = "/root/testdata/sf0.001/lineitem.parquet"
    source = tables.read_table(spark, path).selectExpr("l_shipdate AS transacted_at", "l_partkey AS category_title", "l_quantity")
    plan = steps.prep.select_transactions(source, None, "1998-01-01", "1998-12-31").select("l_quantity")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual" in text
    assert "l_extendedprice" not in text


def two_listings(spark):
    """Random sales, part of them under a second category of the same group."""
    sales = random_daily(spark, products=5, days=80, seed=5)
    other = F.when(F.pmod(F.xxhash64("date", "product"), F.lit(3)) == 0, "CHOCOLATES, COOKING").otherwise(F.col("category"))
    doubled = sales.filter("product in ('P0', 'P1')").withColumn("category", F.lit("CHOCOLATES, DARK")).withColumn("qty", F.col("qty") + 1)
    return sales.withColumn("category", other).unionByName(doubled)


def test_listings_of_a_product_are_one_product(spark):
    sales = two_listings(spark)
    short, full = demand.demand_points_carried(sales), demand.demand_points(prep.fill_daily(sales))
    assert short.exceptAll(full).isEmpty() and full.exceptAll(short).isEmpty()
    days = short.groupBy("product").agg(F.sum("unique_days").alias("n")).collect()
    span = sales.agg(F.datediff(F.max("date"), F.min("date")) + 1).first()[0]
    prices = {r["product"]: r.n for r in sales.groupBy("product", "date").agg(F.count_distinct("price").alias("n")).groupBy("product").agg(F.sum(F.col("n") - 1).alias("n")).collect()}
    assert all(r.n == span + prices[r["product"]] for r in days)


@pytest.mark.parametrize("block", [2, 100])
def test_pairs_of_products_with_two_listings(spark, block):
    weekly = prep.weekly_sales(two_listings(spark))
    rows = weekly.toPandas()
    got = pairs.pair_rank_correlation(weekly, block=block).toPandas()
    assert len(got) == 20
    for r in got.itertuples():
        both = rows[rows["product"] == r.product_1].merge(rows[rows["product"] == r.product_2], on="week_index")
        ranks = both[["qty_x", "qty_y"]].rank()
        assert np.isclose(r.correlation_coefficient_p, np.corrcoef(both.avg_price_x, both.avg_price_y)[0, 1])
        assert np.isclose(r.correlation_coefficient_q, np.corrcoef(both.qty_x, both.qty_y)[0, 1])
        assert np.isclose(r.correlation_coefficient_q_rank, np.corrcoef(ranks.qty_x, ranks.qty_y)[0, 1])


def test_all_store_pairs_are_the_same_in_every_store(spark):
    sales = two_listings(spark).unionByName(random_daily(spark, products=3, days=60, seed=9).withColumn("store", F.lit("T")))
    weekly = prep.weekly_sales(sales)
    got = pairs.pair_correlation(weekly, scope="all").toPandas()
    assert sorted(got["store"].value_counts().items()) == [("S", 20), ("T", 6)]
    measures = ["correlation_coefficient_p", "correlation_coefficient_q"]
    assert (got.groupby(["product_1", "product_2"])[measures].nunique() == 1).all().all()


def test_two_groups_of_a_product_are_refused(spark):
    sales = random_daily(spark, products=2, days=5)
    assert prep.require_one_group(sales) is sales
    mixed = sales.withColumn("calculation_group", F.when(F.col("price") > 4, "A").otherwise("B"))
    with pytest.raises(ValueError, match="is in A and in B"):
        prep.require_one_group(mixed)


def test_pivot_refuses_products_without_a_column(spark):
    best = spark.createDataFrame([("S", "G", "A", 5.0), ("S", "G", "B", 7.0)], "store string, calculation_group string, product string, profit_predicted double")
    with pytest.raises(Exception, match="no column for product B"):
        simulate.result_pivot(best, ["A"]).collect()


def test_grid_is_that_of_capped_sales(spark):
    sales = two_listings(spark).withColumn("qty", F.when(F.col("qty") % 7 != 0, F.col("qty")))
    constant = sales.filter("product = 'P2'").withColumns({"product": F.lit("C"), "price": F.lit(2.5)})
    sales = sales.unionByName(constant)
    long = simulate.price_grid(prep.cap_outliers(prep.keep_price_changes(sales), 9))
    short = simulate.moving_price_grid(sales)
    assert short.count() > 0 and short.exceptAll(long).isEmpty() and long.exceptAll(short).isEmpty()


def test_chosen_pairs_reach_the_demand_model(spark):
    sales = random_daily(spark, products=4, days=80)
    given = {}

    def model(moving, chosen):
        given["pairs"] = chosen.count()
        return demand.constant_elasticity(moving)

    def two_pairs(weekly):
        return weekly.sparkSession.createDataFrame([("S", "P0", "P1"), ("S", "P1", "P0")], "store string, product_1 string, product_2 string")

    costs = spark.createDataFrame([("S", "P0", 1.0)], "store string, product string, cost_lowest double")
    strategy.best_prices(sales, costs, strategy.PricingStrategy(select_pairs=two_pairs, build_demand_model=model)).count()
    assert given == {"pairs": 2}


def test_run_reads_transactions_twice_and_leaves_only_its_files(spark, tmp_path):
    from tillwise.sources import scratch
    from tillwise.sources.marketdata import Market

    market = Market(spark, "/root/testdata/sf0.001")
    raw = str(tmp_path / "raw")
    market["transaction_items"].write.parquet(raw)
    sold, reads = spark.read.parquet(raw), []

    def staged(df, name, stage=scratch.stage):
        reads.append((name, any("/raw/" in f for f in df.inputFiles())))
        return stage(df, name)

    original, steps.stage = steps.stage, staged
    try:
        steps.run(
            sold, {"deals": cost.deals_in_window(market["thread_deal"], "1998-01-01", "1998-03-31"), "relationships": market["relationships"],
                   "shops": market["shops"], "products": market["thread_product"], "shop_group": market["shop_group"]},
            "main", market["store_ref"], str(tmp_path / "out"),
        )
    finally:
        steps.stage = original
    assert [name for name, raw_read in reads if raw_read] == ["daily", "costs"]
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"models", "prices", "uplift"}
    assert {p.name for p in (tmp_path / "out" / "models").iterdir()} == {"model_comparison", "simple_regression", "ols"}
    assert not [p for p in __import__("os").listdir(scratch.shared_dir(spark).removeprefix("file:")) if p.startswith("run-")]


def test_model_of_two_thousand_rivals(spark):
    """Competitor blocks meet across chunks; only matrices of regressors reach a task."""
    rng = np.random.default_rng(11)
    rivals, days = 2000, 40
    start = dt.date(2024, 1, 1)
    rows = [("S", "own", start + dt.timedelta(d), round(float(rng.normal(10, 1)), 2), float(rng.integers(1, 9))) for d in range(days)]
    change = rng.integers(1, days, rivals)
    for r in range(rivals):
        for d in (0, int(change[r])):
            rows.append(("S", f"R{r:04}", start + dt.timedelta(d), 5.0 + d / 10 + r % 7, 1.0))
    table = spark.createDataFrame(rows, "store string, product string, date date, price double, qty double")
    table = table.selectExpr("store", "'D' as department", "'A' as space", "'C' as category", "product", "date", "price", "qty", "'G' as calculation_group")
    chosen = spark.createDataFrame([("S", "own", f"R{r:04}") for r in range(rivals)], "store string, product_1 string, product_2 string")
    filled = prep.fill_daily(table)
    last = {f"R{r:04}": change[r] for r in range(rivals)}
    points = crosseffects.demand_points_cross(filled, chosen).toPandas()
    assert all(len(d) == rivals for d in points["differences"]) and list(points["rivals"].iloc[0]) == sorted(last)
    assert points["unique_days"].sum() == days
    complete = points[[not np.isnan(np.array(d, float)).any() for d in points["differences"]]]
    back = spark.createDataFrame(points)
    found = crosseffects.Moments.of_blocks(crosseffects._matrices(back, False).toPandas(), False)
    x = np.column_stack([complete["inverted_qty"], complete["price"], np.vstack(complete["differences"])])
    assert found.n == len(x) and np.allclose(found.means, x.mean(0))
    assert np.allclose(found.sums, (x - x.mean(0)).T @ (x - x.mean(0)), atol=1e-8)


def test_ranks_without_holding_the_values(spark, monkeypatch):
    rng = np.random.default_rng(4)
    columns = {
        "spread": rng.normal(0, 1e3, 4000), "wide": rng.choice([-1e300, -1.0, 0.0, 1e-300, 5e-324, 1.0, 1e300], 4000),
        "few": rng.integers(0, 3, 4000).astype(float), "near": 1 + rng.integers(0, 50, 4000) * 2.0**-52,
    }
    rows = [tuple(float(columns[c][i]) if i % 9 else None for c in columns) for i in range(4000)]
    table = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))
    for ranges in (3, 4096):
        monkeypatch.setattr(audit, "RANGES", ranges)
        held = {c: np.sort([r[k] for r in rows if r[k] is not None]) for k, c in enumerate(columns)}
        wanted = {c: [0, 7, 888, 889, 2665, 3000, len(x) - 1] for c, x in held.items()}
        got = audit.exact_ranks(table, wanted if ranges > 3 else {c: wanted[c] for c in ("spread", "few")})
        assert all(held[c][r] == x for (c, r), x in got.items()) and len(got) == (28 if ranges > 3 else 14)
    bounds = {r.column_name: r for r in audit.quantile_bounds(table, ["spread", "few"]).collect()}
    for c, r in bounds.items():
        assert np.allclose([r.q1, r.q3, r.q99], np.quantile(held[c], [0.25, 0.75, 0.99]))
    assert audit.quantile_bounds(table.filter("false"), ["few"]).count() == 0
    with pytest.raises(ValueError):
        audit.quantile_bounds(spark.createDataFrame([(float("nan"),)], "x double"), ["x"])


def test_hundred_thresholds_read_the_weeks_once(spark):
    weekly = prep.weekly_sales(random_daily(spark, products=9, days=120))
    limits = [(i, "S", "CHOCOLATES", float(i), 1 + i % 12) for i in range(100)]
    table = spark.createDataFrame(limits, "threshold_id int, store string, calculation_group string, threshold double, weeks_above_threshold int")
    got = {(r.threshold_id, r["product"]): r.weeks_above_threshold for r in prep._active_products(weekly, table).collect()}
    rows = weekly.collect()
    want = {}
    for i, _, _, limit, needed in limits:
        for name in {r["product"] for r in rows}:
            n = sum(r["product"] == name and r.qty >= limit for r in rows)
            if n >= needed:
                want[i, name] = n
    assert got == want and 0 < len(want) < 900
    plan = prep.keep_active(weekly, table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LocalRelation") + plan.count("LogicalRDD") <= 3


def test_equal_outliers_next_to_each_other(spark):
    rows = [("S", "A", d % 5, 2.0 + d % 2, q) for d, q in enumerate([3, 900, 900, 7, 900, 950, 1, 900, 5, 990] * 3)]
    sales = daily(spark, rows + [("S", "B", 1, 1.0, 999)]).withColumn("qty", F.when(F.col("qty") != 5, F.col("qty")))
    got = prep.cap_outliers(sales, 100.0).toPandas()
    plain = [r for r in rows if r[4] <= 100 and r[4] != 5]
    twins = {r[:4] for r in rows if r[4] > 100}
    a = got[got["product"] == "A"]
    assert len(a) == len(plain) + len(twins) and (a["qty"] <= 7).all() and (a["qty"] == 7).sum() == len(twins) + 3
    assert got[got["product"] == "B"]["qty"].isna().all() and len(got[got["product"] == "B"]) == 1


def test_row_numbers_of_many_equal_keys(spark):
    rows = spark.range(3000).selectExpr("if(id % 10 < 9, 'hot', if(id % 20 = 9, null, 'cold')) as a", "cast(id % 7 as int) as b", "id as c")
    got = ordinal.number_rows(rows, [["a"], ["b"], ["c"]]).toPandas().sort_values("row_id")
    assert got["row_id"].tolist() == list(range(1, 3001))
    key = [(a is None, a or "", b, c) for a, b, c in zip(got["a"], got["b"], got["c"])]
    assert key == sorted(key)
    assert ordinal.number_rows(rows.filter("false"), [["a"], ["b"]]).count() == 0


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scope_mentions_the_category_once_below_the_aggregate(spark):
    """Every mention is worked out again for every raw row, in code too long to be compiled."""
    raw = spark.createDataFrame(
        [("S", "1 - D", "2 - EDIBLE", f"3 - {c}", "i", "p", 1.0, 2.0) for c in ("CHOCOLATES", "HEALTH FOODS")],
        "shop_title string, department_title string, space_title string, category_title string, product_id string, "
        "product_title string, price_sell double, quantity double",
    ).withColumn("transacted_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    scoped = prep.scope(prep.daily_sales(raw))
    filters = [line for line in _optimised(scoped).splitlines() if "Filter" in line and "category_title" in line]
    assert len(filters) == 1 and filters[0].count("locate(-, category_title") <= 1
    assert [r.category for r in scoped.collect()] == ["CHOCOLATES"]


@pytest.mark.parametrize("excluded", [(), ("HEALTH FOODS",), ("EDIBLE",), ("0",), ("A", "HEALTH FOODS")])
def test_scope_is_the_plain_filter_on_groups(spark, excluded):
    rules = config.GroupRules(by_space=("W", "A"), by_category=("A", "B"), by_label={"HEALTH FOODS": ("H", "B", "W"), "A": ("C",)})
    listed = [(s, sp, c) for s in ("S", None) for sp in ("EDIBLE", "OTHER", None) for c in ("W", "A", "B", "C", "H", "Z", None)]
    sales = spark.createDataFrame(listed, "store string, space string, category string")
    for spaces in (("EDIBLE", "BEVERAGES"), None):
        plain = prep.add_calculation_group(sales, rules).filter("store is not null")
        plain = plain.filter(F.col("space").isin(*spaces)) if spaces else plain
        plain = plain.filter(~F.col("calculation_group").isin(*excluded)) if excluded else plain
        got = prep.scope(sales, spaces, rules, excluded)
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def _deal_tables(spark):
    edges = [("deal", f"d{i}", "baseproduct", "b") for i in range(4)] + [("deal", "d9", "baseproduct", None)]
    edges += [("baseproduct", "b", "product", f"p{i}") for i in range(6)] * 2 + [("shop", "s", "product", f"p{i}") for i in range(6)]
    return (
        spark.createDataFrame([("d0", 3.0), ("d1", 3.0), ("d2", 0.0), ("d3", None), ("d9", 1.0), (None, 2.0)], "id string, price double"),
        spark.createDataFrame(edges, "parent_type string, parent_id string, child_type string, child_id string"),
        spark.createDataFrame([("s", "Store"), ("s", "Other")], "id string, title string"),
        spark.createDataFrame([(f"p{i}", f"title {i % 2}", [1.5, 4.0, 0.0][i % 3]) for i in range(6)] + [(None, "none", 1.0)], "id string, title string, unit_price_cost double"),
        spark.createDataFrame([("g", "s")], "group_id string, shop_id string"),
        "g",
    )


def test_deals_meet_distinct_costs_of_base_products(spark):
    """Not every product of a base with every deal of it: both sides are distinct where they meet."""
    found = cost.deal_cost(*_deal_tables(spark))
    lines = [line.strip(" :+-") for line in _optimised(found).splitlines()]
    join = next(i for i, line in enumerate(lines) if line.startswith("Join"))
    assert lines[join + 1].startswith("Aggregate [baseproduct_id")
    want = {(s, t, c) for s in ("Store", "Other") for t in ("title 0", "title 1") for c in (3.0, 0.0, 1.5, 4.0)}
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    lowest = cost.lowest_deal_cost(*_deal_tables(spark)).collect()
    assert sorted(tuple(r) for r in lowest) == sorted({(s, t, 1.5) for s, t, _ in want})
