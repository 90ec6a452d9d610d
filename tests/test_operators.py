"""Operators that SQL can't express, and the guards, against numpy and small tables."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import alpha as al
from fathom.operators import econometrics as ec
from fathom.operators import filters as fl
from fathom.operators import indicators as ta
from fathom.operators import joins as jn
from fathom.operators import languages as lang
from fathom.operators import reshape as rs
from fathom.operators import statistics as st


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = 1 + x @ [2.0, -3.0] + rng.normal(size=200)
    rows = [(i, i % 10, i // 10, float(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(200)]
    return spark.createDataFrame(rows, "id int, entity int, time int, y double, a double, b double").cache(), x, y


def test_least_squares(points):
    df, x, y = points
    m = np.column_stack([np.ones(200), x])
    want, rss, *_ = np.linalg.lstsq(m, y, rcond=None)
    fit = ec.ols(df, "y", ["a", "b"])
    assert fit.beta == pytest.approx(want) and fit.rss == pytest.approx(float(rss[0]))
    cov = np.linalg.inv(m.T @ m) * rss[0] / 197
    assert fit.se == pytest.approx(np.sqrt(np.diag(cov)))
    row = ec.summary(df, "y", ["a", "b"], ["id"]).first()
    e = y - m @ want
    assert row["durbin_watson"] == pytest.approx(np.sum(np.diff(e) ** 2) / np.sum(e**2))
    assert row["r_squared"] == pytest.approx(1 - rss[0] / np.sum((y - y.mean()) ** 2))


def test_breusch_godfrey(points):
    df, x, y = points
    m = np.column_stack([np.ones(200), x])
    e = y - m @ np.linalg.lstsq(m, y, rcond=None)[0]
    aux = np.column_stack([m, np.concatenate(([0], e[:-1]))])
    u = e - aux @ np.linalg.lstsq(aux, e, rcond=None)[0]
    assert ec.breusch_godfrey(df, "y", ["a", "b"], ["id"], 1).first()["lm"] == pytest.approx(200 * (1 - u @ u / (e @ e)))


def test_panel_estimators_find_the_slopes(points):
    df, *_ = points
    moved = df.withColumn("y", F.col("y") + F.col("entity") * 10)
    for fit in (ec.fixed(moved, "entity", "y", ["a", "b"]), ec.random_effects(moved, "entity", "y", ["a", "b"]), ec.first_difference(moved, "entity", "time", "y", ["a", "b"])):
        assert fit.beta[-2:] == pytest.approx([2, -3], abs=0.3)
    rows = {r["variable"]: r for r in ec.fama_macbeth(df, "time", "y", ["a", "b"]).collect()}
    assert rows["a"]["coefficient"] == pytest.approx(2, abs=0.5) and rows["a"]["periods"] == 20


def test_guard_refuses_rather_than_cuts(spark):
    df = spark.range(10)
    assert fl.guarded(df, 10, ["id"]).count() == 10
    with pytest.raises(fl.TooManyRows):
        fl.guarded(df, 9, ["id"])
    with pytest.raises(ValueError):
        fl.guarded(df.where("id > 99"), 9, ["id"])
    with pytest.raises(KeyError):
        fl.project(df, ["nothing"])
    with pytest.raises(ValueError):
        fl.compare("id", "<>", 1)


def test_asof_takes_the_last_at_or_before(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("b", 3, 7)], "k string, id int, t int")
    right = spark.createDataFrame([("a", 5, 1.0), ("a", 9, 2.0), ("a", 10, 3.0), ("b", 8, 4.0)], "k string, t int, v double")
    got = {r["id"]: r["v"] for r in jn.asof(left, right, ["k"], "t", "t", ["v"]).collect()}
    assert got == {1: 3.0, 2: 1.0, 3: None}


def closed(n):
    return [("x", i, float(np.exp(i / 1000))) for i in range(n)]


def test_factors_on_exponential_prices(spark):
    p = spark.createDataFrame(closed(300), "instrument_id string, slot int, price double").withColumns({"session": F.date_add(F.lit("2020-01-01").cast("date"), F.col("slot")), "eligible": F.lit(True), "present": F.lit(True), "known": F.lit(True), "raw_close": F.col("price"), "raw_share_volume": F.lit(10.0), "open": F.col("price")})
    last = {r["factor_id"]: r["value"] for r in al.compute(p).where("slot = 299").collect()}
    for n in (63, 126, 252):
        assert last[f"momentum_{n}_21"] == pytest.approx(np.exp((n - 21) / 1000) - 1)
    assert last["reversal_5"] == pytest.approx(1 - np.exp(0.005))
    assert last["negative_realized_volatility_20"] == pytest.approx(0, abs=1e-9)
    # a later price changes nothing before it
    moved = p.withColumn("price", F.when(F.col("slot") == 299, 5.0).otherwise(F.col("price")))
    before = [tuple(r) for r in al.compute(p).where("slot < 299").orderBy("slot", "factor_id").collect()]
    assert before == [tuple(r) for r in al.compute(moved).where("slot < 299").orderBy("slot", "factor_id").collect()]


def test_ledger_adds_up(spark):
    p = al.synthetic(spark, 6, 80)
    scores = p.where("slot % 10 = 0").select("instrument_id", "session", "slot", F.col("price").alias("score"))
    rows = al.ledger(al.targets(scores, 2), p, cash=1000.0, cost=0.01).orderBy("slot").collect()
    assert len(rows) == 80 and all(r["cash"] >= -1e-6 for r in rows)
    assert rows[0]["equity"] == 1000.0 and rows[1]["fees"] == pytest.approx(0.01 * rows[1]["turnover"] * 1000.0)


def test_indicators_keep_series_apart(spark):
    one = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 1.0 + i, 1.0 + i, 1.0 + i, 1.0 + i, 1) for i in range(99)]
    names = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume bigint"
    alone = spark.createDataFrame(one, names)
    both = alone.unionByName(spark.createDataFrame([("b", r[1], *[500.0 - x for x in r[2:6]], 7) for r in one], names))
    for fn, col in ((ta.rsi, "rsi_14"), (ta.atr, "atr_14"), (ta.sma, "sma_50")):
        a = [r[col] for r in fn(alone).orderBy("ts").collect()]
        assert a == [r[col] for r in fn(both).where("symbol = 'a'").orderBy("ts").collect()]
    assert [r["rsi_14"] for r in ta.rsi(alone).orderBy("ts").collect()][-1] == 100.0


def test_search_syntax():
    assert lang.parse_search('Oil and "crude price"|gas+the+flow!') == [["oil", "crude price"], ["gas", "flow"]]
    assert lang.parse_search("the of") == []
    assert lang.parse_search('gdp with trade to U.S. "Is the " "" (x) | "open end') == [["gdp", "trade", "to", "u.s", "is the ", "x"]]


def test_sets_and_pages(spark):
    a, b = spark.range(5), spark.range(2, 7)
    assert {(r["id"], r["side"]) for r in rs.same_members(a, b).collect()} == {(0, "left"), (1, "left"), (5, "right"), (6, "right")}
    assert rs.same_members(a, a).isEmpty()
    assert [r["id"] for r in rs.page_after(a, "id", 1, 2).collect()] == [2, 3]


@pytest.mark.parametrize("model", ["std", "parkinson", "garman_klass", "hodges_tompkins", "rogers_satchell", "yang_zhang"])
def test_volatility_of_a_zero_price(spark, model):
    """Windows that hold a bar whose low and close are zero are not full; the others have a value."""
    bars = [("a", i, 10.0 + i % 3, 12.0 + i % 3, 0.0 if i == 12 else 9.0 + i % 2, 0.0 if i == 12 else 10.5 + i % 2) for i in range(30)]
    df = spark.createDataFrame(bars, "symbol string, ts int, open double, high double, low double, close double")
    got = {r["ts"]: r[f"vol_{model}"] for r in ta.volatility(df, model, 5).collect()}
    assert len(got) == 30 and got[11] > 0 and got[29] > 0 and got[12] is None and got[16] is None


def test_every_quoted_contract_is_priced_and_solved(spark):
    """Calls as puts, and contracts far from the money; the volatility against a plain bisection."""
    from fathom.operators import pricing as pr
    from fathom.queries import pricing as qp

    d = "/root/testdata/sf0.001"
    quoted = pr.black_scholes(qp.quoted(spark, d)).toPandas().set_index("contract_symbol").sort_index()
    american = qp.QUERIES["american_options"](spark, d).toPandas().set_index("contract_symbol").sort_index()
    assert list(american.index) == list(quoted.index) and set(quoted["option_type"]) == {"call", "put"}
    assert (american["american"] >= quoted["theo"] - 0.5).all()
    got = qp.QUERIES["implied_volatility"](spark, d).toPandas().set_index("contract_symbol").sort_index()["implied_vol"]
    assert list(got.index) == list(quoted.index) and (abs(quoted["strike"] / quoted["spot"] - 1) >= 0.1).any()
    for name, q in quoted.iterrows():
        price = lambda v, q=q: pr.bs_price(*(np.array([x]) for x in (q["spot"], q["strike"], q["years"], q["rate"], q["dividend"], v)), 1.0 if q["option_type"] == "call" else -1.0)[0][0]
        lo, hi = 1e-6, 5.0
        if not (q["theo"] > 0 and price(lo) <= q["theo"] <= price(hi)):
            assert np.isnan(got[name])
            continue
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if price(mid) < q["theo"] else (lo, mid)
        assert price(got[name]) == pytest.approx(q["theo"], abs=1e-6)
        if q["vega"] > 1:
            assert got[name] == pytest.approx(hi, abs=1e-6)


def test_set_equality_sees_late_orders(spark, tmp_path):
    from fathom.queries.reshape import QUERIES

    spark.createDataFrame([(1, 1), (2_000_000, 2), (2_000_001, 9)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1,), (2,), (3,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    assert sorted(tuple(r) for r in QUERIES["set_equality"](spark, str(tmp_path)).collect()) == [(3, "right"), (9, "left")]


def test_dimension_constraints_see_all_events(spark, tmp_path):
    from fathom.queries.languages import QUERIES

    rows = [(2_000, "2024-01-03", 1, "a"), (9_000, "2024-01-04", 1, "b"), (3_000, "2024-01-20", 1, "a"), (100, "2024-01-21", 2, "c")]
    events = spark.createDataFrame(rows, "event_id long, day string, user_id long, event_type string").select("event_id", F.col("day").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    assert [tuple(r) for r in QUERIES["dimension_constraints"](spark, str(tmp_path)).collect()] == [(1, "b")]


def test_growth_after_a_lost_account(spark):
    from fathom.operators import performance as pf

    df = spark.createDataFrame([("a", i, r) for i, r in enumerate([0.1, -1.0, 0.1])] + [("b", 0, 0.5), ("b", 1, None), ("b", 2, -0.5)], "symbol string, date int, ret double")
    path = {(r["symbol"], r["date"]): (r["growth"], r["drawdown"]) for r in pf.drawdown(df, ["symbol"], ["date"], "ret").collect()}
    assert [path["a", i] for i in range(3)] == [(pytest.approx(1.1), 0), (0, -1), (0, -1)]
    assert path["b", 2] == (pytest.approx(0.75), pytest.approx(-0.5))
    metrics = {r["symbol"]: r["max_drawdown"] for r in pf.series_metrics(df, ["symbol"], ["date"], "ret").collect()}
    assert metrics == {"a": -1, "b": pytest.approx(-0.5)}
    nav = {(r["symbol"], r["date"]): r["nav"] for r in pf.nav_history(df, ["symbol"], ["date"], "ret", 75.0).collect()}
    assert nav["a", 0] is None and nav["b", 0] == pytest.approx(150)


def test_exposures_and_chain_statistics(spark):
    """Exposures are cut off towards zero; statistics add them up without their sign, in percent of the whole chain."""
    from fathom.operators import options as op

    names = "underlying string, expiration int, dte int, strike double, option_type string, price double, ask double, delta double, gamma double, open_interest int"
    rows = [("U", 1, 30, 9.0, "call", 10.0, 1.0, 0.7007, 0.01, 1), ("U", 1, 30, 11.0, "put", 10.0, 1.0, -0.7007, 0.019, 1), ("U", 2, 60, 11.0, "call", 10.0, 1.0, 0.3, 0.0, 1), ("U", 2, 60, 12.0, "put", 10.0, 1.0, None, None, 5), ("V", 1, 30, 9.0, "put", 10.0, 1.0, -1.0, 0.0, 3)]
    chain = op.enrich(spark.createDataFrame(rows, names))
    got = {(r["underlying"], r["expiration"], r["strike"]): (r["dex"], r["gex"]) for r in chain.collect()}
    assert got == {("U", 1, 9.0): (700, 1), ("U", 1, 11.0): (-700, -1), ("U", 2, 11.0): (300, 0), ("U", 2, 12.0): (0, 0), ("V", 1, 9.0): (-3000, 0)}
    stat = {(r["underlying"], r["expiration"]): tuple(r)[2:] for r in op.by_group(chain, ["underlying", "expiration"], "dex").collect()}
    assert stat == {("U", 1): (700, 700, 1400, 1.0, 82.3529), ("U", 2): (300, None, 300, None, 17.6471), ("V", 1): (None, 3000, 3000, None, 100.0)}
    otm = {(r["underlying"], r["expiration"]): (r["total"], r["net_percent"]) for r in op.by_group(chain, ["underlying", "expiration"], "dex", moneyness="otm").collect()}
    assert otm == {("U", 2): (300, 17.6471), ("V", 1): (3000, 100.0)}
    near = op.by_group(chain, ["underlying", "strike"], "dex", days=55).collect()
    assert {(r["underlying"], r["strike"], r["net_percent"]) for r in near} == {("U", 11.0, 17.6471), ("V", 9.0, 100.0)}


def test_bitemporal_keeps_equal_rows_and_nulls(spark):
    left = spark.createDataFrame([("a", 5, 5), ("a", 5, 5), (None, 5, 5)], "k string, valid int, decided int")
    right = spark.createDataFrame([("a", 1, 1, 1.0), ("a", 4, 9, 2.0), ("a", 3, 2, None)], "k string, v int, known int, x double")
    got = jn.bitemporal(left, right, ["k"], "valid", "v", "known", "decided", "x").collect()
    assert sorted((r["k"] or "", r["x"]) for r in got if r["k"]) == [("a", None), ("a", None)] and len(got) == 3


def test_bucketed_asof_keeps_a_null_value(spark):
    day = lambda d, h: dt.datetime(2024, 1, d, h)
    left = spark.createDataFrame([("a", 1, day(1, 9)), ("a", 2, day(2, 9)), ("a", 3, day(2, 1)), ("b", 4, day(2, 1))], "k string, id int, t timestamp_ntz")
    right = spark.createDataFrame([("a", day(1, 8), 5.0), ("a", day(2, 8), None)], "k string, t timestamp_ntz, v double")
    want = {r["id"]: r["v"] for r in jn.asof(left, right, ["k"], "t", "t", ["v"]).collect()}
    assert {r["id"]: r["v"] for r in jn.asof_bucketed(left, right, ["k"], "t", "t", ["v"]).collect()} == want == {1: 5.0, 2: None, 3: 5.0, 4: None}


def test_deep_trees_and_loops(spark):
    rows = [(i, i - 1 if i else None, f"t{i}") for i in range(12)] + [(50, 51, "x"), (51, 50, "y"), (3, 11, "again")]
    got = lang.ordered_tree(spark.createDataFrame(rows, "id int, parent int, title string"), "id", "parent", "title").collect()
    assert sorted((r["id"], r["level"]) for r in got) == [(i, i) for i in range(12)]
    assert max(got, key=lambda r: r["level"])["path"] == " / ".join(f"t{i}" for i in range(12))


def test_texts_reach_only_what_they_may(spark):
    df = spark.createDataFrame([(1, 2, "a"), (5, 6, "b")], "x int, dfx int, s string")
    assert [r["x"] for r in lang.where_text(df, "x + dfx > 4 AND upper(s) LIKE 'B%' AND x BETWEEN 1 AND 9 AND s IN ('a', 'b')").collect()] == [5]
    assert [tuple(r) for r in lang.over_view(df, "SELECT dfx, count(*) AS n FROM df WHERE x > 1 GROUP BY dfx HAVING count(*) > 0 ORDER BY dfx LIMIT 3").collect()] == [(6, 1)]
    for text in ("reflect('java.lang.System', 'getProperty', 'user.home') = ''", "java_method('java.lang.System', 'nanoTime') > 0", "x IN (SELECT 1)", "EXISTS (SELECT 1)", "input_file_name() = ''", "coalesce(reflect('a', 'b'), 'x') = 'x'"):
        with pytest.raises(lang.Refused):
            lang.where_text(df, text)
    for sql in ("SELECT * FROM parquet.`/etc`", "SELECT * FROM other", "SELECT reflect('a', 'b') FROM df", "SELECT * FROM range(3)", "DROP TABLE df", "SELECT x FROM df WHERE x IN (SELECT x FROM other)", "SELECT x FROM df UNION SELECT 1"):
        with pytest.raises(lang.Refused):
            lang.over_view(df, sql)


def test_reports_drop_zero_columns(spark):
    df = spark.createDataFrame([(1, 0, None, 5.0, "a"), (2, None, 0.0, 6.0, "b")], "date int, none int, zero double, pct double, name string")
    got = lang.positions_report(df, {}, ["pct", "zero"], "date", 1)
    assert got.columns == ["date", "pct", "name"] and [tuple(r) for r in got.collect()] == [(2, 0.06, "b")]


def test_last_of_a_series_has_one_answer_on_ties(spark):
    df = spark.createDataFrame([("a", 1, v) for v in (3, 1, 2)], "s string, t int, v int")
    assert [r["v"] for r in lang.dimensions(df, ["s"], "a", "t", last=1).collect()] == [1]


def test_neighbours_across_blocks(spark):
    """Residual tests in blocks give what one sorted window gives."""
    from fathom.functions import blocks

    rng = np.random.default_rng(3)
    values = rng.normal(size=500)
    df = spark.createDataFrame([(i // 7, i % 7, float(v)) for i, v in enumerate(values)], "a int, b int, v double").repartition(5)
    got = blocks.lagged(df, [], ["a", "b"], F.col("v"), 2, rows=30).orderBy("a", "b").collect()
    assert [r["_l1"] for r in got] == [None, *values[:-1].tolist()] and [r["_l2"] for r in got] == [None, None, *values[:-2].tolist()]


def test_tau_b_counts_as_all_pairs_do():
    rng = np.random.default_rng(3)
    for n in (2, 3, 17, 60):
        x, y = rng.integers(0, 7, n).astype(float), rng.integers(0, 5, n).astype(float)
        i, j = np.triu_indices(n, 1)
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        below = np.sqrt(np.abs(a).sum() * np.abs(b).sum())
        assert st.tau_b(x, y) == pytest.approx((a * b).sum() / below if below else np.nan, nan_ok=True)


def test_evaluation_coverage_and_its_bound(spark):
    f = spark.createDataFrame([("A", 1, "f", True, 1.0, None), ("B", 1, "f", True, None, "warmup"), ("C", 1, "f", True, None, "missing_value"), ("D", 1, "f", False, 2.0, None), ("E", 1, "f", True, 2.0, None)], "instrument_id string, session int, factor_id string, eligible boolean, value double, null_reason string")
    lab = spark.createDataFrame([(i, 1, 5, 0.1, None) for i in "ABCD"], "instrument_id string, session int, horizon int, value double, null_reason string")
    found = al.evaluation_coverage(f, lab)
    row = found.first()
    assert (row.input_rows, row.joined_rows, row.used_rows, row.unexpected_loss) == (5, 4, 1, 2)
    assert row.reasons == {"used": 1, "factor:warmup": 1, "factor:missing_value": 1, "ineligible": 1, "missing_join": 1}
    assert al.within_loss(found, 0.7).count() == 1
    with pytest.raises(Exception, match="unexpected evaluation loss for f/5"):
        al.within_loss(found, 0.5).collect()


def test_a_constant_cross_section_has_no_correlation(spark):
    both = spark.createDataFrame([(1, "f", 5, float(i), 0.5) for i in range(4)] + [(2, "f", 5, float(i), i * 2.0) for i in range(4)], "session int, factor_id string, horizon int, factor double, label double")
    row = al.information(both).first()
    assert (row.ic_mean, row.sessions) == (pytest.approx(1.0), 1)
