"""Cross-sectional research on a panel of brands by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.windows import ordered, so_far
from fathom.operators import alpha as al
from fathom.session import scratch

from .base import Registry, r, rounded, table

query = Registry()


def panel(spark, d):
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    rows = li.join(p, li.l_partkey == p.p_partkey).select(F.col("p_brand").alias("instrument_id"), F.to_date("l_shipdate").alias("session"), "l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    first = F.min_by("l_extendedprice", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    bars = rows.groupBy("instrument_id", "session").agg(F.avg("l_extendedprice").alias("price"), F.avg("l_extendedprice").alias("raw_close"), (F.sum("l_quantity") - 50).alias("raw_share_volume"), first.alias("open"))
    bars = bars.withColumn("known", F.dayofmonth("session") != 13)
    reg = al.register(bars, bars.select("session"))
    return reg.withColumn("eligible", ~((F.col("instrument_id") == "Brand#11") & (F.col("slot") < 300)))


PANEL = """b AS (SELECT p_brand AS instrument_id, CAST(l_shipdate AS DATE) AS session, avg(l_extendedprice) AS price, avg(l_extendedprice) AS raw_close, sum(l_quantity) - 50 AS vol,
        first(l_extendedprice ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS open, dayofmonth(CAST(l_shipdate AS DATE)) <> 13 AS known FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 7),
    cal AS (SELECT session, row_number() OVER (ORDER BY session) - 1 AS slot FROM (SELECT DISTINCT session FROM b)),
    p AS (SELECT i.instrument_id, session, slot, NOT (i.instrument_id = 'Brand#11' AND slot < 300) AS eligible, price IS NOT NULL AS present, coalesce(known, false) AS known, price, raw_close, vol, open
        FROM (SELECT DISTINCT instrument_id FROM b) i CROSS JOIN cal LEFT JOIN b USING (instrument_id, session))"""


@query(f"WITH {PANEL} SELECT instrument_id, session, CAST(slot AS INT) AS slot, eligible, present, known, {r('price')}, {r('open')} FROM p")
def panel_register(spark, d):
    return rounded(panel(spark, d).select("instrument_id", "session", "slot", "eligible", "present", "known", "price", "open"))


def within(flag: str, old: int, new: int) -> str:
    return f"coalesce(max(CAST({flag} AS INT)) OVER (PARTITION BY instrument_id ORDER BY slot ROWS BETWEEN {old} PRECEDING AND {new} PRECEDING), 0) > 0"


def factor_sql(name: str) -> str:
    old, new = al.FACTORS[name]
    w, dollar = "(PARTITION BY instrument_id ORDER BY slot)", name.startswith("log")
    value = {
        "reversal_5": f"-(price / lag(price, 5) OVER {w} - 1)",
        "negative_realized_volatility_20": "-stddev_samp(ret) OVER (PARTITION BY instrument_id ORDER BY slot ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
        "log_dollar_volume_20": "CASE WHEN avg(n) OVER (PARTITION BY instrument_id ORDER BY slot ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) > 0 THEN ln(avg(n) OVER (PARTITION BY instrument_id ORDER BY slot ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) END",
    }.get(name, f"lag(price, {new}) OVER {w} / lag(price, {old}) OVER {w} - 1")
    null = "(raw_close IS NULL OR vol IS NULL)" if dollar else "(price IS NULL)"
    bad = "coalesce(raw_close < 0 OR vol < 0, false)" if dollar else "coalesce(price <= 0, false)"
    notional = f"WHEN {within('coalesce(n <= 0, false)', old, new)} THEN 'nonpositive_notional'" if dollar else ""
    return f"""SELECT instrument_id, session, slot, eligible, '{name}' AS factor_id, CASE WHEN NOT eligible THEN 'ineligible' WHEN slot < {old} THEN 'warmup' WHEN {within("(NOT present)", old, new)} THEN 'missing_session'
        WHEN {within("(present AND NOT known)", old, new)} THEN 'unavailable_at_close' WHEN {within(null, old, new)} THEN 'missing_value' WHEN {within(bad, old, new)} THEN 'invalid_value' {notional} WHEN {value} IS NULL THEN 'nonfinite_result' END AS null_reason, {value} AS v FROM q"""


FACTORS = f"{PANEL}, q AS (SELECT *, price / lag(price) OVER (PARTITION BY instrument_id ORDER BY slot) - 1 AS ret, raw_close * vol AS n FROM p), fa AS ({' UNION ALL '.join(map(factor_sql, al.FACTORS))}), f AS (SELECT * REPLACE (CASE WHEN null_reason IS NULL THEN v END AS v) FROM fa)"


@query(f"WITH {FACTORS} SELECT instrument_id, session, factor_id, eligible, null_reason, {r('v', 'value')} FROM f")
def factors(spark, d):
    return rounded(al.compute(panel(spark, d)).select("instrument_id", "session", "factor_id", "eligible", "null_reason", "value"))


@query(f"WITH {FACTORS} SELECT factor_id, coalesce(null_reason, 'valid') AS reason, count(*) AS n FROM f GROUP BY 1, 2")
def factor_coverage(spark, d):
    return al.coverage(al.compute(panel(spark, d)))


RANKS = f"""{FACTORS}, c AS (SELECT *, count(v) OVER (PARTITION BY session, factor_id) AS n, rank() OVER (PARTITION BY session, factor_id ORDER BY v NULLS LAST) + (count(*) OVER (PARTITION BY session, factor_id, v) - 1) / 2 AS rk FROM f)"""


@query(f"WITH {RANKS} SELECT instrument_id, session, factor_id, round(CASE WHEN n >= 2 AND v IS NOT NULL THEN (rk - 1) / (n - 1) - 0.5 END, 6) + 0.0 AS rank_value, CASE WHEN v IS NULL THEN null_reason WHEN n < 2 THEN 'cross_section_too_small' END AS rank_null_reason FROM c")
def factor_ranks(spark, d):
    return rounded(al.ranked(al.compute(panel(spark, d))).select("instrument_id", "session", "factor_id", "rank_value", "rank_null_reason"))


def label_sql(h: int) -> str:
    w = "(PARTITION BY instrument_id ORDER BY slot)"
    e, x = f"lead(open, 1) OVER {w}", f"lead(open, {1 + h}) OVER {w}"
    return f"""SELECT instrument_id, session, slot, {h} AS horizon, {e} AS e, {x} AS x, CASE WHEN NOT eligible THEN 'ineligible' WHEN lead(1, {1 + h}) OVER {w} IS NULL THEN 'sample_tail'
        WHEN NOT (lead(present, 1) OVER {w} AND lead(present, {1 + h}) OVER {w}) OR {e} IS NULL OR {x} IS NULL THEN 'missing_endpoint' WHEN {e} <= 0 OR {x} <= 0 THEN 'invalid_endpoint' END AS null_reason FROM p"""


LABELS = f"l AS (SELECT *, CASE WHEN null_reason IS NULL THEN x / e - 1 END AS v FROM ({' UNION ALL '.join(map(label_sql, al.HORIZONS))}))"


@query(f"WITH {PANEL}, {LABELS} SELECT instrument_id, session, horizon, {r('v', 'value')}, null_reason FROM l")
def forward_labels(spark, d):
    return rounded(al.labels(panel(spark, d)).select("instrument_id", "session", "horizon", "value", "null_reason"))


def dense(spark, d):
    """The panel with the last price and open carried on, as of a stock that doesn't trade on a day; there is no hole after the first.

    Written once, as factors, labels and portfolios each read it."""
    w = ordered(al.KEY, al.AT)
    carried = {c: F.last(c, ignorenulls=True).over(so_far(w)) for c in ("price", "raw_close", "open")}
    carried["price"] = F.round(carried["price"], 6)
    p = panel(spark, d).withColumns(carried | {"raw_share_volume": F.coalesce("raw_share_volume", F.lit(0)) + 100.0})
    path = scratch(spark, "panel")
    p.withColumns({"present": F.col("price").isNotNull(), "known": F.col("price").isNotNull()}).write.parquet(path)
    return spark.read.parquet(path)


CARRIED = "(PARTITION BY instrument_id ORDER BY slot ROWS UNBOUNDED PRECEDING)"
DENSE = f"""{PANEL.replace("    p AS (", "    p0 AS (", 1)}, p1 AS (SELECT instrument_id, session, slot, eligible, round(last_value(price IGNORE NULLS) OVER {CARRIED}, 6) AS price, last_value(raw_close IGNORE NULLS) OVER {CARRIED} AS raw_close, coalesce(vol, 0) + 100.0 AS vol,
    last_value(open IGNORE NULLS) OVER {CARRIED} AS open FROM p0), p AS (SELECT *, price IS NOT NULL AS present, price IS NOT NULL AS known FROM p1)"""
DENSE_FACTORS = f"{DENSE}{FACTORS.removeprefix(PANEL)}"
PAIRED = f"""{DENSE_FACTORS}, {LABELS}, pr AS (SELECT f.instrument_id, f.session, f.slot, factor_id, horizon, f.v AS factor, l.v AS label FROM f JOIN l USING (instrument_id, session) WHERE f.v IS NOT NULL AND l.v IS NOT NULL)"""
QUANTILED = f"""{PAIRED}, e AS (SELECT *, quantile_cont(factor, [0.2, 0.4, 0.6, 0.8]) OVER (PARTITION BY session, factor_id, horizon) AS e FROM pr),
    qt AS (SELECT *, CASE WHEN len(list_distinct(e)) = 4 THEN len(list_filter(e, lambda x: x < factor)) + 1 END AS quantile FROM e)"""


def both(spark, d):
    p = dense(spark, d)
    return al.paired(al.compute(p), al.labels(p))


@query()
def synthetic_panel(spark, d):
    return al.synthetic(spark)


def averaged(value: str) -> str:
    """Average rank in SQL."""
    part = "PARTITION BY session, factor_id, horizon"
    return f"rank() OVER ({part} ORDER BY {value}) + (count(*) OVER ({part}, {value}) - 1) / 2"


@query(f"""WITH {PAIRED}, k AS (SELECT session, factor_id, horizon, {averaged("factor")} AS a, {averaged("label")} AS c FROM pr), d AS (SELECT session, factor_id, horizon, corr(a, c) AS ic FROM k GROUP BY 1, 2, 3), g AS (SELECT * FROM d WHERE ic IS NOT NULL AND NOT isnan(ic))
    SELECT factor_id, horizon, {r("avg(ic)", "ic_mean")}, {r("stddev_samp(ic)", "ic_std")}, count(*) AS sessions, {r("avg(ic) / nullif(stddev_samp(ic), 0)", "ic_ratio")} FROM g GROUP BY 1, 2""")
def information_coefficient(spark, d):
    return rounded(al.information(both(spark, d)))


@query(f"""WITH {QUANTILED}, m AS (SELECT session, factor_id, horizon, quantile, avg(label) AS m FROM qt WHERE quantile IS NOT NULL GROUP BY 1, 2, 3, 4)
    SELECT factor_id, horizon, {", ".join(r(f"avg(m) FILTER (WHERE quantile = {i})", f"q{i}") for i in range(1, 6))}, {r("avg(m) FILTER (WHERE quantile = 5) - avg(m) FILTER (WHERE quantile = 1)", "spread")} FROM m GROUP BY 1, 2""")
def quantile_returns(spark, d):
    return rounded(al.quantile_returns(both(spark, d)))


@query(f"""WITH {QUANTILED}, t AS (SELECT factor_id, horizon, slot, instrument_id FROM qt WHERE quantile = 5), s AS (SELECT factor_id, horizon, min(slot) AS s FROM t GROUP BY 1, 2),
    d AS (SELECT t.factor_id, t.horizon, t.slot, avg(CASE WHEN o.slot IS NULL THEN 1.0 ELSE 0.0 END) AS t FROM t LEFT JOIN t o ON o.factor_id = t.factor_id AND o.horizon = t.horizon AND o.instrument_id = t.instrument_id AND o.slot + 1 = t.slot
        JOIN s ON s.factor_id = t.factor_id AND s.horizon = t.horizon WHERE t.slot > s.s GROUP BY 1, 2, 3)
    SELECT factor_id, horizon, {r("avg(t)", "turnover")} FROM d GROUP BY 1, 2""")
def quantile_turnover(spark, d):
    return rounded(al.turnover(both(spark, d)))


DENSE_RANKS = f"{DENSE}{RANKS.removeprefix(PANEL)}"


@query(f"""WITH {DENSE_RANKS}, k AS (SELECT instrument_id, slot, factor_id, (rk - 1) / (n - 1) - 0.5 AS x FROM c WHERE n >= 2 AND v IS NOT NULL), d AS (SELECT a.factor_id, a.slot, corr(a.x, o.x) AS c FROM k a JOIN k o ON a.factor_id = o.factor_id AND a.instrument_id = o.instrument_id AND a.slot = o.slot + 1 GROUP BY 1, 2)
    SELECT factor_id, {r("avg(c)", "autocorrelation")}, count(*) AS sessions FROM d WHERE c IS NOT NULL AND NOT isnan(c) GROUP BY 1""")
def rank_autocorrelation(spark, d):
    return rounded(al.rank_autocorrelation(al.ranked(al.compute(dense(spark, d)))))


@query(f"""WITH {DENSE_FACTORS}, {LABELS}, j AS (SELECT f.factor_id, l.horizon, CASE WHEN NOT f.eligible THEN 'ineligible' WHEN f.v IS NULL THEN 'factor:' || f.null_reason WHEN l.v IS NULL THEN 'label:' || l.null_reason ELSE 'used' END AS reason FROM f JOIN l USING (instrument_id, session)),
    c AS (SELECT factor_id, horizon, count(*) AS input_rows, count(*) FILTER (WHERE reason = 'used') AS used_rows, count(*) FILTER (WHERE reason NOT IN ('used', 'ineligible', 'factor:warmup', 'label:sample_tail')) AS unexpected_loss FROM j GROUP BY 1, 2)
    SELECT factor_id, horizon, input_rows, input_rows AS joined_rows, used_rows, unexpected_loss, {r("unexpected_loss / greatest(1, used_rows + unexpected_loss)", "loss_part")} FROM c""")
def evaluation_coverage(spark, d):
    p = dense(spark, d)
    return rounded(al.evaluation_coverage(al.compute(p), al.labels(p)).drop("reasons"))


@query()
def ridge_predictions(spark, d):
    p = dense(spark, d)
    wide = al.compute(p).groupBy("instrument_id", "session", "slot").pivot("factor_id", list(al.FACTORS)).agg(F.first("value"))
    lab = al.labels(p, [5]).select("instrument_id", "session", F.col("value").alias("label"))
    names = ["momentum_63_21", "reversal_5", "negative_realized_volatility_20"]
    return al.ridge(wide.join(lab, ["instrument_id", "session"]), names, "label", "slot", 1000, 6).select("instrument_id", "session", "prediction")


@query()
def backtest(spark, d):
    p = dense(spark, d)
    scores = al.ranked(al.compute(p)).where("factor_id = 'momentum_63_21' AND slot % 20 = 0").select("instrument_id", "session", "slot", F.col("rank_value").alias("score"))
    return al.ledger(al.targets(scores, 4), p)


@query("""WITH s AS (SELECT CAST(o_orderdate AS DATE) AS session, 'C' || o_custkey AS instrument_id, o_custkey, sum(o_totalprice) AS score FROM orders GROUP BY 1, 2, 3) SELECT session, instrument_id, round(1.0 / 3, 6) AS weight FROM s QUALIFY row_number() OVER (PARTITION BY session ORDER BY score DESC, instrument_id) <= 3""")
def top_k_targets(spark, d):
    s = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("session"), F.concat(F.lit("C"), "o_custkey").alias("instrument_id")).agg(F.sum("o_totalprice").alias("score")).withColumn("slot", F.lit(0))
    return rounded(al.targets(s, 3).select("session", "instrument_id", "weight"))


QUERIES, SQL = query.queries, query.sql
