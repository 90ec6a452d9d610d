"""Cross-sectional research: complete panel, fixed factors with reasons, labels, evaluation, ridge, backtest.

A panel has ``instrument_id``, ``session``, ``slot`` (its number in the calendar), ``eligible``,
``present``, ``known``, ``price``, ``raw_close``, ``raw_share_volume`` and ``open``. A row tells nothing of
its future: every window ends at the row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.windows import ordered
from fathom.operators.joins import complete_grid
from fathom.operators.statistics import average_rank, correlation

KEY, AT = ["instrument_id"], ["slot"]
#: factor -> (oldest row looked at, newest row looked at), in rows before the present one.
FACTORS = {"momentum_63_21": (63, 21), "momentum_126_21": (126, 21), "momentum_252_21": (252, 21), "reversal_5": (5, 0), "negative_realized_volatility_20": (20, 0), "log_dollar_volume_20": (19, 0)}
HORIZONS = (1, 5, 20)


def register(bars: DataFrame, calendar: DataFrame, eligible: Column | None = None) -> DataFrame:
    """The full instrument by session grid of some bars; missing bars are rows that are not present."""
    numbered = calendar.select("session").distinct().withColumn("slot", F.row_number().over(Window.orderBy("session")) - 1)
    grid = complete_grid(numbered, bars.select("instrument_id").distinct(), bars, ["instrument_id", "session"])
    known = F.coalesce(F.col("known"), F.lit(False)) if "known" in grid.columns else F.col("present")
    return grid.withColumns({"known": known, "eligible": F.lit(True) if eligible is None else eligible})


def synthetic(spark, instruments: int = 10, sessions: int = 320, start: str = "2020-01-01") -> DataFrame:
    """A weekday panel made by expressions alone: the same on every run and partition."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_add(F.lit(start).cast("date"), sessions * 2))).alias("session")).where(F.weekday("session") < 5)
    days = days.withColumn("slot", F.row_number().over(Window.orderBy("session")) - 1).where(F.col("slot") < sessions)
    names = spark.range(instruments).select(F.format_string("I%03d", "id").alias("instrument_id"), F.col("id").alias("k"))
    noise = (F.pmod(F.xxhash64("k", "slot"), F.lit(2001)) - 1000) / 100000.0
    grid = names.crossJoin(days).withColumn("ret", noise + F.sin(F.col("slot") / (5.0 + F.col("k"))) / 100)
    price = 50 * F.exp(F.sum("ret").over(ordered(KEY, AT).rowsBetween(Window.unboundedPreceding, 0)))
    out = grid.withColumn("price", price)
    return out.select("instrument_id", "session", "slot", F.lit(True).alias("eligible"), F.lit(True).alias("present"), F.lit(True).alias("known"), "price", F.col("price").alias("raw_close"), F.when(F.col("slot") % 43 == 42, 0.0).otherwise(1000.0 + F.col("k") * 10).alias("raw_share_volume"), (F.col("price") * 0.999).alias("open"))


def _within(flag: Column, old: int, new: int) -> Column:
    return F.coalesce(F.max(flag.cast("int")).over(ordered(KEY, AT).rowsBetween(-old, -new)), F.lit(0)) > 0


def compute(panel: DataFrame) -> DataFrame:
    """One row per panel row and factor: ``value`` or ``null_reason``, the first that holds of ineligible,
    warmup, missing_session, unavailable_at_close, missing_value, invalid_value, nonpositive_notional, nonfinite_result."""
    w = ordered(KEY, AT)
    price, notional = F.col("price"), F.col("raw_close") * F.col("raw_share_volume")
    df = panel.withColumns({"_ret": price / F.lag(price).over(w) - 1, "_n": notional, "_row": F.row_number().over(w) - 1})

    def frame(n: int):
        return w.rowsBetween(-(n - 1), 0)

    values = {name: F.lag(price, new).over(w) / F.lag(price, old).over(w) - 1 for name, (old, new) in FACTORS.items() if name.startswith("momentum")}
    values["reversal_5"] = -(price / F.lag(price, 5).over(w) - 1)
    values["negative_realized_volatility_20"] = -F.stddev_samp("_ret").over(frame(20))
    values["log_dollar_volume_20"] = F.ln(F.avg("_n").over(frame(20)))
    every = []
    for name, (old, new) in FACTORS.items():
        dollar = name.startswith("log")
        need = [F.col("raw_close"), F.col("raw_share_volume")] if dollar else [price]
        null, bad = F.lit(False), F.lit(False)
        for c in need:
            null, bad = null | c.isNull(), bad | F.isnan(c) | (c < 0) | ((c == 0) if not dollar else F.lit(False))
        value = values[name]
        reason = (
            F.when(~F.col("eligible"), "ineligible")
            .when(F.col("_row") < old, "warmup")
            .when(_within(~F.col("present"), old, new), "missing_session")
            .when(_within(F.col("present") & ~F.col("known"), old, new), "unavailable_at_close")
            .when(_within(null, old, new), "missing_value")
            .when(_within(F.coalesce(bad, F.lit(False)), old, new), "invalid_value")
        )
        if dollar:
            reason = reason.when(_within(F.col("_n") <= 0, old, new), "nonpositive_notional")
        reason = reason.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), "nonfinite_result")
        every.append(F.struct(F.lit(name).alias("factor_id"), reason.alias("null_reason"), value.alias("value")))
    rows = df.withColumn("_all", F.array(*every)).select("instrument_id", "session", "slot", "eligible", F.inline("_all"))
    return rows.withColumn("value", F.when(F.col("null_reason").isNull(), F.col("value")))


def ranked(factors: DataFrame, least: int = 2) -> DataFrame:
    """Adds the centred average rank of each session and factor."""
    part = Window.partitionBy("session", "factor_id")
    n = F.count("value").over(part)
    rank = F.when((n >= least) & F.col("value").isNotNull(), (average_rank(F.col("value"), part) - 1) / (n - 1) - 0.5)
    return factors.withColumns({"rank_value": rank, "rank_null_reason": F.when(F.col("value").isNull(), F.col("null_reason")).when(n < least, "cross_section_too_small")})


def labels(panel: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Return from the next open to the open ``horizon`` sessions after it; reasons ineligible, sample_tail, missing_endpoint, invalid_endpoint."""
    w = ordered(KEY, AT)

    def one(h: int) -> Column:
        entry, leave = F.lead("open", 1).over(w), F.lead("open", 1 + h).over(w)
        there = F.lead("present", 1).over(w) & F.lead("present", 1 + h).over(w)
        reason = F.when(~F.col("eligible"), "ineligible").when(F.lead(F.lit(1), 1 + h).over(w).isNull(), "sample_tail").when(~there | entry.isNull() | leave.isNull(), "missing_endpoint").when((entry <= 0) | (leave <= 0), "invalid_endpoint")
        return F.struct(F.lit(h).alias("horizon"), F.when(reason.isNull(), leave / entry - 1).alias("value"), reason.alias("null_reason"), F.lead("session", 1).over(w).alias("entry_session"), F.lead("session", 1 + h).over(w).alias("exit_session"))

    return panel.withColumn("_all", F.array(*map(one, horizons))).select("instrument_id", "session", "slot", F.inline("_all"))


def paired(factors: DataFrame, lab: DataFrame) -> DataFrame:
    """Factor and label values of the same instrument and session, both known."""
    f = factors.where("value IS NOT NULL").select("instrument_id", "session", "slot", "factor_id", F.col("value").alias("factor"))
    return f.join(lab.where("value IS NOT NULL").select("instrument_id", "session", "horizon", F.col("value").alias("label")), ["instrument_id", "session"])


def information(both: DataFrame) -> DataFrame:
    """Per factor and horizon: mean, deviation and number of the daily rank correlations."""
    part = Window.partitionBy("session", "factor_id", "horizon")
    ranks = both.select("session", "factor_id", "horizon", average_rank(F.col("factor"), part).alias("a"), average_rank(F.col("label"), part).alias("b"))
    daily = ranks.groupBy("session", "factor_id", "horizon").agg(correlation("a", "b").alias("ic")).where("ic IS NOT NULL AND NOT isnan(ic)")
    return daily.groupBy("factor_id", "horizon").agg(F.avg("ic").alias("ic_mean"), F.stddev_samp("ic").alias("ic_std"), F.count("*").alias("sessions")).withColumn("ic_ratio", F.try_divide("ic_mean", "ic_std"))


def quantiles(both: DataFrame, q: int = 5) -> DataFrame:
    """Adds ``quantile`` 1..q of the factor in its session, by interpolated edges; null where edges coincide."""
    part = Window.partitionBy("session", "factor_id", "horizon")
    edges = F.percentile("factor", [i / q for i in range(1, q)]).over(part)
    df = both.withColumn("_e", edges)
    place = F.size(F.filter("_e", lambda e: e < F.col("factor"))) + 1
    return df.withColumn("quantile", F.when(F.size(F.array_distinct("_e")) == q - 1, place)).drop("_e")


def quantile_returns(both: DataFrame, q: int = 5) -> DataFrame:
    """Mean label of each quantile, averaged over sessions, and the spread of the ends."""
    day = quantiles(both, q).where("quantile IS NOT NULL").groupBy("session", "factor_id", "horizon", "quantile").agg(F.avg("label").alias("m"))
    top, low = F.avg(F.when(F.col("quantile") == q, F.col("m"))), F.avg(F.when(F.col("quantile") == 1, F.col("m")))
    return day.groupBy("factor_id", "horizon").agg(*(F.avg(F.when(F.col("quantile") == i, F.col("m"))).alias(f"q{i}") for i in range(1, q + 1)), (top - low).alias("spread"))


def turnover(both: DataFrame, q: int = 5) -> DataFrame:
    """Mean part of the top quantile that was not in it the session before, per factor and horizon."""
    top = quantiles(both, q).where(F.col("quantile") == q).select("factor_id", "horizon", "slot", "instrument_id")
    before = top.select("factor_id", "horizon", (F.col("slot") + 1).alias("slot"), "instrument_id", F.lit(1).alias("held"))
    first = top.groupBy("factor_id", "horizon").agg(F.min("slot").alias("first"))
    met = top.join(before, ["factor_id", "horizon", "slot", "instrument_id"], "left").join(first, ["factor_id", "horizon"]).where("slot > first")
    day = met.groupBy("factor_id", "horizon", "slot").agg(F.avg(F.when(F.col("held").isNull(), 1.0).otherwise(0.0)).alias("t"))
    return day.groupBy("factor_id", "horizon").agg(F.avg("t").alias("turnover"))


def rank_autocorrelation(ranks: DataFrame, lag: int = 1) -> DataFrame:
    """Correlation of an instrument's rank with that ``lag`` sessions before, averaged over sessions."""
    a = ranks.where("rank_value IS NOT NULL").select("factor_id", "instrument_id", "slot", "rank_value")
    b = a.select("factor_id", "instrument_id", (F.col("slot") + lag).alias("slot"), F.col("rank_value").alias("before"))
    day = a.join(b, ["factor_id", "instrument_id", "slot"]).groupBy("factor_id", "slot").agg(correlation("rank_value", "before").alias("c"))
    return day.where("c IS NOT NULL AND NOT isnan(c)").groupBy("factor_id").agg(F.avg("c").alias("autocorrelation"), F.count("*").alias("sessions"))


#: Reasons for which a row is expected to be missing from an evaluation.
EXPECTED = ("used", "ineligible", "factor:warmup", "label:sample_tail")


def evaluation_coverage(factors: DataFrame, lab: DataFrame) -> DataFrame:
    """Per factor and horizon: rows in, joined and used, rows lost for a reason that is not expected, their part of what could be used, and the number of each reason.

    A row counts for the first of: no label row, ineligible, no factor value, no label value. Keys of labels must be unique.
    """
    keys = ["instrument_id", "session", "horizon"]
    horizons = lab.select("horizon").distinct()
    f = factors.select("instrument_id", "session", "factor_id", "eligible", F.col("value").alias("f"), F.col("null_reason").alias("f_reason"))
    l = lab.select(*keys, F.col("value").alias("l"), F.col("null_reason").alias("l_reason"), F.lit(True).alias("met"))
    met = f.crossJoin(F.broadcast(horizons)).join(l, keys, "left")  # horizons are a study's few
    reason = (
        F.when(F.col("met").isNull(), "missing_join")
        .when(~F.col("eligible"), "ineligible")
        .when(F.col("f").isNull(), F.concat(F.lit("factor:"), F.coalesce("f_reason", F.lit("unknown_null"))))
        .when(F.col("l").isNull(), F.concat(F.lit("label:"), F.coalesce("l_reason", F.lit("missing_join"))))
        .otherwise("used")
    )
    each = met.groupBy("factor_id", "horizon", reason.alias("reason")).agg(F.count("*").alias("n"), F.count("met").alias("joined"))
    lost = F.sum(F.when(~F.col("reason").isin(*EXPECTED), F.col("n")).otherwise(0))
    used = F.sum(F.when(F.col("reason") == "used", F.col("n")).otherwise(0))
    out = each.groupBy("factor_id", "horizon").agg(F.sum("n").alias("input_rows"), F.sum("joined").alias("joined_rows"), used.alias("used_rows"), lost.alias("unexpected_loss"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("reason", "n")))).alias("reasons"))
    return out.withColumn("loss_part", F.col("unexpected_loss") / F.greatest(F.lit(1), F.col("used_rows") + F.col("unexpected_loss")))


def within_loss(found: DataFrame, most: float) -> DataFrame:
    """The same coverage; reading a row whose unexpected loss is above ``most`` fails with its reasons."""
    text = F.concat(F.lit("unexpected evaluation loss for "), F.col("factor_id"), F.lit("/"), F.col("horizon").cast("string"), F.lit(": "), F.to_json("reasons"))
    return found.withColumn("loss_part", F.when(F.col("loss_part") > most, F.raise_error(text).cast("double")).otherwise(F.col("loss_part")))


def coverage(factors: DataFrame) -> DataFrame:
    return factors.groupBy("factor_id", F.coalesce("null_reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


def ridge(wide: DataFrame, features: Sequence[str], label: str, slot: str, split: int, purge: int, penalty: float = 1.0) -> DataFrame:
    """Predictions after ``split`` of a ridge regression on rows that end ``purge`` slots before it, features standardised on those rows.

    Means, deviations and the Gram matrix are two aggregations; k by k numbers come to the driver.
    """
    fit = wide.where(F.col(slot) < split - purge).na.drop(subset=[*features, label])
    s = fit.agg(*(F.avg(f).alias(f"m_{f}") for f in features), *(F.stddev_pop(f).alias(f"s_{f}") for f in features), F.avg(label).alias("y")).first()
    z = {f: (F.col(f) - float(s[f"m_{f}"])) / float(s[f"s_{f}"] or 1.0) for f in features}
    names = list(features)
    g = fit.agg(*(F.sum(z[a] * z[b]).alias(f"{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j), *(F.sum(z[a] * (F.col(label) - float(s["y"]))).alias(f"y_{i}") for i, a in enumerate(names))).first()
    xx = np.array([[g[f"{min(i, j)}_{max(i, j)}"] for j in range(len(names))] for i in range(len(names))], dtype=float)
    beta = np.linalg.solve(xx + penalty * np.eye(len(names)), np.array([g[f"y_{i}"] for i in range(len(names))], dtype=float))
    made = F.lit(float(s["y"]))
    for f, b in zip(names, beta, strict=True):
        made = made + z[f] * float(b)
    return wide.where(F.col(slot) >= split).withColumn("prediction", made)


def targets(scores: DataFrame, k: int) -> DataFrame:
    """Equal weights of the ``k`` best scores of each session, ties by the smaller id."""
    rank = F.row_number().over(Window.partitionBy("session").orderBy(F.col("score").desc(), "instrument_id"))
    return scores.where("score IS NOT NULL").withColumn("_r", rank).where(F.col("_r") <= k).select("session", "slot", "instrument_id", F.lit(1.0 / k).alias("weight"))


def ledger(target: DataFrame, opens: DataFrame, cash: float = 1e6, cost: float = 0.001) -> DataFrame:
    """Fills of a portfolio that moves to its targets at the next open: (slot, equity, cash, fees, turnover).

    Each rebalance is scaled by bisection so that cash after linear costs is never negative. A portfolio is
    one sequence by nature: the opens of the instruments that it ever holds go through one group in order, and a
    row without an instrument for each session.
    """
    rows = target.select((F.col("slot") + 1).alias("slot"), "instrument_id", "weight")
    ever = rows.select("instrument_id").distinct()
    slots = opens.select("slot").distinct().select("slot", F.lit(None).cast("string").alias("instrument_id"), F.lit(None).cast("double").alias("open"))
    held = opens.select("slot", "instrument_id", "open").join(ever, "instrument_id", "left_semi").select("slot", "instrument_id", "open")
    joined = held.unionByName(slots).join(rows, ["slot", "instrument_id"], "left").withColumn("portfolio", F.lit(0))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        held, money, out = {}, cash, []
        for slot, day in pdf.sort_values(["slot", "instrument_id"], kind="stable").groupby("slot"):
            price = {i: p for i, p in zip(day["instrument_id"], day["open"], strict=True) if p == p and p > 0}
            wish = {i: w for i, w in zip(day["instrument_id"], day["weight"], strict=True) if w == w and i in price}
            worth = money + sum(n * price.get(i, 0.0) for i, n in held.items())
            fees = traded = 0.0
            if wish:
                lo, hi = 0.0, 1.0
                names = sorted(set(held) | set(wish))

                def trade(scale: float):
                    moves = {i: wish.get(i, 0.0) * worth * scale / price[i] - held.get(i, 0.0) for i in names if i in price}
                    gross = sum(abs(n) * price[i] for i, n in moves.items())
                    return moves, money - sum(n * price[i] for i, n in moves.items()) - cost * gross, gross

                for _ in range(64):
                    mid = (lo + hi) / 2
                    lo, hi = (mid, hi) if trade(mid)[1] >= 0 else (lo, mid)
                moves, money, traded = trade(lo)
                fees = cost * traded
                held = {i: held.get(i, 0.0) + moves.get(i, 0.0) for i in names}
            out.append((slot, money + sum(n * price.get(i, 0.0) for i, n in held.items()), money, fees, traded / worth if worth else 0.0))
        return pd.DataFrame(out, columns=["slot", "equity", "cash", "fees", "turnover"])

    return joined.groupBy("portfolio").applyInPandas(run, "slot long, equity double, cash double, fees double, turnover double")
