"""Technical indicators over long (symbol, ts) bar tables. Input columns pass, indicator columns are added.

What a frame can express is a window expression; what refers to its own past goes through
:mod:`fathom.functions.recursion`. Seeds and names are this engine's own and are given there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.recursion import ema, lag, per_series, rma
from fathom.functions.windows import full, last_n, linear_weighted, ordered, shifted, so_far

BY, TS = ("symbol",), ("ts",)


def _add(df: DataFrame, offset: int = 0, **made: Column) -> DataFrame:
    """Adds columns, shifted by ``offset`` rows; first computed, then shifted, as windows don't nest."""
    df = df.withColumns(made)
    return df.withColumns({k: shifted(F.col(k), ordered(BY, TS), offset) for k in made}) if offset else df


# --- moving averages ---------------------------------------------------------------------------------


def sma(df: DataFrame, target: str = "close", length: int = 50, offset: int = 0) -> DataFrame:
    return _add(df, offset, **{f"sma_{length}": full(F.avg(target), target, ordered(BY, TS), length)})


def wma(df: DataFrame, target: str = "close", length: int = 50, offset: int = 0) -> DataFrame:
    return _add(df, offset, **{f"wma_{length}": linear_weighted(F.col(target), ordered(BY, TS), length)})


def hma(df: DataFrame, target: str = "close", length: int = 50, offset: int = 0) -> DataFrame:
    """WMA over sqrt(n) of 2 WMA(n / 2) - WMA(n)."""
    w, x = ordered(BY, TS), F.col(target)
    raw = df.withColumn("_raw", 2 * linear_weighted(x, w, length // 2) - linear_weighted(x, w, length))
    return _add(raw, offset, **{f"hma_{length}": linear_weighted(F.col("_raw"), w, int(math.sqrt(length)))}).drop("_raw")


def ema_(df: DataFrame, target: str = "close", length: int = 50) -> DataFrame:
    name = f"ema_{length}"
    return per_series(df, BY, TS, [target], [name], lambda c: {name: ema(c[target], length)})


def zlma(df: DataFrame, target: str = "close", length: int = 50) -> DataFrame:
    """EMA of 2x less x half a window ago."""
    name, back = f"zlma_{length}", (length - 1) // 2
    return per_series(df, BY, TS, [target], [name], lambda c: {name: ema(2 * c[target] - lag(c[target], back), length)})


# --- momentum ----------------------------------------------------------------------------------------


def macd(df: DataFrame, target: str = "close", fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    tag = f"{fast}_{slow}_{signal}"
    names = [f"macd_{tag}", f"macdh_{tag}", f"macds_{tag}"]

    def run(c):
        line = ema(c[target], fast) - ema(c[target], slow)
        sig = ema(line, signal)
        return dict(zip(names, (line, line - sig, sig), strict=True))

    return per_series(df, BY, TS, [target], names, run)


def rsi(df: DataFrame, target: str = "close", length: int = 14, scalar: float = 100.0, drift: int = 1) -> DataFrame:
    name = f"rsi_{length}"

    def run(c):
        d = c[target] - lag(c[target], drift)
        up, down = rma(np.where(np.isnan(d), np.nan, np.maximum(d, 0)), length), rma(np.where(np.isnan(d), np.nan, np.maximum(-d, 0)), length)
        with np.errstate(invalid="ignore"):
            return {name: scalar * up / (up + down)}

    return per_series(df, BY, TS, [target], [name], run)


def stoch(df: DataFrame, k: int = 14, d: int = 3, smooth_k: int = 3) -> DataFrame:
    """%K smoothed over ``smooth_k`` and its mean over ``d``; null where a window has no range."""
    w = ordered(BY, TS)
    lo, hi = full(F.min("low"), "low", w, k), full(F.max("high"), "high", w, k)
    raw = df.withColumn("_k", F.try_divide(100 * (F.col("close") - lo), hi - lo))
    tag = f"{k}_{d}_{smooth_k}"
    return _add(_add(raw, **{f"stochk_{tag}": full(F.avg("_k"), "_k", w, smooth_k)}), **{f"stochd_{tag}": full(F.avg(f"stochk_{tag}"), f"stochk_{tag}", w, d)}).drop("_k")


def cci(df: DataFrame, length: int = 14, scalar: float = 0.015) -> DataFrame:
    """(TP - mean) over ``scalar`` mean absolute deviations of the window."""
    w = ordered(BY, TS)
    df = df.withColumn("_tp", (F.col("high") + F.col("low") + F.col("close")) / 3)
    df = df.withColumn("_m", full(F.avg("_tp"), "_tp", w, length)).withColumn("_all", F.collect_list("_tp").over(last_n(w, length)))
    spread = F.aggregate("_all", F.lit(0.0), lambda a, v: a + F.abs(v - F.col("_m"))) / length
    return _add(df, **{f"cci_{length}": F.when(F.col("_m").isNotNull(), F.try_divide(F.col("_tp") - F.col("_m"), scalar * spread))}).drop("_tp", "_m", "_all")


def cg(df: DataFrame, target: str = "close", length: int = 14) -> DataFrame:
    """Centre of gravity: - sum of i x over sum of x, i from 1 at the newest."""
    w, x = ordered(BY, TS), F.col(target)
    total = full(F.sum(x), x, w, length)
    return _add(df, **{f"cg_{length}": -((length + 1) - linear_weighted(x, w, length) * (length * (length + 1) / 2) / total)})


def fisher(df: DataFrame, length: int = 14, signal: int = 1) -> DataFrame:
    """Fisher transform of the normalised mid price, and its value ``signal`` bars before."""
    w, names = ordered(BY, TS), [f"fisher_{length}", f"fishers_{length}_{signal}"]
    mid = (F.col("high") + F.col("low")) / 2
    df = df.withColumn("_mid", mid)
    df = df.withColumns({"_lo": full(F.min("_mid"), "_mid", w, length), "_hi": full(F.max("_mid"), "_mid", w, length)})

    def run(c):
        value, out = 0.0, np.full(len(c["_mid"]), np.nan)
        state = 0.0
        for i in range(len(out)):
            if np.isnan(c["_lo"][i]):
                continue
            span = max(c["_hi"][i] - c["_lo"][i], 1e-3)
            value = min(0.999, max(-0.999, 0.66 * ((c["_mid"][i] - c["_lo"][i]) / span - 0.5) + 0.67 * value))
            state = 0.5 * math.log((1 + value) / (1 - value)) + 0.5 * state
            out[i] = state
        return dict(zip(names, (out, lag(out, signal)), strict=True))

    return per_series(df, BY, TS, ["_mid", "_lo", "_hi"], names, run).drop("_mid", "_lo", "_hi")


def clenow(df: DataFrame, target: str = "close", period: int = 90) -> DataFrame:
    """One row a symbol: annualised slope of the log of its last ``period`` values, R squared, and their product."""
    w = ordered(BY, TS)
    back = F.row_number().over(ordered(BY, [F.col(t).desc() for t in TS]))
    last = df.select(*BY, F.ln(target).alias("y"), F.row_number().over(w).alias("x"), back.alias("_b")).where(F.col("_b") <= period)
    fit = last.groupBy(*BY).agg(F.count("y").alias("n"), F.regr_slope("y", "x").alias("b"), F.regr_r2("y", "x").alias("r_squared")).where(F.col("n") == period)
    coef = F.pow(F.exp("b"), F.lit(252.0)) - 1
    return fit.select(*BY, "r_squared", coef.alias("fit_coef"), (coef * F.col("r_squared")).alias("factor"))


# --- trend -------------------------------------------------------------------------------------------


def true_range(c) -> np.ndarray:
    before = lag(c["close"])
    tr = np.maximum(c["high"] - c["low"], np.maximum(np.abs(c["high"] - before), np.abs(c["low"] - before)))
    return tr  # null on the first row: there is no close before it


def atr(df: DataFrame, length: int = 14) -> DataFrame:
    name = f"atr_{length}"
    return per_series(df, BY, TS, ["high", "low", "close"], [name], lambda c: {name: rma(true_range(c), length)})


def adx(df: DataFrame, length: int = 50, scalar: float = 100.0) -> DataFrame:
    names = [f"adx_{length}", f"dmp_{length}", f"dmn_{length}"]

    def run(c):
        up, down = c["high"] - lag(c["high"]), lag(c["low"]) - c["low"]
        pos = np.where(np.isnan(up), np.nan, np.where((up > down) & (up > 0), up, 0))
        neg = np.where(np.isnan(down), np.nan, np.where((down > up) & (down > 0), down, 0))
        with np.errstate(invalid="ignore", divide="ignore"):
            level = rma(true_range(c), length)
            dp, dn = scalar * rma(pos, length) / level, scalar * rma(neg, length) / level
            dx = scalar * np.abs(dp - dn) / (dp + dn)
        return dict(zip(names, (rma(dx, length), dp, dn), strict=True))

    return per_series(df, BY, TS, ["high", "low", "close"], names, run)


def aroon(df: DataFrame, length: int = 25, scalar: float = 100.0) -> DataFrame:
    """Age of the extreme in the last ``length`` + 1 bars; of equal extremes the newest counts."""
    w = ordered(BY, TS)
    df = df.withColumn("_i", F.row_number().over(w))
    frame = last_n(w, length + 1)
    there = F.count("*").over(frame) == length + 1
    up = F.max_by("_i", F.struct("high", "_i")).over(frame)
    down = F.min_by("_i", F.struct(F.col("low"), -F.col("_i"))).over(frame)
    df = df.withColumns({"_u": F.when(there, up), "_d": F.when(there, down)})
    made = {f"aroonu_{length}": scalar * (1 - (F.col("_i") - F.col("_u")) / length), f"aroond_{length}": scalar * (1 - (F.col("_i") - F.col("_d")) / length)}
    df = df.withColumns(made)
    return df.withColumn(f"aroonosc_{length}", F.col(f"aroonu_{length}") - F.col(f"aroond_{length}")).drop("_i", "_u", "_d")


def ichimoku(df: DataFrame, conversion: int = 9, base: int = 26, lagging: int = 52, offset: int = 26) -> DataFrame:
    """Mid-ranges; spans are shown ``offset`` - 1 bars later, the lagging span as many bars earlier."""
    w = ordered(BY, TS)

    def mid(n: int) -> Column:
        return (full(F.max("high"), "high", w, n) + full(F.min("low"), "low", w, n)) / 2

    df = df.withColumns({"tenkan": mid(conversion), "kijun": mid(base), "_b": mid(lagging)})
    return df.withColumns({"span_a": F.lag((F.col("tenkan") + F.col("kijun")) / 2, offset - 1).over(w), "span_b": F.lag("_b", offset - 1).over(w), "chikou": F.lead("close", offset - 1).over(w)}).drop("_b")


def ichimoku_ahead(df: DataFrame, conversion: int = 9, base: int = 26, lagging: int = 52, offset: int = 26, step: str = "INTERVAL 1 HOUR") -> DataFrame:
    """The spans that lie in the future: the last ``offset`` - 1 rows of each symbol, dated on by ``step`` a bar."""
    w, back = ordered(BY, TS), ordered(BY, [F.col(t).desc() for t in TS])

    def mid(n: int) -> Column:
        return (full(F.max("high"), "high", w, n) + full(F.min("low"), "low", w, n)) / 2

    rows = df.select(*BY, "ts", ((mid(conversion) + mid(base)) / 2).alias("span_a"), mid(lagging).alias("span_b"), F.row_number().over(back).alias("_r"), F.max("ts").over(Window.partitionBy(*BY)).alias("_end"))
    ahead = rows.where(F.col("_r") < offset).withColumn("_k", offset - F.col("_r"))
    return ahead.select(*BY, F.expr(f"_end + {step} * _k").alias("ts"), "span_a", "span_b")


def demark(df: DataFrame, target: str = "close", least: int = 1) -> DataFrame:
    """Run lengths of closes above and below the close four bars before, by gaps and islands."""
    w = ordered(BY, TS)
    sign = F.signum(F.col(target) - F.lag(target, 4).over(w)).cast("int")
    df = df.withColumn("_s", F.coalesce(sign, F.lit(0)))
    df = df.withColumn("_g", F.sum((F.col("_s") != F.coalesce(F.lag("_s").over(w), F.lit(9))).cast("int")).over(so_far(w)))
    run = F.row_number().over(ordered((*BY, "_g"), TS))
    df = df.withColumn("_n", F.when(run >= least, run).otherwise(0))
    return df.withColumns({"td_seq_up": F.when(F.col("_s") > 0, F.col("_n")).otherwise(0), "td_seq_dn": F.when(F.col("_s") < 0, F.col("_n")).otherwise(0)}).drop("_s", "_g", "_n")


# --- channels and volume -----------------------------------------------------------------------------


def bbands(df: DataFrame, target: str = "close", length: int = 50, std: float = 2.0) -> DataFrame:
    """Mean -/+ ``std`` sample deviations, bandwidth in percent of the mean, and the close's place between the bands."""
    w, tag = ordered(BY, TS), f"{length}_{std}"
    df = df.withColumns({f"bbm_{tag}": full(F.avg(target), target, w, length), "_s": full(F.stddev_samp(target), target, w, length) * std})
    m, s = F.col(f"`bbm_{tag}`"), F.col("_s")
    return df.withColumns({f"bbl_{tag}": m - s, f"bbu_{tag}": m + s, f"bbb_{tag}": 100 * 2 * s / m, f"bbp_{tag}": F.try_divide(F.col(target) - (m - s), 2 * s)}).drop("_s")


def kc(df: DataFrame, length: int = 20, scalar: float = 2.0) -> DataFrame:
    """Keltner channel: EMA of the close -/+ ``scalar`` EMAs of the true range."""
    names = [f"kcl_{length}", f"kcb_{length}", f"kcu_{length}"]

    def run(c):
        mid, band = ema(c["close"], length), scalar * ema(true_range(c), length)
        return dict(zip(names, (mid - band, mid, mid + band), strict=True))

    return per_series(df, BY, TS, ["high", "low", "close"], names, run)


def donchian(df: DataFrame, lower: int = 20, upper: int = 20) -> DataFrame:
    w, tag = ordered(BY, TS), f"{lower}_{upper}"
    lo, hi = full(F.min("low"), "low", w, lower), full(F.max("high"), "high", w, upper)
    return df.withColumns({f"dcl_{tag}": lo, f"dcm_{tag}": (lo + hi) / 2, f"dcu_{tag}": hi})


def obv(df: DataFrame) -> DataFrame:
    """Running sum of volume signed by the change of the close; the first bar counts as up."""
    w = ordered(BY, TS)
    df = df.withColumn("_s", F.coalesce(F.signum(F.col("close") - F.lag("close").over(w)), F.lit(1.0)) * F.col("volume"))
    return df.withColumn("obv", F.sum("_s").over(so_far(w))).drop("_s")


def money_flow() -> Column:
    """((C - L) - (H - C)) / (H - L) times volume; 0 for a bar without range."""
    return F.coalesce(F.try_divide(2 * F.col("close") - F.col("low") - F.col("high"), F.col("high") - F.col("low")), F.lit(0.0)) * F.col("volume")


def ad(df: DataFrame) -> DataFrame:
    return df.withColumn("ad", F.sum(money_flow()).over(so_far(ordered(BY, TS))))


def adosc(df: DataFrame, fast: int = 3, slow: int = 10) -> DataFrame:
    name = f"adosc_{fast}_{slow}"
    return per_series(ad(df), BY, TS, ["ad"], [name], lambda c: {name: ema(c["ad"], fast) - ema(c["ad"], slow)})


def vwap(df: DataFrame, anchor: str = "day") -> DataFrame:
    """Volume-weighted typical price since the start of the anchor period."""
    df = df.withColumn("_p", F.date_trunc(anchor, "ts"))
    frame = so_far(ordered((*BY, "_p"), TS))
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    return df.withColumn(f"vwap_{anchor}", F.try_divide(F.sum(tp * F.col("volume")).over(frame), F.sum("volume").over(frame))).drop("_p")


def heikin_ashi(df: DataFrame) -> DataFrame:
    names = ["ha_open", "ha_high", "ha_low", "ha_close"]

    def run(c):
        close = (c["open"] + c["high"] + c["low"] + c["close"]) / 4
        start = np.empty_like(close)
        for i in range(len(close)):
            start[i] = (c["open"][0] + c["close"][0]) / 2 if i == 0 else (start[i - 1] + close[i - 1]) / 2
        return dict(zip(names, (start, np.maximum(c["high"], np.maximum(start, close)), np.minimum(c["low"], np.minimum(start, close)), close), strict=True))

    return per_series(df, BY, TS, ["open", "high", "low", "close"], names, run)


def support_resistance(df: DataFrame) -> DataFrame:
    """Five-bar fractals as levels, in order, each further than the mean bar range from all accepted before it."""
    w = ordered(BY, TS)

    def turn(col: str, sign: int) -> Column:
        v = F.col(col) * sign
        near = [F.lag(v, k).over(w) for k in (1, 2)], [F.lead(v, k).over(w) for k in (1, 2)]
        return (v < near[0][0]) & (near[0][0] < near[0][1]) & (v < near[1][0]) & (near[1][0] < near[1][1])

    marked = df.select(*BY, "ts", "low", "high", turn("low", 1).alias("s"), turn("high", -1).alias("r"), (F.col("high") - F.col("low")).alias("range"))
    level = F.when(F.col("s"), F.col("low")).when(F.col("r"), F.col("high"))
    per = marked.groupBy(*BY).agg(F.avg("range").alias("gap"), F.sort_array(F.collect_list(F.when(level.isNotNull(), F.struct("ts", level.alias("level"))))).alias("all"))
    kept = F.aggregate("all", F.filter("all", lambda x: F.lit(False)), lambda acc, x: F.when(F.forall(acc, lambda a: F.abs(a["level"] - x["level"]) > F.col("gap")), F.concat(acc, F.array(x))).otherwise(acc))
    return per.select(*BY, F.explode(kept).alias("x")).select(*BY, "x.ts", "x.level")


# The levels between the two extremes, the second as the engine being matched has it.
FIB = (0.0, 0.235, 0.382, 0.5, 0.618, 0.65, 1.0)


def fib(df: DataFrame, target: str = "close", period: int = 120) -> DataFrame:
    """Retracement levels between the extremes of each symbol's last ``period`` bars; ``leg`` tells which came last."""
    back = F.row_number().over(ordered(BY, [F.col(t).desc() for t in TS]))
    last = df.select(*BY, "ts", F.col(target).alias("x"), back.alias("_b")).where(F.col("_b") <= period)
    ends = last.groupBy(*BY).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.min_by("ts", F.struct("x", "ts")).alias("lo_ts"), F.min_by("ts", F.struct(-F.col("x"), "ts")).alias("hi_ts"))
    up = F.col("lo_ts") < F.col("hi_ts")
    start, end = F.when(up, F.col("lo")).otherwise(F.col("hi")), F.when(up, F.col("hi")).otherwise(F.col("lo"))
    levels = F.array(*(F.struct(F.lit(f).alias("level"), (end + (start - end) * f).alias("price")) for f in FIB))
    return ends.select(*BY, F.when(up, "right").otherwise("left").alias("leg"), F.explode(levels).alias("x")).select(*BY, "leg", "x.level", "x.price")


# --- volatility --------------------------------------------------------------------------------------


def _log(a: str, b: str) -> Column:
    return F.ln(F.try_divide(a, b))


MODELS = ("std", "parkinson", "garman_klass", "hodges_tompkins", "rogers_satchell", "yang_zhang")


def _estimates(df: DataFrame, model: str, windows: Sequence[int], periods: int) -> DataFrame:
    """Adds ``_v<n>``, an estimator over the last n rows, null until they are full.

    The logarithms, what the frames add up and the estimates are one projection each, so that a frame is made once."""
    w = ordered(BY, TS)
    hl, co, ho, lo = _log("high", "low"), _log("close", "open"), _log("high", "open"), _log("low", "open")
    df = df.withColumns({"_c": F.ln(F.try_divide(F.col("close"), F.lag("close").over(w))), "_o": F.ln(F.try_divide(F.col("open"), F.lag("close").over(w)))})
    rs, c, o = ho * (ho - co) + lo * (lo - co), F.col("_c"), F.col("_o")
    terms = {
        "std": [c],
        "hodges_tompkins": [c],
        "parkinson": [hl * hl / (4 * math.log(2))],
        "garman_klass": [0.5 * hl * hl - (2 * math.log(2) - 1) * co * co],
        "rogers_satchell": [rs],
        "yang_zhang": [o * o, c * c, F.when(c.isNotNull(), rs)],
    }[model]
    names = [f"_t{i}" for i in range(len(terms))]
    known = F.lit(True)
    for t in terms:
        known = known & t.isNotNull()
    df = df.withColumns(dict(zip(names, terms, strict=True)) | {"_k": F.when(known, 1)})
    made = {"std": F.stddev_samp, "hodges_tompkins": F.stddev_samp, "yang_zhang": F.sum}.get(model, F.avg)
    frames = {f"_k{n}": F.count("_k").over(last_n(w, n)) for n in windows} | {f"{t}_{n}": made(t).over(last_n(w, n)) for n in windows for t in names}
    if model == "hodges_tompkins":
        frames["_n"] = F.count("_k").over(Window.partitionBy(*BY))
    df, year = df.withColumns(frames), math.sqrt(periods)

    def value(n: int) -> Column:
        first = F.col(f"_t0_{n}")
        if model == "std":
            return first * year
        if model == "hodges_tompkins":  # a full frame leaves one row or more
            left = F.col("_n") - n + 1
            return first * year / (1 - n / left + (n**2 - 1) / (3 * left * left))
        if model == "yang_zhang":
            k = 0.34 / (1.34 + (n + 1) / (n - 1))
            return F.sqrt((first + k * F.col(f"_t1_{n}") + (1 - k) * F.col(f"_t2_{n}")) / (n - 1)) * year
        return F.sqrt(first * periods)

    return df.withColumns({f"_v{n}": F.when(F.col(f"_k{n}") == n, value(n)) for n in windows})


def volatility(df: DataFrame, model: str, window: int = 30, periods: int = 252) -> DataFrame:
    """Annualised realised volatility, null until a window is full: one of ``MODELS``
    (yang_zhang with sums of squares, not centred variances).

    A ratio to a price of zero has no logarithm: windows that hold such a bar are not full."""
    return _estimates(df, model, [window], periods).select(*df.columns, F.col(f"_v{window}").alias(f"vol_{model}"))


#: The window lengths of the cones.
CONE_WINDOWS = (3, 10, 30, 60, 90, 120, 150, 180, 210, 240, 300, 360)


def cones(df: DataFrame, lower: float = 0.25, upper: float = 0.75, periods: int = 252, windows: Sequence[int] = CONE_WINDOWS, model: str = "std") -> DataFrame:
    """Per window length: min, quantiles, median, max and last of an estimator of ``MODELS``. One pass makes all windows.

    Quantiles the wrong way round are turned; they must lie in [0, 1)."""
    lower, upper = sorted((lower, upper))
    if not 0 <= lower <= upper < 1:
        raise ValueError("quantiles of a cone lie in [0, 1)")
    every = F.array(*(F.struct(F.lit(n).alias("window"), F.col(f"_v{n}").alias("v")) for n in windows))
    long = _estimates(df.select(*BY, "ts", "open", "high", "low", "close"), model, windows, periods).select(*BY, "ts", F.inline(every)).where("v IS NOT NULL")
    agg = long.groupBy(*BY, "window").agg(F.min("v").alias("min"), F.percentile("v", [lower, 0.5, upper]).alias("q"), F.max("v").alias("max"), F.max_by("v", "ts").alias("realized"))
    return agg.select(*BY, "window", "realized", "min", F.col("q")[0].alias("lower"), F.col("q")[1].alias("median"), F.col("q")[2].alias("upper"), "max")


# --- relative rotation -------------------------------------------------------------------------------


def scaled(c: str, method: str, part) -> Column:
    """A column by its sample's z-score (``z``), range (``m``) or greatest size (``a``)."""
    x = F.col(c)
    if method == "z":
        return F.try_divide(x - F.avg(c).over(part), F.stddev_samp(c).over(part))
    if method == "m":
        return F.try_divide(x - F.min(c).over(part), F.max(c).over(part) - F.min(c).over(part))
    if method == "a":
        return F.try_divide(x, F.max(F.abs(x)).over(part))
    raise ValueError(f"method {method!r} is none of z, m, a")


def relative_rotation(df: DataFrame, benchmark: str, target: str = "close", long: int = 252, short: int = 21, study: str = "price", window: int = 21, periods: int = 252, method: str = "z") -> DataFrame:
    """Ratio of each symbol to the benchmark at the same time, its momentum, and both scaled by their own sample.

    The study is of ``target`` (price), of the ``volume``, or of the volatility of ``target`` over ``window`` rows. The benchmark's
    value comes from a window over the time, so there is no self-join.
    """
    w = ordered(BY, TS)
    if study not in ("price", "volume", "volatility"):
        raise ValueError(f"study {study!r} is none of price, volume, volatility")
    x = F.col("volume" if study == "volume" else target)
    df = df.select("symbol", "ts", x.alias("_x"))
    if study == "volatility":
        df = df.withColumn("_r", F.ln(F.try_divide(F.col("_x"), F.lag("_x").over(w)))).withColumn("_x", full(F.stddev_samp("_r"), "_r", w, window) * math.sqrt(periods))
    at = F.max(F.when(F.col("symbol") == benchmark, F.col("_x"))).over(Window.partitionBy(*TS))
    met = df.withColumn("_b", at).where(F.col("_b").isNotNull() & F.col("_x").isNotNull() & (F.col("symbol") != benchmark))
    ratio = met.select("symbol", "ts", (F.try_divide(F.col("_x").cast("double"), "_b") * 100).alias("ratio"))

    def change(n: int) -> Column:
        return F.ln(F.try_divide(F.col("ratio"), F.lag("ratio", n).over(w)) + 1e-10)

    moved = ratio.withColumn("momentum", change(long) - change(short)).where("momentum IS NOT NULL")
    part = Window.partitionBy(*BY)
    return moved.select("symbol", "ts", "ratio", "momentum", scaled("ratio", method, part).alias(f"{method}_ratio"), scaled("momentum", method, part).alias(f"{method}_momentum"))
