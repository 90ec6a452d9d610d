"""Options-chain algebra over one row per contract.

A chain has ``underlying``, ``contract_symbol``, ``expiration``, ``strike``, ``option_type`` (call or put),
``price`` of the underlying, ``dte``, quotes, ``open_interest``, ``volume``, ``iv`` and greeks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def enrich(chain: DataFrame, size: int = 100) -> DataFrame:
    """Adds breakeven, delta exposure and gamma exposure (of a 1 % move); a put's gamma counts against.

    Exposures are cut off to whole numbers, towards zero. Nulls are 0.
    """
    call = F.col("option_type") == "call"
    dex = F.col("delta") * size * F.col("open_interest") * F.col("price")
    gex = F.col("gamma") * size * F.col("open_interest") * F.col("price") * F.col("price") * 0.01
    return chain.withColumns({
        "breakeven": F.when(call, F.col("strike") + F.col("ask")).otherwise(F.col("strike") - F.col("ask")),
        "dex": F.coalesce(dex.cast("long"), F.lit(0).cast("long")),
        "gex": F.coalesce(F.when(call, gex).otherwise(-gex).cast("long"), F.lit(0).cast("long")),
    })


def facts(chain: DataFrame) -> DataFrame:
    """Per underlying: expirations, strikes, and whether any row has an implied volatility or a delta."""
    return chain.groupBy("underlying").agg(F.count_distinct("expiration").alias("expirations"), F.count_distinct("strike").alias("strikes"), F.max(F.col("iv").isNotNull()).alias("has_iv"), F.max(F.col("delta").isNotNull()).alias("has_greeks"))


PRICES = ("mid", "last", "close", "mark")


def price_column(columns: Sequence[str], prefer: Sequence[str] = PRICES) -> str:
    """The price column to use, by what the table has: one choice for the whole table."""
    for c in prefer:
        if c in columns:
            return c
    raise KeyError(f"none of {', '.join(prefer)} among {', '.join(columns)}")


EXPOSURES = ("dex", "gex")


def magnitude(measure: str) -> Column:
    """What statistics add up of a measure: exposures count without their sign."""
    return F.abs(F.col(measure)) if measure in EXPOSURES else F.col(measure)


def by_group(chain: DataFrame, by: Sequence[str], measure: str, moneyness: str | None = None, days: int | None = None, whole: Sequence[str] = ("underlying",)) -> DataFrame:
    """Calls, puts, total, put/call ratio and ``net_percent``, the total in percent of that of the whole chain.

    ``by`` starts with ``whole``, the columns that tell chains apart. ``moneyness`` (otm, itm; at the money is both) and ``days`` (the
    expiration nearest to so many days) restrict the groups, not the whole. Zeros are null, groups of nothing but nulls go.
    """
    call, value = F.col("option_type") == "call", magnitude(measure)
    if moneyness not in (None, "otm", "itm"):
        raise ValueError(f"moneyness {moneyness!r} is neither otm nor itm")
    above = F.col("strike") >= F.col("price") if moneyness == "otm" else F.col("strike") <= F.col("price")
    below = F.col("strike") <= F.col("price") if moneyness == "otm" else F.col("strike") >= F.col("price")
    asked = F.lit(True) if moneyness is None else F.when(call, above).otherwise(below)
    if days is not None:
        near = nearest_expiration(chain, days).withColumnRenamed("expiration", "_near")
        chain = chain.join(near, "underlying")
        asked = asked & (F.col("expiration") == F.col("_near"))
    agg = chain.groupBy(*by).agg(F.sum(F.when(asked & call, value)).alias("c"), F.sum(F.when(asked & ~call, value)).alias("p"), F.sum(value).alias("all"))
    agg = agg.withColumn("all", F.sum("all").over(Window.partitionBy(*whole)))
    c, p = F.nullif(F.col("c"), F.lit(0)), F.nullif(F.col("p"), F.lit(0))
    total = F.nullif(F.coalesce("c", F.lit(0)) + F.coalesce("p", F.lit(0)), F.lit(0))
    out = agg.select(*by, c.alias("calls"), p.alias("puts"), total.alias("total"), F.round(p / c, 4).alias("pcr"), F.round(F.try_divide(total, F.col("all")) * 100, 4).alias("net_percent"))
    return out.where("calls IS NOT NULL OR puts IS NOT NULL")


def grouping(chain: DataFrame, measure: str) -> DataFrame:
    """Total, per expiration and per strike in one pass: grouping sets, told apart by ``level``; exposures without their sign."""
    call, value = F.col("option_type") == "call", magnitude(measure)
    sets = chain.withColumn("_v", value).groupingSets([["underlying"], ["underlying", "expiration"], ["underlying", "strike"]], "underlying", "expiration", "strike")
    agg = sets.agg(F.grouping_id().alias("g"), F.sum(F.when(call, F.col("_v")).otherwise(0)).alias("calls"), F.sum(F.when(~call, F.col("_v")).otherwise(0)).alias("puts"))
    level = F.when(F.col("g") == 3, "total").when(F.col("g") == 1, "expiration").otherwise("strike")
    return agg.select("underlying", level.alias("level"), "expiration", "strike", "calls", "puts", (F.col("calls") + F.col("puts")).alias("total"))


def nearest_expiration(chain: DataFrame, days: int) -> DataFrame:
    """Per underlying the expiration whose days to expiry are nearest to ``days``; of two the sooner."""
    each = chain.select("underlying", "expiration", "dte").distinct()
    return each.groupBy("underlying").agg(F.min_by("expiration", F.struct(F.abs(F.col("dte") - days), "dte")).alias("expiration"))


def nearest_strike(chain: DataFrame, moved: float = 0.0, option: str | None = None, one_sided: bool = False) -> DataFrame:
    """Per underlying and expiration the strike nearest to the price moved by a part of it; of two the lower.

    One-sided: not below the target for calls, not above it for puts.
    """
    target = F.col("price") * (1 + moved)
    rows = chain.where(F.col("option_type") == option) if option else chain
    if one_sided:
        rows = rows.where(F.col("strike") >= target if option == "call" else F.col("strike") <= target)
    return rows.groupBy("underlying", "expiration").agg(F.min_by("strike", F.struct(F.abs(F.col("strike") - target), "strike")).alias("strike"))


def leg(chain: DataFrame, name: str, option: str, moved: float, price: str = "ask") -> DataFrame:
    """(underlying, expiration, <name>_strike, <name>_price): the contract at the nearest strike, of several the cheapest, in one aggregation."""
    target = F.col("price") * (1 + moved)
    best = F.min_by(F.struct("strike", F.col(price).alias("premium"), F.col("price").alias("spot"), "dte"), F.struct(F.abs(F.col("strike") - target), "strike", price))
    agg = chain.where((F.col("option_type") == option) & F.col(price).isNotNull()).groupBy("underlying", "expiration").agg(best.alias("b"))
    return agg.select("underlying", "expiration", F.col("b.strike").alias(f"{name}_strike"), F.col("b.premium").alias(f"{name}_price"), F.col("b.spot").alias(f"{name}_spot"), F.col("b.dte").alias(f"{name}_dte"))


def two_legs(a: DataFrame, b: DataFrame, strategy: str, cost: Column, up: Column, down: Column) -> DataFrame:
    both = a.join(b, ["underlying", "expiration"])
    spot = F.col("a_spot")
    return both.select("underlying", "expiration", F.lit(strategy).alias("strategy"), "a_strike", "b_strike", "a_price", "b_price", cost.alias("cost"), (cost / spot * 100).alias("cost_percent"), up.alias("breakeven_upper"), down.alias("breakeven_lower"))



def none() -> Column:
    return F.lit(None).cast("double")


def straddle(chain: DataFrame) -> DataFrame:
    """Buy a call and a put at the strike nearest to the price."""
    cost, k = F.col("a_price") + F.col("b_price"), F.col("a_strike")
    return two_legs(leg(chain, "a", "call", 0), leg(chain, "b", "put", 0), "straddle", cost, k + cost, F.col("b_strike") - cost)


def strangle(chain: DataFrame, moved: float = 0.05) -> DataFrame:
    """Buy a call above and a put below the price."""
    cost = F.col("a_price") + F.col("b_price")
    return two_legs(leg(chain, "a", "call", moved), leg(chain, "b", "put", -moved), "strangle", cost, F.col("a_strike") + cost, F.col("b_strike") - cost)


def vertical_call(chain: DataFrame, sold: float = 0.025, bought: float = -0.025) -> DataFrame:
    """Buy a call at one strike (a), sell one at a higher (b)."""
    cost = F.col("a_price") - F.col("b_price")
    return two_legs(leg(chain, "a", "call", bought), leg(chain, "b", "call", sold, "bid"), "vertical_call", cost, F.col("a_strike") + cost, none())


def vertical_put(chain: DataFrame, sold: float = -0.025, bought: float = 0.025) -> DataFrame:
    """Buy a put at one strike (a), sell one at a lower (b)."""
    cost = F.col("a_price") - F.col("b_price")
    return two_legs(leg(chain, "a", "put", bought), leg(chain, "b", "put", sold, "bid"), "vertical_put", cost, none(), F.col("a_strike") - cost)


def synthetic_long(chain: DataFrame) -> DataFrame:
    """Buy the call (a), sell the put (b) at the strike nearest to the price."""
    cost = F.col("a_price") - F.col("b_price")
    return two_legs(leg(chain, "a", "call", 0), leg(chain, "b", "put", 0, "bid"), "synthetic_long", cost, F.col("a_strike") + cost, none())


def synthetic_short(chain: DataFrame) -> DataFrame:
    """Sell the call (b), buy the put (a)."""
    cost = F.col("a_price") - F.col("b_price")
    return two_legs(leg(chain, "a", "put", 0), leg(chain, "b", "call", 0, "bid"), "synthetic_short", cost, none(), F.col("a_strike") - cost)


def strategies(chain: DataFrame) -> DataFrame:
    """All of the above as one table."""
    made = [straddle(chain), strangle(chain), vertical_call(chain), vertical_put(chain), synthetic_long(chain), synthetic_short(chain)]
    out = made[0]
    for m in made[1:]:
        out = out.unionByName(m)
    return out


def vertical_skew(chain: DataFrame) -> DataFrame:
    """Each contract's volatility less that at the money of its expiration and side."""
    part = Window.partitionBy("underlying", "expiration", "option_type")
    atm = F.min_by("iv", F.struct(F.abs(F.col("strike") - F.col("price")), "strike")).over(part)
    return chain.where(F.col("iv").isNotNull()).select("underlying", "expiration", "option_type", "strike", "iv", atm.alias("atm_iv")).withColumn("skew", F.col("iv") - F.col("atm_iv"))


def horizontal_skew(chain: DataFrame, moved: float = 0.2) -> DataFrame:
    """Per expiration: the volatility of the put ``moved`` below and the call as far above, and their difference."""
    def at(option: str, m: float) -> Column:
        target = F.col("price") * (1 + m)
        return F.min_by(F.when(F.col("option_type") == option, F.col("iv")), F.when(F.col("option_type") == option, F.struct(F.abs(F.col("strike") - target), "strike")))

    agg = chain.where(F.col("iv").isNotNull()).groupBy("underlying", "expiration").agg(at("put", -moved).alias("put_iv"), at("call", moved).alias("call_iv"))
    return agg.withColumn("skew", F.col("put_iv") - F.col("call_iv"))


def trade_side(price: Column, bid: Column, ask: Column, before: Column) -> Column:
    """buy above the middle of the quote, sell below it; at the middle or without a quote by the last tick."""
    mid = (bid + ask) / 2
    return F.when(price > mid, "buy").when(price < mid, "sell").when(price > before, "buy").when(price < before, "sell").otherwise("unknown")


def flow(trades: DataFrame, by: Sequence[str]) -> DataFrame:
    """Signed volume and premium of calls and puts; ratios are null where the denominator is not positive."""
    sign = F.when(F.col("side") == "buy", 1).when(F.col("side") == "sell", -1).otherwise(0)
    call = F.col("option_type") == "call"
    agg = trades.groupBy(*by).agg(F.sum(F.when(call, F.col("size")).otherwise(0)).alias("call_volume"), F.sum(F.when(~call, F.col("size")).otherwise(0)).alias("put_volume"), F.sum(sign * F.col("size")).alias("signed_volume"), F.sum(F.col("size") * F.col("trade_price")).alias("premium"))
    return agg.withColumn("pcr", F.when(F.col("call_volume") > 0, F.col("put_volume") / F.col("call_volume")))


def signal(chain: DataFrame, realised: float, days: int = 90) -> DataFrame:
    """Per underlying: at-the-money volatility nearest ``days``, 25-delta skew, spread over realised, and a label."""
    near = nearest_expiration(chain, days)
    rows = chain.join(near, ["underlying", "expiration"], "left_semi").where("iv IS NOT NULL")

    def iv(option: str, delta: float) -> Column:
        hit = F.col("option_type") == option
        return F.min_by(F.when(hit, F.col("iv")), F.when(hit, F.struct(F.abs(F.abs(F.col("delta")) - delta), "strike")))

    agg = rows.groupBy("underlying").agg(F.min_by("iv", F.struct(F.abs(F.col("strike") - F.col("price")), "strike", "option_type")).alias("atm_iv"), iv("put", 0.25).alias("put25"), iv("call", 0.25).alias("call25"))
    rich = F.col("atm_iv") - realised
    return agg.select("underlying", "atm_iv", (F.col("put25") - F.col("call25")).alias("skew25"), rich.alias("premium"), F.when(rich > 0.05, "rich").when(rich < -0.05, "cheap").otherwise("fair").alias("label"))


def fill_iv(chain: DataFrame, others: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``iv`` from the first source that has it, and ``iv_source``; each source is (name, (contract_symbol, iv))."""
    value, source = F.col("iv"), F.when(F.col("iv").isNotNull(), "chain")
    for name, df in others:
        chain = chain.join(df.select("contract_symbol", F.col("iv").alias(f"_{name}")), "contract_symbol", "left")
        value, source = F.coalesce(value, F.col(f"_{name}")), F.coalesce(source, F.when(F.col(f"_{name}").isNotNull(), name))
    return chain.withColumns({"_v": value, "iv_source": source}).withColumn("iv", F.col("_v")).drop("_v", *(f"_{n}" for n, _ in others))
