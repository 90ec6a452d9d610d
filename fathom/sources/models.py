"""Standard row models as schemas, and the projection of raw tables onto them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


KINDS = {"string": T.StringType(), "date": T.DateType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "map<string,string>": T.MapType(T.StringType(), T.StringType())}


def schema(text: str) -> T.StructType:
    """A schema from ``name kind`` pairs; needs no session, unlike Spark's own parser."""
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in (f.split(" ") for f in text.split(", "))])


MODELS = {
    "equity_historical": schema("symbol string, date date, open double, high double, low double, close double, volume double, vwap double"),
    "equity_quote": schema("symbol string, name string, exchange string, bid double, ask double, last_price double, open double, high double, low double, prev_close double, volume double"),
    "options_chains": schema("underlying_symbol string, eod_date date, contract_symbol string, expiration date, strike double, option_type string, bid double, ask double, last_trade_price double, implied_volatility double, delta double, gamma double, theta double, vega double, open_interest bigint, volume bigint, currency string, contract_size int"),
    "futures_historical": schema("symbol string, date date, contract_symbol string, expiration date, open double, high double, low double, close double, volume bigint, open_interest bigint, currency string"),
    "futures_curve": schema("symbol string, date date, contract_symbol string, expiration date, price double, currency string"),
    "currency_historical": schema("symbol string, date date, open double, high double, low double, close double, volume double, vwap double"),
    "crypto_historical": schema("symbol string, date timestamp, open double, high double, low double, close double, volume double, vwap double"),
    "index_historical": schema("symbol string, date date, open double, high double, low double, close double, volume double"),
    "etf_historical": schema("symbol string, date date, open double, high double, low double, close double, volume double, vwap double"),
    "yield_curve": schema("date date, maturity string, rate double"),
    "treasury_rates": schema("date date, month_1 double, month_3 double, month_6 double, year_1 double, year_2 double, year_5 double, year_10 double, year_30 double"),
    "economic_indicators": schema("date date, symbol string, country string, title string, unit string, scale string, value double"),
    "commitment_of_traders": schema("date date, code string, name string, category string, measure string, value double"),
    "institutional_holdings": schema("period date, cusip string, issuer string, class_title string, security_type string, option_type string, value double, shares double, weight double"),
    "company_news": schema("date timestamp, symbol string, title string, text string, url string"),
    "dividends": schema("symbol string, ex_dividend_date date, amount double, currency string"),
    "splits": schema("symbol string, date date, numerator double, denominator double"),
    "tick_envelope": schema("schema_version string, record_type string, source_id string, session_id string, local_seq bigint, received_at_utc string, received_monotonic_ns bigint, native_exchange_id string, native_instrument_id string, raw_payload map<string,string>"),
    "observation": schema("seq bigint, record_id string, observation_key string, revision int, values_hash string, available_at string, session_id string, instrument_id string, source string, event_time string, payload string"),
    "research_panel": schema("instrument_id string, session date, slot int, eligible boolean, present boolean, known boolean, price double, raw_close double, raw_share_volume double, open double"),
}


def plain(name: str) -> str:
    """A column name in snake case."""
    split = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^0-9a-zA-Z]+", "_", split).strip("_").lower()


def standardise(df: DataFrame, model: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """``df`` in a model's schema; columns it doesn't know are kept as text in ``extras``, null if there are none.

    Names are matched in snake case after ``aliases`` (raw name -> field). A value that doesn't convert is null; a
    missing field is a null column: the result's schema never depends on the data. Symbols are upper-cased.
    """
    fields, taken, extras = MODELS[model], {}, []
    for c in df.columns:
        name = (aliases or {}).get(c, plain(c))
        if name in fields.names and name not in taken:
            taken[name] = c
        else:
            extras.append(c)

    def column(f: T.StructField):
        if f.name not in taken:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f"`{taken[f.name]}`")
        same = df.schema[taken[f.name]].dataType == f.dataType
        value = value if same else value.try_cast(f.dataType)
        return (F.upper(value) if f.name == "symbol" else value).alias(f.name)

    more = F.create_map(*(x for c in extras for x in (F.lit(plain(c)), F.col(f"`{c}`").cast("string")))) if extras else F.lit(None).cast("map<string,string>")
    return df.select(*map(column, fields), more.alias("extras"))


def violations(df: DataFrame, required: list[str], unique: list[str]) -> DataFrame:
    """(fault, count) of null required fields and repeated keys; must be empty where the model says so."""
    null = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in required)).unpivot([], required, "fault", "count") if required else None
    twice = df.groupBy(*unique).agg(F.count("*").alias("n")).where("n > 1").agg(F.lit("duplicate_key").alias("fault"), F.count("*").alias("count"))
    out = twice if null is None else null.unionByName(twice)
    return out.where("count > 0")
