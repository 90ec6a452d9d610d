"""Small query languages, compiled to columns; nothing is evaluated as code."""

from __future__ import annotations

import re
import string
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathom.session import scratch

# The words that a search leaves out.
STOP_WORDS = frozenset(("of", "the", "a", "an", "is", "are", "in", "on", "for", "with", "and", "or"))
#: Functions that a text may call. None of them reaches beyond its arguments.
ALLOWED = frozenset(
    """abs add_months any any_value array array_contains ascii avg between bool_and bool_or cardinality cast ceil ceiling char_length coalesce concat concat_ws contains
    corr count count_if covar_pop covar_samp date date_add date_diff date_format date_sub date_trunc datediff day dayofmonth dayofweek dayofyear dense_rank double element_at endswith every exp
    first first_value floor greatest hour if ifnull ilike in initcap int isnan isnotnull isnull kurtosis lag last last_day last_value lcase lead least left len length like ln log log10 log2 lower
    lpad ltrim max max_by mean median min min_by minute mod month months_between nanvl now ntile nullif nvl nvl2 percent_rank percentile percentile_approx pmod position pow power quarter rank regexp_extract
    regexp_like regexp_replace replace reverse right rlike round row_number rpad rtrim second sign signum size skewness split sqrt startswith std stddev stddev_pop stddev_samp string
    struct substr substring sum timestamp to_date to_timestamp trim trunc try_cast try_divide ucase upper var_pop var_samp variance weekday weekofyear year || % * + - / < <= <=> <> = == > >= != & | ^ ~ ! div not and or""".split()
)
#: Parts of a query that a text may have.
PLANS = frozenset("UnresolvedRelation Project Filter Aggregate Sort Distinct GlobalLimit LocalLimit Offset SubqueryAlias UnresolvedHaving UnresolvedSubqueryColumnAliases WithWindowDefinition Join".split())


class Refused(ValueError):
    """A text that asks for what it may not have."""


def parts(found) -> Iterator:
    """The members of a sequence of Spark's."""
    for i in range(found.size()):
        yield found.apply(i)


def check_expression(expr) -> None:
    """Refuse functions that are not allowed, and queries within an expression."""
    kind = expr.getClass().getSimpleName()
    if kind == "UnresolvedFunction":
        name = expr.nameParts().mkString(".").lower()
        if name not in ALLOWED:
            raise Refused(f"the function {name!r} is not allowed")
    elif "Subquery" in kind or kind in ("Exists", "ListQuery", "CallMethodViaReflection", "TryReflect"):
        raise Refused("a query within an expression is not allowed")
    for child in parts(expr.children()):
        check_expression(child)


def check_plan(plan, name: str) -> None:
    """Refuse whatever reads another table than ``name``, and functions as above."""
    kind = plan.getClass().getSimpleName()
    if kind not in PLANS:
        raise Refused(f"{kind} is not allowed")
    if kind == "UnresolvedRelation" and plan.multipartIdentifier().mkString(".").lower() != name.lower():
        raise Refused(f"only the table {name!r} may be read")
    for expr in parts(plan.expressions()):
        check_expression(expr)
    for child in parts(plan.children()):
        check_plan(child, name)


def parser(spark: SparkSession):
    return spark._jsparkSession.sessionState().sqlParser()


def parse_search(text: str) -> list[list[str]]:
    """Alternatives of terms: ``|`` is or, space and ``+`` are and, quotes make phrases, taken as they stand.

    Other terms lose the punctuation at their ends, and stop words go. What follows a quote that nothing closes is left out.
    """
    out = []
    for part in text.lower().split("|"):
        if part.count('"') % 2:
            part = part[: part.rindex('"')]
        terms = [quoted or plain.strip(string.punctuation) for quoted, plain in re.findall(r'"([^"]*)"|([^\s+"]+)', part) if quoted or plain.strip(string.punctuation) not in STOP_WORDS]
        if kept := [t for t in terms if t]:
            out.append(kept)
    return out


def search(text: str, columns: Sequence[str]) -> Column:
    """Predicate of a search over the joined columns; an empty search finds everything."""
    body = F.lower(F.concat_ws(" ", *columns))
    found = None
    for terms in parse_search(text):
        every = F.lit(True)
        for t in terms:
            every = every & F.contains(body, F.lit(t))
        found = every if found is None else found | every
    return F.lit(True) if found is None else found


def where_text(df: DataFrame, expression: str) -> DataFrame:
    """Rows by a SQL expression over the table's columns: parsed first, and refused if it calls what is not in ``ALLOWED``."""
    check_expression(parser(df.sparkSession).parseExpression(expression))
    return df.where(F.expr(expression))


def over_view(df: DataFrame, sql: str, name: str = "df") -> DataFrame:
    """A SQL query over the table, which it calls ``df``; other tables, files and functions that are not allowed are refused."""
    spark = df.sparkSession
    check_plan(parser(spark).parsePlan(sql), name)
    view = f"fathom_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        return spark.sql(f"WITH {name} AS (SELECT * FROM {view}) {sql}")
    finally:
        spark.catalog.dropTempView(view)


def report_filter(df: DataFrame, date: str, start, end, terms: Sequence[str], columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows between dates where any of the terms is in any of the columns, whatever the case, by date."""
    hit = F.lit(False)
    for t in terms:
        for c in columns:
            hit = hit | F.coalesce(F.col(c).ilike(f"%{t}%"), F.lit(False))
    out = df.where(F.col(date).between(start, end) & hit).orderBy(date)
    return out.limit(limit) if limit else out


def recent_distinct(df: DataFrame, columns: Sequence[str], date: str, weeks: int, **equal) -> DataFrame:
    """Distinct rows of the last ``weeks`` before the newest date, with some columns fixed."""
    for c, v in equal.items():
        df = df.where(F.col(c) == v)
    newest = df.agg(F.max(date).alias("_newest"))
    return df.crossJoin(F.broadcast(newest)).where(F.col(date) >= F.date_sub("_newest", weeks * 7)).select(*columns).distinct()


def dimensions(df: DataFrame, names: Sequence[str], key: str, time: str | None = None, start=None, end=None, last: int | None = None) -> DataFrame:
    """Rows by a dotted key: one part a dimension, ``*`` or nothing for all, ``a+b`` for several; a time range and the last n of each series.

    Rows of one time stand in the order of their columns.
    """
    parts = key.split(".")
    if len(parts) != len(names):
        raise ValueError(f"the key needs {len(names)} parts: {', '.join(names)}")
    for name, part in zip(names, parts, strict=True):
        if part not in ("", "*"):
            df = df.where(F.col(name).isin(part.split("+")))
    if start is not None:
        df = df.where(F.col(time) >= start)
    if end is not None:
        df = df.where(F.col(time) <= end)
    if last:
        ties = [c for c, kind in df.dtypes if c != time and "map<" not in kind and kind != "variant"]
        rank = F.row_number().over(Window.partitionBy(*names).orderBy(F.col(time).desc(), *ties))
        df = df.withColumn("_n", rank).where(F.col("_n") <= last).drop("_n")
    return df


def impossible(wanted: DataFrame, allowed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wanted combinations that the constraints don't list."""
    return wanted.join(allowed.select(*names).distinct(), list(names), "left_anti")


def positions_report(df: DataFrame, base: dict[str, str], percents: Sequence[str], date: str, last: int) -> DataFrame:
    """Columns equal to their base on every row go, as do numbers that are zero or null throughout; percentages become parts.

    Only the last ``last`` dates stay. One aggregation tells which columns go; of an empty table none.
    """
    numbers = [c for c, kind in df.dtypes if c != date and (kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"))]
    tests = {c: F.bool_and(F.col(c).eqNullSafe(F.col(b))) for c, b in base.items()}
    zero = {f"0 {c}": F.bool_and(F.coalesce(F.col(c), F.lit(0)) == 0) for c in numbers}
    row = df.agg(*(t.alias(c) for c, t in (tests | zero).items())).first()
    gone = {c for c in base if row[c]} | {c for c in numbers if row[f"0 {c}"]}
    df = df.drop(*gone).withColumns({c: F.col(c) / 100 for c in percents if c not in gone})
    return latest_dates(df, date, last)


def latest_dates(df: DataFrame, date: str, n: int) -> DataFrame:
    """Rows of the ``n`` newest dates: the distinct dates are few, the table isn't ranked."""
    newest = df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)
    return df.join(newest, date, "left_semi")


def indicator_pivot(df: DataFrame, keys: Sequence[str], date: str, dates: Sequence[str], value: str) -> DataFrame:
    """Keys down, dates across, the first value of each; rows of nothing but zeros and nulls go."""
    wide = df.groupBy(*keys).pivot(date, list(dates)).agg(F.first(value, ignorenulls=True))
    some = F.lit(False)
    for d in dates:
        some = some | (F.coalesce(F.col(f"`{d}`"), F.lit(0)) != 0)
    return wide.where(some)


def ordered_tree(df: DataFrame, ident: str, parent: str, title: str) -> DataFrame:
    """Each node that a root leads to, with its level and the path of titles above it.

    One join a level, over levels that are written, until one is empty. A node is not met again below itself, so rows that
    name each other as parents end.
    """
    spark, nodes = df.sparkSession, df.select(F.col(ident).alias("id"), F.col(parent).alias("parent"), F.col(title).alias("title"))

    def kept(level: DataFrame) -> DataFrame:
        path = scratch(spark, "tree")
        level.write.parquet(path)
        return spark.read.schema(level.schema).parquet(path)

    level = kept(nodes.where("parent IS NULL").select("id", F.lit(0).alias("level"), F.col("title").alias("path"), F.array("id").alias("above")))
    out, k = level, 0
    while not level.isEmpty():
        k += 1
        up = level.select(F.col("id").alias("parent"), F.col("path").alias("_path"), "above")
        met = nodes.join(up, "parent").where(~F.array_contains("above", F.col("id")))
        level = kept(met.select("id", F.lit(k).alias("level"), F.concat("_path", F.lit(" / "), F.col("title")).alias("path"), F.concat("above", F.array("id")).alias("above")))
        out = out.unionByName(level)
    return out.select("id", "level", "path")


def chunked(df: DataFrame, symbol: str, size: int) -> DataFrame:
    """(chunk, symbols): distinct symbols in lists of at most ``size``, in order."""
    names = df.select(symbol).distinct().withColumn("_n", F.row_number().over(Window.orderBy(symbol)) - 1)
    return names.groupBy(F.floor(F.col("_n") / size).alias("chunk")).agg(F.array_join(F.sort_array(F.collect_list(symbol)), ",").alias("symbols"))
