"""Readers, sinks, models and the registry, through files."""

import datetime as dt
import io
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from fathom.functions import udf
from fathom.sources import models, readers, registry, sinks


def test_text_formats(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,a\n02,b\n")
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "a.csv")).orderBy("x").collect()] == [("02", "b"), ("1", "a")]
    (tmp_path / "a.json").write_text('[{"a": {"b": 1}}, {"a": {"b": 2}}]')
    assert [r[0] for r in readers.json(spark, str(tmp_path / "a.json"), "a struct<b:int>", multiline=True).select("a.b").collect()] == [1, 2]
    (tmp_path / "a.xml").write_text("<t><row><n>1</n><s><k>x</k></s></row><row><n>2</n><s><k>y</k></s></row></t>")
    assert [tuple(r) for r in readers.xml(spark, str(tmp_path / "a.xml"), "row", "n int, s struct<k:string>").select("n", "s.k").orderBy("n").collect()] == [(1, "x"), (2, "y")]


def test_zipped_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("f.csv", "preamble\n,A,B\n202001, 1.5, 2\n2020, 9, 9\n202002, 3, -50\n\nfooter\n")
    got = readers.zipped_fixed_csv(spark, str(tmp_path / "f.zip"), "date string, a double, b double", skip=2)
    assert [tuple(r) for r in got.orderBy("date").collect()] == [("202001", 0.015, 0.02), ("202002", 0.03, -0.5)]


def test_html_and_sqlite(spark, tmp_path):
    pages = spark.createDataFrame([(1, "<p>x</p><table><tr><th>A</th><td> b <i>c</i></td></tr></table>"), (2, None)], "id int, html string")
    assert [tuple(r) for r in readers.html_tables(pages, "id", "html").collect()] == [(1, 0, 0, ["A", "b c"])]
    con = sqlite3.connect(tmp_path / "c.db")
    con.execute("CREATE TABLE t (x INT)")
    con.executemany("INSERT INTO t VALUES (?)", [(1,), (2,)])
    con.commit()
    con.close()
    assert readers.sqlite(spark, str(tmp_path / "c.db"), "SELECT x FROM t", "x long").count() == 2


def test_fan_out_and_pages(spark):
    def fetch(url):
        if "bad" in url:
            raise ValueError("no")
        return [{"v": 1}, {"v": 2}]

    urls = spark.createDataFrame([("good",), ("bad",)], "url string")
    got = readers.fan_out(urls, fetch, "url string, v double, error string")
    assert got.where("error IS NULL").count() == 2 and got.where("error IS NOT NULL").count() == 1 and not readers.all_failed(got)
    assert readers.all_failed(readers.fan_out(urls.where("url = 'bad'"), fetch, "url string, v double, error string"))
    assert [tuple(r) for r in readers.paged(spark, lambda p: [{"v": p * 10}], 3, "v long, page long").orderBy("v").collect()] == [(0, 0), (10, 1), (20, 2)]
    with pytest.raises(ValueError):
        readers.paged(spark, lambda p: [], 101, "v long, page long")


def test_standard_model(spark):
    raw = spark.createDataFrame([("aapl", "2024-01-02", "1.5", "oops", "7")], ["Symbol", "Date", "Open", "adjClose", "close price"])
    got = models.standardise(raw, "equity_historical", {"close price": "close"})
    row = got.first()
    assert (row["symbol"], str(row["date"]), row["open"], row["close"], row["high"], row["extras"]) == ("AAPL", "2024-01-02", 1.5, 7.0, None, {"adj_close": "oops"})
    assert got.schema.names == [*models.MODELS["equity_historical"].names, "extras"]
    assert {(r["fault"], r["count"]) for r in models.violations(got.unionByName(got), ["high"], ["symbol", "date"]).collect()} == {("high", 2), ("duplicate_key", 1)}


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)], "id long, p string, v double")
    sinks.parquet(df, path, partitions=["p"])
    sinks.upsert_partitions(spark.createDataFrame([(2, "a", 20.0), (4, "a", 4.0)], "id long, p string, v double"), path, ["id"], "p")
    assert [tuple(r) for r in spark.read.parquet(path).select("id", "p", "v").orderBy("id").collect()] == [(1, "a", 1.0), (2, "a", 20.0), (3, "b", 3.0), (4, "a", 4.0)]
    sinks.append_new(df, path, ["id"])
    assert spark.read.parquet(path).count() == 4
    one, two = (sinks.content_addressed(d, str(tmp_path / "ca")) for d in (df, df.repartition(3)))
    assert one == two and spark.read.parquet(one).count() == 3
    nested = spark.createDataFrame([((1, 2), [1])], "data struct<a:int,b:int>, xs array<int>")
    assert sinks.flattened(nested).first().asDict() == {"data_a": 1, "data_b": 2, "xs": "[1]"}
    with pytest.raises(ValueError):
        sinks.xlsx(df, str(tmp_path / "x.xlsx"), 2)


def test_registry(spark):
    sources = registry.Sources()
    sources.add(registry.Source("one", "m", lambda s, p: s.range(p["n"]), ready=lambda: False))
    sources.add(registry.Source("two", "m", lambda s, p: s.range(p["n"]), prepare=lambda p: {"n": p["n"] * 2}))
    got = sources.fetch(spark, "m", n=2)
    assert got.provider == "two" and got.df.count() == 4 and sources.fetch(spark, "m", "one", n=2).df.count() == 2
    with pytest.raises(KeyError, match="one, two"):
        sources.find("m", "three")

    @registry.on_output(lambda name: name == "t.double")
    def noted(result):
        result.warnings.append("seen")
        return result

    @registry.command("t.double")
    def double(df):
        return df.selectExpr("id * 2 AS id")

    out = double(got.df)
    assert out.warnings == ["seen"] and out.to_dict()["id"] == [0, 2, 4, 6] and '"rows":[[0],[2],[4],[6]]' in out.to_llm()

    @registry.accessor("total")
    class Total:
        def __init__(self, result):
            self.n = result.df.count()

    assert out.accessor("total").n == 4 and out.accessor("total") is out.accessor("total")


def test_user_functions(spark):
    udf.register(spark)
    assert [tuple(r) for r in spark.sql("SELECT * FROM chunks(0, 5, 2)").collect()] == [(0, 0, 2), (1, 2, 4), (2, 4, 5)]
    with pytest.raises(KeyError):
        udf.apply(spark.range(1), "nothing")


def test_html_table_rows_keeps_pages_with_tables(spark, tmp_path):
    from fathom.queries.scalars import QUERIES

    html = "<p>x</p><table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table><table><tr><td>3</td></tr></table>"
    spark.createDataFrame([(1, "u", html), (2, "u", "<p>none</p>"), (3, "u", None)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(tuple(r) for r in QUERIES["html_table_rows"](spark, str(tmp_path)).collect())
    assert got == [(1, 0, 0, ["A", "B"]), (1, 0, 1, ["1", "2"]), (1, 1, 0, ["3"])]


def test_snapshots_keep_revisions_and_point_to_the_current(spark, tmp_path):
    from fathom.operators.catalog import Snapshots

    def table(*rows):
        return spark.createDataFrame(rows, "day date, exchange string, symbol string, price double")

    a, b = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    held = Snapshots(spark, str(tmp_path / "s"), ["day", "exchange"], table().schema)
    assert held.current().count() == 0 and held.commit(table()).count() == 0
    first = table((a, "X/1", "s", 1.0), (a, "X/1", "t", None), (b, "X/1", "s", 2.0))
    assert held.commit(first).count() == 2 and held.commit(first.repartition(3)).count() == 0  # the same rows change nothing
    assert [r.day for r in held.commit(table((a, "X/1", "s", 9.0), (b, "X/1", "s", 2.0))).collect()] == [a]
    assert sorted(held.current().collect()) == [(a, "X/1", "s", 9.0), (b, "X/1", "s", 2.0)]
    assert held.commit(first).count() == 1 and held.revisions().count() == 3  # back to what was: no new revision
    assert sorted(map(repr, held.current().collect())) == sorted(map(repr, first.collect()))
    with pytest.raises(Exception, match="null in exchange"):
        held.commit(table((a, None, "s", 1.0)))
    assert held.current().count() == 3


def test_contract_master_names_the_first_broken_rule(spark):
    from fathom.operators.catalog import contract_master

    day, late, good = dt.date(2024, 1, 2), dt.date(2024, 2, 1), ("10000001", "510050", "X", "official", "call", 2.5, dt.date(2024, 2, 1), dt.date(2024, 1, 2), 100.0)
    names = ["symbol", "underlying", "exchange", "metadata_source", "option_type", "strike", "expiration", "source_date", "contract_unit"]
    changes = [{}, {"symbol": "123"}, {"symbol": None}, {"exchange": "Y"}, {"underlying": "510300"}, {"metadata_source": "web"}, {"option_type": "CALL"}, {"strike": float("nan")}, {"strike": 0.0}, {"strike": None}, {"expiration": dt.date(2024, 1, 1)}, {"source_date": late}, {"source_date": None}, {"contract_unit": 0.0}, {"contract_unit": None}, {"symbol": "77777777"}, {"symbol": "77777777", "strike": -1.0}]
    rows = [tuple((dict(zip(names, good, strict=True)) | {"symbol": f"{10000000 + i}"} | c)[n] for n in names) + (i,) for i, c in enumerate(changes)]
    df = spark.createDataFrame(rows, "symbol string, underlying string, exchange string, metadata_source string, option_type string, strike double, expiration date, source_date date, contract_unit double, i int")
    got = {r.i: (r.reason, r.quality_flags) for r in contract_master(df, F.lit(day), "X", "official", ["510050"]).collect()}
    reasons = [None, "invalid_code", "invalid_code", "exchange_mismatch", "underlying_scope_mismatch", "metadata_source_mismatch", "invalid_option_type", "invalid_strike", "invalid_strike", "invalid_strike", "expired_contract", "metadata_date_mismatch", "missing_metadata_date", "invalid_contract_unit", None, "duplicate_contract", "duplicate_contract"]
    assert [got[i][0] for i in range(len(changes))] == reasons
    assert got[0][1] == [] and got[14][1] == ["unknown_contract_unit"] and got[12][1] == ["metadata_source_date_unavailable"]


def test_stacked_tickers_drop_what_says_nothing(spark):
    from fathom.operators.catalog import stacked_tickers

    wide = spark.createDataFrame([(dt.date(2024, 1, d), 1.0 * d, 0.0, None, None) for d in (1, 2, 3)] + [(dt.date(2024, 1, 4), 0.0, 5.0, 7.0, 0.0)], "date date, `A Open` double, `A Stock Splits` double, `B Open` double, `B Stock Splits` double")
    fields = ["Open", "Stock Splits"]
    every = stacked_tickers(wide, ["A", "B"], fields, sep=" ")
    assert every.columns == ["date", "symbol", "open"] and every.count() == 4  # the only split lies on a row without an open
    day = [r.date.day for r in stacked_tickers(wide, ["A", "B"], fields, sep=" ", start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 3)).collect()]
    assert sorted(day) == [2, 3]
    assert stacked_tickers(wide, ["A"], fields, sep=" ", start=dt.date(2024, 1, 3), end=dt.date(2024, 1, 1)).count() == 1


def test_admission_and_views_with_unknown_values(spark):
    from fathom.operators import catalog as ct

    lineage = spark.createDataFrame([("a", True, False, False), ("a", True, True, False), ("b", None, True, None), ("c", False, False, True)], "value_id string, complete boolean, source_ok boolean, confirmed_partial boolean")
    assert sorted(map(tuple, ct.admission(lineage).collect())) == [("a", True, False, True), ("b", False, False, False), ("c", False, True, True)]
    rows = [(1, 1, "3", "3", True, None, "1.5"), (2, 1, "3", "3", None, False, "1"), (3, 2, "3", "3", True, False, "1"), (4, 1, "3", "2", True, False, "1"), (5, 1, "3", "3", True, True, "1"), (6, 1, "2", "2", True, False, "x")]
    variants = spark.createDataFrame(rows, "i int, variant_count int, requested string, given string, admissible boolean, fault boolean, close string")
    views = ct.catalog_views(variants, ["fault"], {"3": "plain", "2": "forward"}, ["close"])
    got = {k: sorted(r.i for r in v.collect()) for k, v in views.items()}
    assert got == {"conflicts": [3], "quarantine": [2, 3, 4, 5], "plain": [1], "forward": [6]}
    assert views["plain"].first().close == 1.5 and views["forward"].first().close is None
    marks = ct.marked(spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int"), {"m": spark.createDataFrame([(1, 2), (1, 2), (None, 2)], "a int, b int")}, ["a", "b"])
    assert sorted(map(repr, (tuple(r) for r in marks.collect()))) == ["(1, 2, True)", "(1, 2, True)", "(None, 2, False)"]
