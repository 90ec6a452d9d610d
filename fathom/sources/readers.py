"""Readers of files and services. Whatever Spark has no reader for goes file by file through tasks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a declared schema; without one every column is text, never guessed."""
    reader = spark.read.options(header=True, **options)
    return (reader.schema(schema) if schema else reader.option("inferSchema", False)).csv(path)


def json(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multiline: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multiline)
    return (reader.schema(schema) if schema else reader).json(path)


def xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def parsed_files(spark: SparkSession, path: str, parse: Callable[[str, bytes], pd.DataFrame], schema: T.StructType | str, pattern: str | None = None) -> DataFrame:
    """Rows that ``parse`` makes of each file's bytes, in tasks. A file is one unit: it must fit a worker."""
    reader = spark.read.format("binaryFile")
    found = (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path).select("path", "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"], strict=True):
                yield parse(name, bytes(data))

    return found.mapInPandas(run, schema)


def zipped_fixed_csv(spark: SparkSession, path: str, schema: T.StructType | str, skip: int, date_length: int = 6, scale: float = 100.0) -> DataFrame:
    """Zipped CSV files with a preamble: rows whose first field has the date's length, numbers divided by ``scale``."""
    fields = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).names

    def parse(_: str, data: bytes) -> pd.DataFrame:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            text = z.read(z.namelist()[0]).decode("utf-8", "replace")
        rows = [[c.strip() for c in line.split(",")] for line in text.splitlines()[skip:]]
        rows = [r for r in rows if len(r) == len(fields) and len(r[0]) == date_length and r[0].isdigit()]
        df = pd.DataFrame(rows, columns=fields)
        for c in fields[1:]:
            df[c] = pd.to_numeric(df[c], errors="coerce") / scale
        return df

    return parsed_files(spark, path, parse, schema, "*.zip")


def excel(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """Excel sheets; needs a pandas Excel engine on the workers, which is asked for when the rows are read."""

    def parse(_: str, data: bytes) -> pd.DataFrame:
        return pd.read_excel(io.BytesIO(data), **options)

    return parsed_files(spark, path, parse, schema, "*.xls*")


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__()
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def html_tables(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, table, row, cells) of every table in a column of pages."""
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for ident, text in zip(b[id_col], b[html_col], strict=True):
                parser = _Tables()
                parser.feed(text or "")
                rows += [(ident, t, i, cells) for t, table in enumerate(parser.tables) for i, cells in enumerate(table)]
            yield pd.DataFrame(rows, columns=[id_col, "table", "row", "cells"])

    return df.select(id_col, html_col).mapInPandas(run, f"{id_col} {kind}, table int, row int, cells array<string>")


def sqlite(spark: SparkSession, path: str, sql: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a query on SQLite files, each read in a task from a copy of its bytes."""
    import sqlite3

    def parse(_: str, data: bytes) -> pd.DataFrame:
        with sqlite3.connect(":memory:") as con:
            con.deserialize(data)
            return pd.read_sql_query(sql, con)

    return parsed_files(spark, path, parse, schema)


def fan_out(urls: DataFrame, fetch: Callable[[str], list[dict]], schema: T.StructType | str, parts: int = 8) -> DataFrame:
    """Rows that ``fetch`` gives for each URL, in parallel; a URL that fails gives one row with its ``error``.

    ``schema`` must have ``url`` and ``error``. See :func:`all_failed`.
    """
    names = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for url in b["url"]:
                try:
                    rows = [{**r, "url": url, "error": None} for r in fetch(url)]
                except Exception as e:  # a failed page must not fail its neighbours
                    rows = [{"url": url, "error": f"{type(e).__name__}: {e}"}]
                yield pd.DataFrame(rows, columns=names)

    return urls.select("url").repartition(parts).mapInPandas(run, schema)


def all_failed(df: DataFrame) -> bool:
    """Whether no URL gave a row: only then is a fan-out an error."""
    row = df.agg(F.count("*").alias("n"), F.count("error").alias("bad")).first()
    return row["n"] > 0 and row["n"] == row["bad"]


def paged(spark: SparkSession, fetch: Callable[[int], list[dict]], pages: int, schema: T.StructType | str, most_pages: int = 100) -> DataFrame:
    """Pages 0 ... of a service, one a partition, with ``page`` kept; more pages than the bound are an error, not a cut."""
    if pages > most_pages:
        raise ValueError(f"{pages} pages exceed the bound of {most_pages}")
    names = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for page in b["id"]:
                yield pd.DataFrame([{**r, "page": int(page)} for r in fetch(int(page))], columns=names)

    return spark.range(0, pages, 1, max(1, pages)).mapInPandas(run, schema)
