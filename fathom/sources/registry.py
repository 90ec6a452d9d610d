"""Named sources for models, with fallback, and commands with hooks over lazy results."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

Load = Callable[[SparkSession, dict[str, Any]], DataFrame]


@dataclass(frozen=True)
class Source:
    """How one provider gives a model: prepare the parameters, load raw rows, make them standard."""

    provider: str
    model: str
    load: Load
    prepare: Callable[[dict[str, Any]], dict[str, Any]] = dict
    transform: Callable[[DataFrame], DataFrame] = lambda df: df
    ready: Callable[[], bool] = lambda: True


class Sources:
    def __init__(self):
        self.by_model: dict[str, dict[str, Source]] = {}

    def add(self, source: Source) -> None:
        self.by_model.setdefault(source.model, {})[source.provider] = source

    def find(self, model: str, provider: str) -> Source:
        there = self.by_model.get(model, {})
        if provider not in there:
            raise KeyError(f"no source {provider!r} for {model!r}; there are {', '.join(sorted(there)) or 'none'}")
        return there[provider]

    def first_ready(self, model: str, priority: list[str] | None = None) -> Source:
        there = self.by_model.get(model, {})
        for name in priority or sorted(there):
            if name in there and there[name].ready():
                return there[name]
        raise LookupError(f"no source of {model!r} is ready")

    def fetch(self, spark: SparkSession, model: str, provider: str | None = None, priority: list[str] | None = None, **params) -> Result:
        source = self.find(model, provider) if provider else self.first_ready(model, priority)
        return Result(source.transform(source.load(spark, source.prepare(params))), source.provider, extra={"model": model, "params": params})


@dataclass
class Result:
    """A lazy table with where it came from. Nothing runs until one of the ``to_`` methods does."""

    df: DataFrame
    provider: str | None = None
    warnings: list[str] = field(default_factory=list)
    extra: dict[str, Any] = field(default_factory=dict)

    def to_pandas(self, sort_by: str | None = None):
        return (self.df.orderBy(sort_by) if sort_by else self.df).toPandas()

    def to_arrow(self):
        return self.df.toArrow()

    def to_dict(self, orient: str = "list"):
        return self.to_pandas().to_dict(orient=orient)

    def to_numpy(self):
        return self.to_pandas().to_numpy()

    def to_llm(self) -> str:
        """One JSON text: columns and rows."""
        return json.dumps({"columns": self.df.columns, "rows": [list(r) for r in self.df.collect()]}, default=str, separators=(",", ":"))

    def accessor(self, name: str):
        if name not in ACCESSORS:
            raise AttributeError(f"no accessor {name!r}")
        return self.extra.setdefault(f"_accessor_{name}", ACCESSORS[name](self))


ACCESSORS: dict[str, type] = {}
COMMANDS: dict[str, Callable[..., Any]] = {}
HOOKS: list[tuple[Callable[[str], bool], Callable[[Result], Result]]] = []


def accessor(name: str):
    """Registers a class that is made from a result and kept with it."""

    def add(cls: type) -> type:
        ACCESSORS[name] = cls
        return cls

    return add


def on_output(wanted: Callable[[str], bool] = lambda name: True):
    """Registers a function from result to result that runs after the commands it wants; a result is replaced, never changed."""

    def add(fn: Callable[[Result], Result]):
        HOOKS.append((wanted, fn))
        return fn

    return add


def command(name: str):
    """Registers a function that returns a DataFrame or a result; the caller gets a result after the hooks."""

    def add(fn: Callable[..., Any]):
        def run(*args, **kwargs) -> Result:
            made = fn(*args, **kwargs)
            result = made if isinstance(made, Result) else Result(made)
            for wanted, hook in HOOKS:
                if wanted(name):
                    result = hook(Result(result.df, result.provider, list(result.warnings), dict(result.extra)))
            return result

        COMMANDS[name] = run
        return run

    return add
