"""Registers the text functions and scorers for SQL."""

from __future__ import annotations

import inspect
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpgraph.functions import brands, companies, events, people, similarity, titles, web

MODULES = (brands, companies, events, people, titles, web)
SCORERS = (similarity.ratio, similarity.token_sort_ratio, similarity.token_set_ratio, similarity.partial_ratio, similarity.weighted_ratio)
#: Functions of a list of texts; all others take one text.
OF_LISTS = ("common_ticker", "initials")
#: A string literal, or the name of an operator in prefix form.
_PIECE = re.compile(r"('(?:[^'\\]|\\.)*')|(?<![\w`])(and|or|not|in|[!=<>+\-*/%&|^~]+)(?=\()")


def column_functions() -> dict[str, Callable[[Column], Column]]:
    """Public functions of one column, by name."""
    out = {}
    for m in MODULES:
        for name, f in inspect.getmembers(m, inspect.isfunction):
            hints = list(inspect.signature(f).parameters.values())
            if f.__module__ == m.__name__ and not name.startswith("_") and len(hints) == 1 and hints[0].annotation == "Column":
                out[name] = f
    return out


def sql_of(column: Column) -> str:
    """SQL text of an expression; operators in prefix form are quoted, so that they parse as function names."""
    return _PIECE.sub(lambda m: m[1] or f"`{m[2]}`", column._jc.node().sql())


def _vectorised(scorer: Callable[[str, str], float]):
    def score(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in pairs:
            yield pd.Series([None if x is None or y is None else scorer(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(score, "double")


def register(spark: SparkSession) -> list[str]:
    """Makes text functions temporary SQL functions (they stay in the JVM) and scorers vectorised UDFs; returns their names."""
    names = []
    for name, f in column_functions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {'ARRAY<STRING>' if name in OF_LISTS else 'STRING'}) RETURN {sql_of(f(F.col('x')))}")
        names.append(name)
    for scorer in SCORERS:
        spark.udf.register(scorer.__name__, _vectorised(scorer))
        names.append(scorer.__name__)
    return names
