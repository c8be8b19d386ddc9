"""The registry of queries, and helpers for stand-ins."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.sources.shared import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def stand_in(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """``sql`` over tables of the folder, which it names in braces."""
    return spark.sql(sql, **{n: t(spark, d, n) for n in set(re.findall(r"\{(\w+)\}", sql))})


def duck(sql: str) -> str:
    """The same for DuckDB."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that the whole cluster shares."""
    return f"{shared_folder(spark)}/corpgraph-catalog/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def values(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """Literal rows of text."""
    cols = names.split()
    each = [F.struct(*[F.lit(v).cast("string").alias(c) for c, v in zip(cols, r, strict=True)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*each)).alias("r")).select("r.*")


def sql_values(name: str, names: str, rows: list[tuple]) -> str:
    quote = lambda v: "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    return f"{name}({', '.join(names.split())}) AS (VALUES " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows) + ")"


def letters(key: str) -> str:
    """SQL: the digits of a key as letters, a name of its own for each key."""
    return f"translate(CAST({key} AS STRING), '0123456789', 'abcdefghij')"


def cases(key: str, *texts: str) -> str:
    """SQL: one of several texts, by turns."""
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(texts)) + " END"


#: SQL: every run of ASCII letters capitalised, as titles are; {} is the text.
TITLE_CASE = "array_to_string(list_transform(regexp_extract_all({}, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '')"
