"""Relational building blocks of the plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def number(value: Column) -> Column:
    return value.try_cast("double")


def number_or_zero(value: Column) -> Column:
    return F.coalesce(number(value), F.lit(0.0))


def truthy(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value.cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def sorted_set(value: Column) -> Column:
    return F.array_sort(F.collect_set(value))


def share_where(condition: Column) -> Column:
    """Share of rows for which a condition holds."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def frequencies(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def top_n(df: DataFrame, by: str, ties: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(F.desc(by), *ties).limit(n)


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """bin (1..bins), low, high, count of equal-width bins, the last closed; one pass for the range, one for the counts."""
    span = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    rows = df.select(F.col(column).cast("double").alias("x")).where("x is not null").join(F.broadcast(span))
    at = F.when(F.col("hi") == F.col("lo"), F.lit(1)).otherwise(F.least(F.width_bucket("x", "lo", "hi", F.lit(bins)), F.lit(bins)))
    width = (F.col("hi") - F.col("lo")) / bins
    return rows.withColumn("bin", at.cast("int")).groupBy("bin", "lo", "hi").agg(F.count("*").alias("count")).select("bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("low"), (F.col("lo") + F.col("bin") * width).alias("high"), "count")


def most_common(df: DataFrame, *keys: str, first: Column, name: str = "count") -> DataFrame:
    """Frequencies, largest first; of equals the key that was seen first."""
    return df.groupBy(*keys).agg(F.count("*").alias(name), F.min(first).alias("_first")).orderBy(F.desc(name), "_first").drop("_first")


def capped(df: DataFrame, most: int | None, order: Sequence[str | Column]) -> DataFrame:
    """The first ``most`` rows in a total order; all of them for None."""
    return df if most is None else df.orderBy(*order).limit(most)


def not_done(rows: DataFrame, done: DataFrame | None, key: str, done_key: str | None = None) -> DataFrame:
    """Rows whose key an earlier run's output lacks; a null key is never done."""
    if done is None:
        return rows
    return rows.join(done.select(F.col(done_key or key).alias(key)).where(F.col(key).isNotNull()).distinct(), key, "left_anti").select(*rows.columns)
