"""As-of and overlap joins on time, whose work is spread over slices of time within each key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of time of the as-of join: each key is carried over so many borders at most.
SLICES = 1024
#: Each coarser level of the overlap join has buckets so many times as wide.
BASE = 8
#: Keys with more left rows than this meet in buckets; the others' rows all meet, so a right row meets so many at most.
FEW = 256


def instant(df: DataFrame, column: str) -> Column:
    """A date or time as a whole number: days, microseconds, or the integer itself."""
    kind = df.schema[column].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(F.col(column))
    if kind == "timestamp_ntz":
        return F.unix_micros(F.to_utc_timestamp(F.col(column).cast("timestamp"), "UTC"))
    return F.unix_date(F.col(column)).cast("long") if kind == "date" else F.col(column).cast("long")


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, values: Sequence[str], *, ties: Sequence[str] = (), prefix: str = "last_", slices: int = SLICES) -> DataFrame:
    """Each left row with ``values`` of the right's last row of its key at or before its time, named with ``prefix``.

    Of right rows at the same time, the one with the greatest ``ties``, then values, counts.
    Left rows keep their number; where nothing comes before, or key or time is null, values are null.

    Times of each key are made distinct and cut into slices of about equal rows. A row's answer
    is the last state within its slice, else the last of an earlier slice, so no window holds
    a whole key: one has a slice of it, the other its slices.
    """
    kinds = {c: right.schema[c].dataType for c in [*ties, *values]}
    state = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    known = right.select(F.col(key).alias("_key"), F.col(time).alias("_time"), instant(right, time).alias("_at"), state.alias("_state"), F.lit(False).alias("_asked"))
    asked = left.select(F.col(key).alias("_key"), F.col(time).alias("_time"), instant(left, time).alias("_at"), F.lit(None).cast(known.schema["_state"].dataType).alias("_state"), F.lit(True).alias("_asked"))
    points = known.unionByName(asked).where("_key is not null and _at is not null")
    points = points.groupBy("_key", "_at").agg(F.max("_state").alias("_state"), F.bool_or("_asked").alias("_asked"))
    cut = Bucketizer(splits=_borders(known.unionByName(asked), slices), inputCol="_x", outputCol="_slice", handleInvalid="keep")
    sliced = cut.transform(points.withColumn("_x", F.col("_at").cast("double"))).drop("_x")
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = sliced.where("_state is not null").groupBy("_key", "_slice").agg(F.max_by("_state", "_at").alias("_end"))
    everywhere = sliced.groupBy("_key", "_slice").agg(F.lit(1).alias("_one")).drop("_one").join(ends, ["_key", "_slice"], "left")
    carried = everywhere.select("_key", "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    within = Window.partitionBy("_key", "_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = sliced.join(carried, ["_key", "_slice"]).select("_key", "_at", "_asked", F.coalesce(F.last("_state", ignorenulls=True).over(within), "_carry").alias("_found")).where("_asked")
    answers = found.select(F.col("_key").alias("_akey"), F.col("_at").alias("_aat"), "_found")
    joined = left.withColumn("_at", instant(left, time)).join(answers, (F.col(key) == F.col("_akey")) & (F.col("_at") == F.col("_aat")), "left")
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"_found.v{i}").cast(kinds[c]).alias(f"{prefix}{c}") for i, c in enumerate(values)])


def _borders(points: DataFrame, slices: int) -> list[float]:
    """Quantiles of all times: fewer than ``slices`` numbers, whatever the rows."""
    shares = [i / slices for i in range(1, slices)]
    found = points.agg(F.percentile_approx(F.col("_at").cast("double"), shares, F.lit(10 * slices)).alias("q")).first()["q"] or []
    return [-math.inf, *sorted(set(found)), math.inf]


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], *, prefix: str = "right_", base: int = BASE, few: int = FEW) -> DataFrame:
    """Pairs of rows of one key whose closed spans (start, end) have an instant in common, each once.

    Rows with a null key, start or end, or an end before the start, pair with nothing. Columns of
    the right that the left has too get ``prefix``; the right's key is left out.

    Rows of a key with at most ``few`` left rows meet by the key alone, once each. For the other
    keys, time is cut into buckets, of a width from the median length of all spans and ``base`` times as
    wide at each level. A span lies in at most two buckets of its own level and of each coarser
    one. Two spans meet at the coarser of their two levels, and are reported in the first bucket
    that both have, so it is a join by equal key, level and bucket.
    """
    a, b = _spanned(left, key, left_span, "_a"), _spanned(right, key, right_span, "_b")
    names = {c: prefix + c if c in left.columns else c for c in right.columns if c != key}
    overlap = (F.col("_a_start") <= F.col("_b_end")) & (F.col("_b_start") <= F.col("_a_end"))
    out = [F.col(f"`{c}`") for c in [*left.columns, *names.values()]]
    hot = a.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("n")).where(F.col("n") > few).select("_hot").persist()
    cold = lambda df: df.join(hot, F.col(key) == F.col("_hot"), "left_anti")
    once = lambda df: df.withColumnsRenamed(names | {key: "_bkey"})
    if hot.isEmpty():
        return a.join(once(b), (F.col(key) == F.col("_bkey")) & overlap).select(*out)
    met = cold(a).join(once(cold(b)), (F.col(key) == F.col("_bkey")) & overlap).select(*out)
    a, b = (df.join(hot, F.col(key) == F.col("_hot"), "left_semi") for df in (a, b))
    length = lambda df, p: df.select((F.col(f"{p}_end") - F.col(f"{p}_start")).alias("n"))
    row = length(a, "_a").unionByName(length(b, "_b")).agg(F.percentile_approx("n", 0.5).alias("mid"), F.max("n").alias("most")).first()
    widths = [max(1, row.mid or 0)]
    while widths[-1] < (row.most or 0):
        widths.append(widths[-1] * base)
    a, b = _bucketed(a, "_a", widths), _bucketed(b, "_b", widths)
    b = b.withColumnsRenamed(names | {key: "_bkey", "_level": "_blevel", "_bucket": "_bbucket"})
    start = F.greatest("_a_start", "_b_start")
    same = (F.col(key) == F.col("_bkey")) & (F.col("_level") == F.col("_blevel")) & (F.col("_bucket") == F.col("_bbucket"))
    meets = (F.greatest("_a_own", "_b_own") == F.col("_level")) & (_bucket(start, _width(widths, F.col("_level"))) == F.col("_bucket"))
    return met.unionByName(a.join(b, same & overlap & meets).select(*out))


def _spanned(df: DataFrame, key: str, span: tuple[str, str], p: str) -> DataFrame:
    out = df.withColumns({f"{p}_start": instant(df, span[0]), f"{p}_end": instant(df, span[1])})
    return out.where(F.col(key).isNotNull() & (F.col(f"{p}_start") <= F.col(f"{p}_end")))


def _width(widths: Sequence[int], level: Column) -> Column:
    return F.get(F.array(*[F.lit(w).cast("long") for w in widths]), level)


def _bucket(at: Column, width: Column) -> Column:
    """Whole quotient, rounded down below zero too."""
    return F.call_function("div", at - F.pmod(at, width), width)


def _bucketed(df: DataFrame, p: str, widths: Sequence[int]) -> DataFrame:
    """A row for each bucket of each level from the span's own on: ``_level``, ``_bucket``, and its own level."""
    start, end = F.col(f"{p}_start"), F.col(f"{p}_end")
    own = sum((F.when(end - start > F.lit(w).cast("long"), 1).otherwise(0) for w in widths[:-1]), F.lit(0))
    places = lambda m: F.transform(F.sequence(_bucket(start, _width(widths, m)), _bucket(end, _width(widths, m))), lambda x: F.struct(m.alias("_level"), x.alias("_bucket")))
    each = F.flatten(F.transform(F.sequence(F.col(f"{p}_own"), F.lit(len(widths) - 1)), places))
    rows = df.withColumn(f"{p}_own", own).withColumn("_place", F.explode(each))
    return rows.withColumns({"_level": F.col("_place._level"), "_bucket": F.col("_place._bucket")}).drop("_place")
