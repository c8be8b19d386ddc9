"""Brand requests: mentions, canonical names, counts, and the clean, review and dropped tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpgraph.functions import brands
from corpgraph.functions.common import let
from corpgraph.operators.fuzzy import all_matches
from corpgraph.operators.ops import number_or_zero
from corpgraph.sources.shared import shared_folder


def mentions(messages: DataFrame) -> DataFrame:
    """One row a brand named in a message (message_id, date, subject, body): brand_raw, brand_clean, source, position."""
    out = messages.withColumn("b", brands.brand_block(F.col("body"), F.col("subject")))
    out = out.select("message_id", "date", F.col("b.source").alias("source"), F.posexplode(brands.split_brands("b.block")).alias("position", "brand_raw"))
    # A generator is a step that the optimizer neither repeats nor pushes the filter through.
    named = F.array(let(brands.clean_candidate(F.col("brand_raw")), lambda x: F.when(x.isNotNull(), brands.apply_alias(brands.normalize_brand(x)))))
    return out.select("*", F.explode_outer(named).alias("brand_clean")).where("brand_clean is not null")


def canonical_names(found: DataFrame, *, merge: float = 90) -> DataFrame:
    """name, added: brands that were unlike every canonical name before them, with their first mention (date, message_id, position).

    Names that are alike (``merge`` or more, or equal but for case) are linked, each to those
    first mentioned before it. In each round a name becomes canonical when no earlier name
    that it is linked to is left, and names linked to a new canonical one before them
    are settled too; that is what going through all names in order gives, in as many
    rounds as the longest chain of names that wait for each other.

    Names of the same words are like the same names, so only the first of them can become canonical,
    unless one of them has a twin: a name that differs from it in case alone.
    """
    spark = found.sparkSession
    base = f"{shared_folder(spark)}/corpgraph-names/{uuid.uuid4().hex}"

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    every = found.groupBy(F.col("brand_clean").alias("name")).agg(F.min(F.struct("date", "message_id", "position")).alias("added"))
    every = every.withColumn("twin", F.count("*").over(Window.partitionBy(F.lower("name"))) > 1)
    # Blanks are told apart in more ways than here, but a letter or digit is none; names of blanks alone are like nothing.
    words = F.when(F.col("name").rlike(r"[\p{L}\p{N}]") & F.lit(merge <= 100), F.array_sort(F.array_distinct(F.split(F.trim("name"), r"\s+"))))
    alone = Window.partitionBy(F.coalesce(words, F.array(F.lit(""), "name")))
    kept = every.select("*", F.min("added").over(alone).alias("earliest"), F.bool_or("twin").over(alone).alias("twins"))
    first = saved(kept.where(F.col("twins") | F.col("added").eqNullSafe(F.col("earliest"))).select("name", "added", "twin"), "first")
    alike = all_matches(first, first, "name", "name", at_least=merge).where("name <> match").select("name", F.col("match").alias("other"))
    cased = first.where("twin").select(F.lower("name").alias("low"), "name")
    same = cased.join(cased.withColumnRenamed("name", "other"), "low").select("name", "other")
    first = first.drop("twin")
    times = alike.unionByName(same).join(first, "name").join(first.select(F.col("name").alias("other"), F.col("added").alias("before")), "other")
    links = saved(times.where("before < added").select("name", "other").distinct(), "links")
    open_, canonical, n = first.select("name"), None, 0
    while not open_.isEmpty():
        heads = saved(open_.join(links.select("name").distinct(), "name", "left_anti"), f"heads-{n}")
        merged = links.join(heads.select(F.col("name").alias("other")), "other", "left_semi").select("name").distinct()
        canonical = heads if canonical is None else canonical.unionByName(heads)
        open_ = saved(open_.join(heads.unionByName(merged), "name", "left_anti"), f"open-{n}")
        rest = links.join(open_, "name", "left_semi")
        links, n = saved(rest.join(open_.select(F.col("name").alias("other")), "other", "left_semi").select("name", "other"), f"links-{n}"), n + 1
    return first if canonical is None else first.join(canonical, "name")


def canonical_brands(found: DataFrame, *, merge: float = 90, review: float = 80) -> DataFrame:
    """message_id, position, brand_canonical, suggested, score of each mention, in message order.

    A mention is the canonical name it equals but for case, or the one it is most like
    (``merge`` or more; the first added of equals), or a new one, with a suggestion from
    ``review`` on. Only names added before it count. Of the names that a brand is like,
    those count that beat all before them; a mention then takes the last of its time.
    """
    names = canonical_names(found, merge=merge)
    like = all_matches(found, names, "brand_clean", "name", at_least=review).join(names.withColumnRenamed("name", "match"), "match")
    before = Window.partitionBy("brand_clean").orderBy("added").rowsBetween(Window.unboundedPreceding, -1)
    # Scores rise strictly, so a brand has no more of these than there are scores.
    records = like.withColumn("most", F.max("fuzzy_score").over(before)).where("most is null or fuzzy_score > most")
    ranked = records.groupBy("brand_clean").agg(F.array_sort(F.collect_list(F.struct("added", (-F.col("fuzzy_score")).alias("s"), F.col("match").alias("name")))).alias("ranked"))
    equal = names.select(F.lower("name").alias("low"), F.col("name").alias("equal"), F.col("added").alias("equal_added"))
    rows = found.withColumn("at", F.struct("date", "message_id", "position")).withColumn("low", F.lower("brand_clean")).join(ranked, "brand_clean", "left").join(equal, "low", "left")
    best = F.try_element_at(F.filter("ranked", lambda r: r["added"] < F.col("at")), F.lit(-1))
    rows = rows.withColumn("best", best).withColumn("same", F.when(F.col("equal_added") < F.col("at"), F.col("equal")))
    hint = F.col("same").isNull() & (F.col("best.s") > -merge)
    name = F.coalesce("same", F.when(F.col("best.s") <= -merge, F.col("best.name")), F.col("brand_clean"))
    return rows.select("message_id", "position", name.alias("brand_canonical"), F.when(hint, F.col("best.name")).alias("suggested"), F.when(hint, -F.col("best.s")).alias("score"))


def brand_counts(found: DataFrame, canonical: DataFrame) -> DataFrame:
    """brand_canonical, count, first_seen, last_seen: most common first, of equals the one mentioned first."""
    joined = found.join(canonical, ["message_id", "position"])
    counts = joined.groupBy("brand_canonical").agg(F.count("*").alias("count"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.min(F.struct("date", "message_id", "position")).alias("_first"))
    return counts.orderBy(F.desc("count"), "_first").drop("_first")


def labelled(counts: DataFrame) -> DataFrame:
    """Counts with the trimmed candidate and its label and reason."""
    candidate = brands.apply_alias(brands.trim_commentary(F.col("brand_canonical")))
    return counts.withColumn("count", number_or_zero(F.col("count")).cast("long")).withColumn("candidate", candidate).withColumn("l", brands.brand_label(F.col("candidate"))).select("*", "l.label", "l.reason").drop("l")


def clean_brands(rows: DataFrame) -> DataFrame:
    return rows.where("label = 'keep'").groupBy(F.col("candidate").alias("brand_canonical_clean")).agg(F.sum("count").alias("count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
