"""Committees, their activity, companies and tickers: who has a PAC and who donated through it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.functions.companies import committee_norm, company_words_norm, looks_like_pac, match_norm
from corpgraph.operators.fuzzy import best_match
from corpgraph.operators.ops import first_per, number, number_or_zero, top_n, truthy


def corporate_pacs(committees: DataFrame) -> DataFrame:
    """Qualified corporate committees with a connected organisation."""
    return committees.where("CONNECTED_ORG_NM is not null and CMTE_TP = 'Q' and ORG_TP = 'C'").select("CMTE_ID", "CMTE_NM", "CONNECTED_ORG_NM", "CMTE_TP", "ORG_TP")


def with_activity(pacs: DataFrame, activity: DataFrame) -> DataFrame:
    """Left join on the normalised committee name; every activity row counts. HAS_DONATED is amount > 0."""
    act = activity.select(committee_norm(F.col("COMMITTEE_NAME")).alias("name_norm"), number_or_zero(F.col("TOTAL_AMOUNT")).alias("TOTAL_AMOUNT"), *[c for c in ("FIRST_CYCLE", "LAST_CYCLE") if c in activity.columns])
    out = pacs.withColumn("name_norm", committee_norm(F.col("CMTE_NM"))).join(act, "name_norm", "left")
    return out.withColumn("TOTAL_AMOUNT", F.coalesce("TOTAL_AMOUNT", F.lit(0.0))).withColumn("HAS_DONATED", F.col("TOTAL_AMOUNT") > 0)


def zero_activity(joined: DataFrame) -> DataFrame:
    return joined.where("TOTAL_AMOUNT = 0")


def company_status(joined: DataFrame) -> DataFrame:
    """One row an organisation that doesn't itself look like a PAC."""
    rolled = joined.where("CONNECTED_ORG_NM is not null").groupBy("CONNECTED_ORG_NM").agg(
        F.count_distinct("CMTE_ID").alias("pac_count"), F.count_if("HAS_DONATED").alias("active_pac_count"), F.bool_or("HAS_DONATED").alias("has_any_pac_donated"), F.sum("TOTAL_AMOUNT").alias("total_pac_amount")
    )
    return rolled.where(~looks_like_pac(F.col("CONNECTED_ORG_NM"))).withColumn("has_pac", F.lit(True)).withColumn("has_pac_donations", F.col("has_any_pac_donated"))


_FLAGS = ["has_pac", "has_pac_donations", "pac_count", "active_pac_count", "total_pac_amount"]


def _collapsed(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(*[f(c).alias(c) for f, c in zip((F.bool_or, F.bool_or, F.max, F.max, F.max), _FLAGS, strict=True)])


def superset(universe: DataFrame, crosswalk: DataFrame, status: DataFrame) -> DataFrame:
    """The universe of tickers with each one's PAC flags and pac_status."""
    flagged = status.select(company_words_norm(F.col("CONNECTED_ORG_NM")).alias("name_norm"), *[truthy(F.col(c)).alias(c) if c.startswith("has") else number(F.col(c)).alias(c) for c in _FLAGS])
    by_name = _collapsed(flagged, "name_norm")
    named = crosswalk.select("TICKER", company_words_norm(F.col("COMPANY_NAME")).alias("name_norm"))
    by_ticker = _collapsed(named.join(by_name, "name_norm").where("TICKER is not null"), "TICKER")
    out = universe.join(by_ticker, "TICKER", "left")
    for c in ("has_pac", "has_pac_donations"):
        out = out.withColumn(c, F.coalesce(c, F.lit(False)))
    status_of = F.when(~F.col("has_pac"), "NO_PAC").when(F.col("has_pac_donations"), "PAC_DONATED").otherwise("PAC_NO_DONATIONS")
    return out.withColumn("pac_status", status_of)


def in_cycles(receipts: DataFrame, cycles: list[int]) -> DataFrame:
    return receipts.where(number(F.col("ELECTION_CYCLE")).isin([float(c) for c in cycles]))


def match_receipts(receipts: DataFrame, committees: DataFrame, *, high: float = 95, review: float = 90, scores_below: bool = False) -> DataFrame:
    """Each receipt with the committee of the same normalised name, else the most similar one, and how it was found.

    fuzzy_score is that of the best committee if it reaches ``review``; with
    ``scores_below`` it is given however low, which scores far more pairs.
    """
    receipts = receipts.withColumn("cmte_norm", match_norm(F.col("COMMITTEE_NAME"))).where("cmte_norm <> ''")
    master = first_per(committees.withColumn("cmte_norm", match_norm(F.col("CMTE_NM"))).where("cmte_norm <> ''"), ["cmte_norm"], ["CMTE_ID"]).select("cmte_norm", "CMTE_ID", "CMTE_NM", "CONNECTED_ORG_NM", "CMTE_TP", "ORG_TP")
    residual = receipts.select("cmte_norm").distinct().join(master.select("cmte_norm"), "cmte_norm", "left_anti")
    best = best_match(residual, master, "cmte_norm", "cmte_norm", at_least=0 if scores_below else review)
    key = F.coalesce(F.when(F.col("fuzzy_score") >= review, F.col("best_norm")), F.col("cmte_norm"))
    joined = receipts.join(best, "cmte_norm", "left").withColumn("key", key).join(master.withColumnRenamed("cmte_norm", "key"), "key", "left")
    method = F.when(F.col("fuzzy_score").isNull() & F.col("CMTE_ID").isNotNull(), "NAME_EXACT").when(F.col("fuzzy_score") >= high, "FUZZY_HIGH").when(F.col("fuzzy_score") >= review, "FUZZY_REVIEW").otherwise("NO_MATCH")
    return joined.withColumn("match_method", method).withColumn("match_score", F.when(method == "NAME_EXACT", F.lit(100.0)).otherwise(F.col("fuzzy_score"))).drop("key")


def match_summary(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_method").agg(F.count("*").alias("rows"))


def match_rate(matches: DataFrame) -> DataFrame:
    return matches.agg(F.coalesce(F.try_divide(F.count_if(F.col("match_method") != "NO_MATCH"), F.count("*")), F.lit(0.0)).alias("match_rate"))


def top_unmatched(matches: DataFrame, n: int = 50) -> DataFrame:
    counts = matches.where("match_method = 'NO_MATCH'").groupBy("COMMITTEE_NAME").agg(F.count("*").alias("rows"))
    return top_n(counts, "rows", ["COMMITTEE_NAME"], n)
