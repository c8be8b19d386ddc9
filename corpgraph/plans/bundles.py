"""Subsidiaries, contacts, and the nested bundle of each company."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpgraph.functions import companies
from corpgraph.functions.common import text_of
from corpgraph.operators.fuzzy import best_match
from corpgraph.operators.ops import first_per, not_done

# Words that mark a legal entity, and header cells.
ENTITY = re.compile(r"\b(inc|llc|ltd|corp|co|company|bank|group)\b", re.I)
HEADERS = {"name", "subsidiary", "entity", "company"}


class _Cells(HTMLParser):
    """First cells of table rows, and the text outside scripts."""

    def __init__(self):
        super().__init__()
        self.cells: list[str] = []
        self.text: list[str] = []
        self.tables, self.cell, self.done = 0, None, True

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.tables += 1
        elif tag == "tr" and self.tables:
            self.done = False
        elif tag in ("td", "th") and self.tables and not self.done and self.cell is None:
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr") and self.cell is not None:
            self.cells.append(" ".join(self.cell))
            self.cell, self.done = None, True
        if tag == "table":
            self.tables = max(0, self.tables - 1)

    def handle_data(self, data):
        self.text.append(data)
        if self.cell is not None and data.strip():
            self.cell.append(data.strip())


def names_in_exhibit(html: str | None) -> list[str]:
    """First cells that name an entity; without any, all lines that do."""
    p = _Cells()
    p.feed(html or "")
    p.close()
    found = [c for c in p.cells if c.lower() not in HEADERS and len(c) > 2 and ENTITY.search(c)]
    return found or [x.strip() for x in "\n".join(p.text).split("\n") if ENTITY.search(x)]


@F.pandas_udf(ArrayType(StringType()))
def exhibit_names(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for h in html:
        yield h.map(names_in_exhibit)


def subsidiaries(exhibits: DataFrame) -> DataFrame:
    """One row a subsidiary of exhibits (parent_name, parent_cik, source_url, html)."""
    out = exhibits.select("parent_name", "parent_cik", "source_url", F.explode(exhibit_names("html")).alias("subsidiary_name_raw"))
    return out.withColumn("subsidiary_name_clean", companies.subsidiary_norm(F.col("subsidiary_name_raw"))).withColumn("source_type", F.lit("Exhibit 21")).withColumn("confidence", F.lit(1.0)).withColumn("extraction_notes", F.lit(""))


def exhibit_reason(rows: DataFrame) -> DataFrame:
    """has_exhibit21 and reason from nullable cik, accession and exhibit_url, and error where there is such a column."""
    reason = F.when(no_cik(F.col("cik")), "Missing CIK")
    if "error" in rows.columns:
        reason = reason.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), "error"))
    reason = (
        reason
        .when(F.col("accession").isNull(), "No 10-K found")
        .when(F.col("exhibit_url").isNull(), "10-K found, but Exhibit-21 missing")
        .otherwise("Exhibit-21 found")
    )
    return rows.withColumn("reason", reason).withColumn("has_exhibit21", reason == "Exhibit-21 found")


def master(log: DataFrame, subs: DataFrame) -> DataFrame:
    """The exhibit log with its subsidiaries; missing text is empty."""
    keyed = subs.withColumnsRenamed({"parent_name": "company_name", "parent_cik": "cik"})
    return log.join(keyed, ["company_name", "cik"], "left").na.fill("").orderBy(F.desc("has_exhibit21"), "company_name")


def with_ciks(names: DataFrame, index: DataFrame, threshold: float = 85) -> DataFrame:
    """company_name with the cik of the most similar index title, if similar enough."""
    keyed = names.withColumn("k", companies.match_name(F.col("company_name")))
    titled = index.withColumn("t", companies.index_title(F.col("title")))
    best = best_match(keyed, titled, "k", "t", scorer="weighted", at_least=threshold)
    ciks = titled.groupBy("t").agg(F.min("cik").alias("cik"))
    good = best.where(F.col("fuzzy_score") >= threshold).join(ciks, F.col("best_norm") == ciks.t).select("k", "cik", "fuzzy_score")
    return keyed.join(good, "k", "left").drop("k")


def repaired(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Old values unless blank, else the new ones."""
    joined = old.alias("o").join(new.alias("n"), key, "left")
    fixed = {c: F.when(F.trim(text_of(F.col(f"o.{c}"))) == "", F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) for c in columns}
    return joined.select(*[fixed.get(c, F.col(c if c == key else f"o.{c}")).alias(c) for c in old.columns])


def bundles(contacts: DataFrame, subs: DataFrame, company: str = "company") -> DataFrame:
    """company_name with its contacts and subsidiaries as sorted arrays, and their numbers; companies of either side."""

    def grouped(df: DataFrame, name: str) -> DataFrame:
        rest = [c for c in df.columns if c != company]
        return df.where(f"{company} is not null").groupBy(F.trim(F.col(company)).alias("company_name")).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))

    out = grouped(contacts, "contacts").join(grouped(subs, "subsidiaries"), "company_name", "full_outer")
    return out.withColumn("contacts_count", F.coalesce(F.size("contacts"), F.lit(0))).withColumn("subsidiaries_count", F.coalesce(F.size("subsidiaries"), F.lit(0)))


def _children(df: DataFrame, company: str) -> DataFrame:
    """company_name and x, the rest of the row, of rows with a company."""
    return df.where(F.col(company).isNotNull()).select(F.trim(F.col(company)).alias("company_name"), F.struct(*[c for c in df.columns if c != company]).alias("x"))


def summaries(contacts: DataFrame, subs: DataFrame, company: str = "company") -> DataFrame:
    """company_name, contacts_count, subsidiaries_count of companies of either side, without gathering their rows."""
    sides = _children(contacts, company).select("company_name", F.lit(1).alias("c"), F.lit(0).alias("s")).unionByName(_children(subs, company).select("company_name", F.lit(0).alias("c"), F.lit(1).alias("s")))
    return sides.groupBy("company_name").agg(F.sum("c").cast("int").alias("contacts_count"), F.sum("s").cast("int").alias("subsidiaries_count"))


def documents(contacts: DataFrame, subs: DataFrame, company: str = "company") -> DataFrame:
    """path, json: one document a company, and one for each contact and subsidiary below it, numbered from 0 in order of their fields."""
    root = F.concat(F.lit("companies/"), companies.slug(F.col("company_name")))
    plain = {"ignoreNullFields": "true"}
    out = summaries(contacts, subs, company).select(root.alias("path"), F.to_json(F.struct("company_name", "contacts_count", "subsidiaries_count"), plain).alias("json"))
    for name, side in (("contacts", contacts), ("subsidiaries", subs)):
        at = F.row_number().over(Window.partitionBy("company_name").orderBy("x")) - 1
        out = out.unionByName(_children(side, company).withColumn("at", at).select(F.format_string(f"%s/{name}/%05d", root, F.col("at")).alias("path"), F.to_json("x", plain).alias("json")))
    return out


def no_cik(cik: Column) -> Column:
    return F.trim(F.coalesce(cik.cast("string"), F.lit(""))).isin("", "nan")


def add_ciks(names: DataFrame, index: DataFrame, threshold: float = 85) -> DataFrame:
    """company_name, cik, ...: rows that have a cik stay as they are, the others are matched with the index."""
    if "cik" not in names.columns:
        return with_ciks(names, index, threshold).drop("fuzzy_score")
    lost = with_ciks(names.where(no_cik(F.col("cik"))).drop("cik"), index, threshold).drop("fuzzy_score")
    return names.where(~no_cik(F.col("cik"))).unionByName(lost.select(*names.columns))


def extract_all(exhibits: DataFrame, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Subsidiaries of companies (parent_name, parent_cik, source_url, html, error) and the rows that failed.

    Each cik counts once, its first parent by name; rows without a cik and those with
    one among ``done`` (parent_cik) are skipped. Rows with an error are failures.
    """
    rows = exhibits.withColumn("parent_cik", F.trim(F.replace(F.col("parent_cik").cast("string"), F.lit(".0"), F.lit("")))).where(~no_cik(F.col("parent_cik")))
    one = first_per(not_done(rows, done, "parent_cik"), ["parent_cik"], ["parent_name", "source_url"])
    failed = one.where("error is not null").select("parent_name", "parent_cik", "error")
    return subsidiaries(one.where("error is null")), failed
