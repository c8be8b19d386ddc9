"""Executives: extraction from filings, cleaning, titles, tickers, and change events."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.functions import companies, people, titles
from corpgraph.functions.alerts import alert_lines, alert_text
from corpgraph.functions.common import text_of
from corpgraph.functions.events import parse_event
from corpgraph.operators.ops import first_per, frequencies, not_done, sorted_set
from corpgraph.schemas import EVENT_FIELDS

Tagger = Callable[[str], list[tuple[int, int]]]
# Patterns of names and titles in filings.
_NAME = r"([A-Z][a-zA-Z.\s]+?)"
SIGNED = re.compile(rf"By:\s*/s/\s*{_NAME}\s*\n\s*(?:Name:\s*)?{_NAME}\s*\n\s*(?:Title:\s*)?([^\n]+?)(?=\n\s*Date:|\n\n|\Z)")
INLINE = re.compile(r"([A-Z][a-z]+(?:\s+[A-Z]\.?)?\s+[A-Z][a-z]+),\s*(Chief\s+\w+\s+Officer|President|Vice\s+President|General\s+Counsel|Director)", re.I)
INLINE_TITLE = re.compile(r",\s*(?:Chief\s+\w+\s+Officer|President|Vice\s+President|General\s+Counsel|Director)", re.I)
LABELLED = re.compile(rf"By:\s*/s/\s*{_NAME}\s*Name:\s*{_NAME}\s*Title:\s*([A-Za-z\s,&]+)")
WINDOW_TITLE = re.compile(r"(ceo|chief\s+[a-z]+\s+officer|cfo|coo|cto|president|vice\s+president|general\s+counsel|corporate\s+secretary|chairman|director|treasurer)")
WINDOW_WORDS = re.compile("chief|officer|president|counsel|secretary|chairman|treasurer|director|ceo|cfo|coo|cto")
ROLES = re.compile(titles.ROLE_WORDS)
DEFAULT_NAME = re.compile(people.NAME_SPAN)
CONFIDENCE = ["high", "medium", "spacy", "low"]


def default_tagger(text: str) -> list[tuple[int, int]]:
    """Capitalised-name spans, where no entity recogniser is at hand: finds fewer people than one would."""
    return [m.span() for m in DEFAULT_NAME.finditer(text)]


def spans_in(tagger: Tagger, texts: Sequence[str]) -> list[list[tuple[int, int]]]:
    """Spans of each text, all at once where the tagger can (``many``)."""
    many = getattr(tagger, "many", None)
    return many(texts) if many else [tagger(x) for x in texts]


def mentions_in(text: str, tagger: Tagger) -> list[tuple[str, str, str]]:
    """(name, title, confidence) in order of the rules: signed, inline, labelled, tagged."""
    two = lambda s: len(s.split()) > 1
    titled = lambda s: bool(ROLES.search(s.lower()))
    # Most texts hold no signature and no title after a comma, which is seen sooner than that no pattern fits.
    signed, out = "By:" in text, []
    for _, name, title in SIGNED.findall(text) if signed else ():
        title = re.sub(r"\s*Date:.*", "", title).strip()
        if two(name) and titled(title):
            out.append((name.strip(), title, "high"))
    out += [(n.strip(), t.strip(), "low") for n, t in (INLINE.findall(text) if INLINE_TITLE.search(text) else ()) if two(n) and titled(t)]
    for signer, name, title in LABELLED.findall(text) if signed else ():
        name = name.strip() if two(name) else signer.strip()
        if two(name) and titled(title):
            out.append((name, title.strip(), "high"))
    text = text.replace("\xa0", " ")
    for a, b in tagger(text):
        name, around = text[a:b].strip(), text[max(0, a - 150) : b + 150].lower()
        if two(name) and not re.search("item|section|exhibit|entry", name.lower()) and WINDOW_WORDS.search(around):
            found = WINDOW_TITLE.search(around)
            out.append((name, found[1].title() if found else "Unknown", "spacy"))
    return out


def chunks(filings: DataFrame, text: str = "raw_text", size: int = 1_500_000) -> DataFrame:
    """One row for each stretch of ``size`` characters, without overlap: chunk_no, chunk."""
    n = F.greatest(F.lit(1), F.ceil(F.length(text) / size))
    return filings.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))).withColumn("chunk", F.substr(F.col(text), F.col("chunk_no") * size + 1, F.lit(size)))


def raw_executives(filings: DataFrame, order: str, tagger: Tagger = default_tagger, *, size: int = 1_500_000, done: DataFrame | None = None) -> DataFrame:
    """Each company's first filing: its mentions, one of each name a chunk, the surest first seen.

    Companies among ``done`` (an earlier run's output) are left out.
    """

    @F.pandas_udf("array<struct<executive_name string, executive_title string, confidence string>>")
    def extract(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            whole = [x or "" for x in t]
            spans = spans_in(tagger, [x.replace("\xa0", " ") for x in whole])
            yield pd.Series([mentions_in(x, lambda _, s=s: s) for x, s in zip(whole, spans, strict=True)], dtype=object)

    cut = chunks(first_per(not_done(filings, done, "company_name", "company"), ["company_name"], [order]), size=size)
    found = cut.select(F.col("company_name").alias("company"), F.col("sec_filing_type").alias("filing_type"), "chunk_no", F.posexplode(extract("chunk")).alias("at", "m")).select("company", "filing_type", "chunk_no", "at", "m.*")
    rank = F.array_position(F.array(*[F.lit(c) for c in CONFIDENCE]), F.col("confidence"))
    keyed = found.withColumn("_name", F.lower(F.trim("executive_name"))).withColumn("_rank", rank)
    return first_per(keyed, ["company", "chunk_no", "_name"], ["_rank", "at"]).drop("_name", "_rank")


def person_names(tagger: Tagger):
    """A column function: the first person whom the tagger finds in a text, else null."""

    @F.pandas_udf("string")
    def first(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            whole = [x or "" for x in t]
            yield pd.Series([next((x[a:b].strip() for a, b in s), None) for x, s in zip(whole, spans_in(tagger, whole), strict=True)], dtype=object)

    return first


def people_in(tagger: Tagger):
    """A column function: all people whom the tagger finds in a text, in their order; none for null."""

    @F.pandas_udf("array<string>")
    def every(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            whole = [x or "" for x in t]
            yield pd.Series([[x[a:b] for a, b in s] for x, s in zip(whole, spans_in(tagger, whole), strict=True)], dtype=object)

    return every


def clean_names(raw: DataFrame) -> DataFrame:
    """Low-confidence names repaired; rows whose name then doesn't look like one go."""
    low = F.lower("confidence") == "low"
    name = F.when(low, people.best_name(F.col("executive_name"))).otherwise(F.col("executive_name"))
    return raw.withColumn("executive_name", name).withColumn("_low", low.cast("int")).where(people.looks_like_name(F.col("executive_name")))


def tagged_names(rows: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Names as a second tagger pass finds them (none: as they are), without contact words; invalid ones go, and one row a name stays."""
    name = person_names(tagger)("executive_name") if tagger else F.col("executive_name")
    named = rows.withColumn("executive_name", people.drop_contact_words(name)).where(people.is_valid_name(F.col("executive_name")))
    return first_per(named, ["executive_name"], ["_low", "company", "chunk_no", "at"]).drop("_low")


def final_executives(raw: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """Names cleaned, then tagged; titles cleaned; one row a name and title."""
    one = tagged_names(clean_names(raw), tagger).withColumn("executive_title_clean", titles.clean_title(F.col("executive_title")))
    return one.dropDuplicates(["executive_name", "executive_title_clean"])


def confidence_counts(execs: DataFrame) -> DataFrame:
    """confidence, count: most frequent first."""
    return frequencies(execs, "confidence").orderBy(F.desc("count"), "confidence")


def of_company(rows: DataFrame, name: str, column: str = "company") -> DataFrame:
    """Rows of one company, whatever the case and the blanks around its name."""
    return rows.where(F.lower(F.trim(column)) == name.strip().lower())


def executive_summary(execs: DataFrame) -> DataFrame:
    return execs.agg(F.count("*").alias("total_rows"), F.count_distinct("executive_name").alias("unique_executives"), F.count_distinct("executive_title").alias("unique_titles"), F.count_distinct("company").alias("unique_companies"))


def title_summary(execs: DataFrame, title: str = "executive_title_clean") -> DataFrame:
    bucketed = execs.withColumn("title_standard", titles.title_bucket(titles.tidy_title(F.col(title))))
    return frequencies(bucketed.withColumn("category", titles.title_category(F.col("title_standard"))), "title_standard", "category")


def category_share(summary: DataFrame) -> DataFrame:
    by = summary.groupBy("category").agg(F.sum("count").alias("count"))
    total = summary.agg(F.sum("count").alias("total"))
    return by.join(F.broadcast(total)).select("category", "count", (F.col("count") / F.col("total")).alias("share"))


def ticker_map(crosswalk: DataFrame) -> DataFrame:
    """company_norm with its sorted distinct tickers."""
    return crosswalk.withColumn("company_norm", companies.crosswalk_norm(F.col("COMPANY_NAME"))).groupBy("company_norm").agg(sorted_set(F.col("TICKER")).alias("ticker_candidates"))


def with_tickers(execs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Executives with their company's tickers: all, the least, whether there are several, and the common share's."""
    out = execs.withColumn("company_norm", companies.crosswalk_norm(F.col("company"))).join(ticker_map(crosswalk), "company_norm", "left")
    out = out.withColumn("TICKER", F.get("ticker_candidates", F.lit(0))).withColumn("ticker_ambiguous", F.coalesce(F.size("ticker_candidates") > 1, F.lit(False)))
    return out.withColumn("TICKER_COMMON", companies.common_ticker(F.col("ticker_candidates")))


def baseline_tickers(execs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    key = lambda c: F.upper(F.trim(text_of(F.col(c))))
    return execs.withColumn("_key", key("company")).join(crosswalk.select(key("COMPANY_NAME").alias("_key"), "TICKER"), "_key", "left").drop("_key")


def baseline_rate(execs: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """null_rate, n over the rows of ``baseline_tickers``, which are counted by key instead of made."""
    key = lambda c: F.upper(F.trim(text_of(F.col(c))))
    asked = execs.groupBy(key("company").alias("_key")).agg(F.count("*").alias("asked"))
    held = crosswalk.groupBy(key("COMPANY_NAME").alias("_key")).agg(F.count("*").alias("held"), F.count_if(F.col("TICKER").isNull()).alias("blank"))
    rows = asked.join(held, "_key", "left").select((F.col("asked") * F.coalesce("held", F.lit(1))).alias("rows"), (F.col("asked") * F.coalesce("blank", F.lit(1))).alias("blank"))
    return rows.agg(F.try_divide(F.sum("blank"), F.sum("rows")).alias("null_rate"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))


def unmatched(enriched: DataFrame) -> DataFrame:
    """Companies without a ticker, in order of their normalised names."""
    return enriched.where("TICKER is null").select("company", "company_norm").distinct().orderBy("company_norm", "company")


def ambiguous(enriched: DataFrame) -> DataFrame:
    return enriched.where("ticker_ambiguous").select("company", "company_norm", F.array_join("ticker_candidates", "|").alias("ticker_candidates_str"), "TICKER_COMMON").distinct()


def ambiguous_norms(enriched: DataFrame) -> DataFrame:
    """The ambiguous log with one row a normalised name, its first company's."""
    return first_per(ambiguous(enriched), ["company_norm"], ["company"])


def triage(lost: DataFrame) -> DataFrame:
    return lost.withColumn("looks_like_fund_or_etf", companies.looks_like_fund(F.col("company_norm")))


def change_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """Alert lines with the parsed event's fields."""
    return lines.withColumn("e", parse_event(F.col(line))).select(*[c for c in lines.columns if c != line], "e.*")


def alert_events(messages: DataFrame) -> DataFrame:
    """Events of alert messages (message_id, date, subject, body), one row each."""
    lines = messages.select("message_id", F.col("date").alias("email_date"), F.col("subject").alias("email_subject"), F.explode(alert_lines(alert_text(F.col("body")))).alias("x"))
    return change_events(lines.select("message_id", "email_date", "email_subject", "x.*")).select(*EVENT_FIELDS)


def failures(events: DataFrame) -> DataFrame:
    return events.where("event_type = 'unparsed'")
