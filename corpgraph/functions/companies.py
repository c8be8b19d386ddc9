"""Company, committee and ticker names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpgraph.functions.common import collapse, decomposed, sub, text_of, words

# Words that normalisers drop, and suffixes.
COMMITTEE_WORDS = "pac|political|action|committee|fund|the|and|of|for|employees"
COMPANY_WORDS = "inc|incorporated|corp|corporation|co|company|llc|ltd|plc|sa|ag|nv"
SUBSIDIARY_WORDS = r"inc|inc\.|llc|l\.l\.c\.|corp|corporation|ltd|limited|company|co"
TRAILING = "INCORPORATED|INC|CORPORATION|CORP|COMPANY|CO|LIMITED|LTD|L L C|LLC|L P|LP|P L C|PLC|HOLDINGS|HOLDING|GROUP|THE"
MATCH_STOPWORDS = ["THE", "AND", "OF", "FOR", "TO", "A", "AN", "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "LLC", "LTD", "LIMITED", "LP", "LLP", "HOLDING", "HOLDINGS", "GROUP"]
LEGAL_SUFFIXES = ["INC", "CORP", "CO", "LTD", "LLC", "PLC", "GROUP", "HOLDINGS", "HLDGS", "COM", "COMPANY"]
DOMAIN = r"(?i)^[A-Za-z0-9\-]+\.(com|org|net|io|co|ai|gov|edu|biz|info)$"
FUND = r"\b(ETF|TRUST|FUND|PORTFOLIO|ETN)\b"
PREFERRED = r"(\.PR|\.PRA|\.PRB|\.PRC|\.PRD|\.PRE|\.PRF|\.PRG|\.PRH|\.PRI|\.PRJ|\.PRK|\.PRL)\b|(\-PR[A-Z]?)\b|\b(W|WS|WT|R|RT|U)\b$"


def match_norm(name: Column) -> Column:
    """Upper case A-Z, 0-9 words without stop words: the key of committee matching."""
    kept = words(sub(F.upper(text_of(name)), "[^A-Z0-9 ]+"))
    return F.array_join(F.filter(kept, lambda w: ~w.isin(MATCH_STOPWORDS)), " ")


def committee_norm(name: Column) -> Column:
    return collapse(sub(sub(F.lower(text_of(name)), r"[^a-z0-9\s]"), rf"\b({COMMITTEE_WORDS})\b"))


def company_words_norm(name: Column) -> Column:
    """Lower case without legal words anywhere in the name."""
    return collapse(sub(sub(F.lower(text_of(name)), r"[^a-z0-9\s]"), rf"\b({COMPANY_WORDS})\b"))


def crosswalk_norm(name: Column) -> Column:
    """Upper case and decomposed (marks part words), ``&`` as AND, no /XX/ tags or punctuation, and no legal words at the end, however many."""
    s = F.replace(decomposed(F.trim(F.upper(text_of(name)))), F.lit("&"), F.lit(" AND "))
    s = collapse(sub(sub(s, "/[A-Z]{2,3}/"), "[^A-Z0-9]+"))
    return sub(s, f"(?: (?:{TRAILING}))+$", "")


def subsidiary_norm(name: Column) -> Column:
    s = sub(F.trim(F.lower(name)), rf"\b({SUBSIDIARY_WORDS})\b", "")
    return collapse(sub(s, "[.,]", ""))


def match_name(name: Column) -> Column:
    """Lower case with ``&`` as and, without commas and periods."""
    return F.trim(F.translate(F.replace(F.lower(text_of(name)), F.lit("&"), F.lit("and")), ",.", ""))


def index_title(title: Column) -> Column:
    """Lower case without punctuation; here ``&`` is gone before it could become and."""
    return F.trim(sub(F.lower(text_of(title)), r"(?U)[^\w\s]", ""))


def slug(text: Column) -> Column:
    made = F.regexp_replace(sub(F.lower(text_of(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(made == "", F.lit("unknown-company")).otherwise(made)


def looks_like_pac(name: Column) -> Column:
    return F.lower(text_of(name)).rlike(r"\b(pac|political action committee)\b")


def looks_like_fund(norm: Column) -> Column:
    return F.coalesce(norm.rlike(FUND), F.lit(False))


def _plain_part(part: Column) -> Column:
    upper = F.upper(part)
    capital = F.concat(F.upper(F.left(part, F.lit(1))), F.lower(F.substr(part, F.lit(2))))
    return (
        F.when(part.rlike(r"^\d+[A-Za-z]\d+$"), F.lower(part))
        .when(part.rlike("^[A-Z]{2,4}$") & ~part.isin(LEGAL_SUFFIXES), part)
        .when(part.rlike(r"^\d[A-Z]$"), part)
        .when(upper.isin("LLC", "PLC"), upper)
        .otherwise(capital)
    )


def search_name(name: Column) -> Column:
    """A name cased for web search: acronyms stay, domains are lower case, the rest is capitalised."""
    name = F.trim(text_of(name))

    def token(t: Column) -> Column:
        hyphened = t.contains("-") & ~t.startswith("-") & ~t.endswith("-")
        return F.when(t.rlike(DOMAIN), F.lower(t)).when(hyphened, F.array_join(F.transform(F.split(t, "-"), _plain_part), "-")).otherwise(_plain_part(t))

    return F.when(name.rlike(DOMAIN), F.lower(name)).otherwise(F.array_join(F.transform(words(name), token), " "))


def common_ticker(candidates: Column) -> Column:
    """The least ticker that isn't a preferred share, warrant, right or unit; else the least; null for none."""
    up = F.transform(F.filter(candidates, lambda x: x.isNotNull()), lambda x: F.upper(F.trim(x)))
    return F.coalesce(F.array_min(F.filter(up, lambda x: ~x.rlike(PREFERRED))), F.array_min(up))


def ten_digit_cik(cik: Column) -> Column:
    return F.lpad(F.replace(cik.cast("string"), F.lit(".0"), F.lit("")), 10, "0")
