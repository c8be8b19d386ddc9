"""Executive titles: cleaning, twelve buckets, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpgraph.functions.common import collapse, first_match, sub, text_of, title_case

# Ordered title rules.
CLEAN_RULES = [
    (r"\bceo\b|chief exec(utive)? officer", "Chief Executive Officer"),
    (r"\bcoo\b|chief operating officer", "Chief Operating Officer"),
    (r"\bcfo\b|chief financial officer", "Chief Financial Officer"),
    (r"\bcio\b|chief information officer", "Chief Information Officer"),
    (r"\bcto\b|chief technology officer", "Chief Technology Officer"),
    (r"\bchro\b|chief human resources officer", "Chief Human Resources Officer"),
    (r"\bcmo\b|chief marketing officer", "Chief Marketing Officer"),
    (r"\bcso\b|chief strategy officer", "Chief Strategy Officer"),
    (r"\bcro\b|chief risk officer", "Chief Risk Officer"),
    (r"\bvp\b|vice pres(ident)?", "Vice President"),
    (r"\bpresident\b", "President"),
    (r"\bchair(man|woman)?\b", "Chair"),
    (r"\bmanaging dir(ector)?\b", "Managing Director"),
    (r"\bexec(utive)? dir(ector)?\b", "Executive Director"),
    (r"\bboard member\b|director\b", "Director"),
]
BUCKET_RULES = [
    (r"\b(ceo|chief executive)\b", "Chief Executive Officer"),
    (r"\b(vice|svp|evp)\s+president\b", "Vice President"),
    (r"(?<!vice\s)(?<!svp\s)(?<!evp\s)\bpresident\b", "President"),
    (r"\b(coo|chief operating)\b", "Chief Operating Officer"),
    (r"\b(cfo|chief financial)\b", "Chief Financial Officer"),
    (r"\b(cto|cio|chief technology|chief information)\b", "Chief Technology Officer"),
    (r"\b(cmo|chief marketing)\b", "Chief Marketing Officer"),
    (r"\b(general counsel|chief legal|chief counsel|clo)\b", "General Counsel"),
    (r"\bdirector\b", "Director"),
    (r"\b(treasurer|controller|finance)\b", "Treasurer / Controller"),
    (r"\b(secretary)\b", "Corporate Secretary"),
]
CATEGORY_RULES = [
    ("Executive Officer", "C-Suite: CEO"),
    ("Financial Officer", "C-Suite: CFO"),
    ("Operating Officer", "C-Suite: COO"),
    ("Technology Officer", "C-Suite: CTO"),
    ("Marketing Officer", "C-Suite: CMO"),
    ("General Counsel", "C-Suite: Legal"),
    (r"(?i)\bVice President\b", "VP/EVP/SVP"),
    (r"(?i)\bPresident\b", "President"),
    ("Director", "Director"),
    ("Treasurer|Controller", "Finance Officer"),
    ("Secretary", "Corporate Secretary"),
]
ROLE_WORDS = "chief|officer|president|counsel|secretary|chairman|director|treasurer"


def is_executive_title(title: Column) -> Column:
    return F.lower(title).rlike(ROLE_WORDS)


def clean_title(title: Column) -> Column:
    """The first of ``CLEAN_RULES`` that fits; else title case; null for placeholders."""
    kept = collapse(sub(sub(title, "<.*?>"), r"[^A-Za-z\s&\-./]"))
    low = F.lower(kept)
    return F.when(low.isin("na", "n a", "none", "null", "—", "-", "", "0"), F.lit(None)).otherwise(first_match(low, CLEAN_RULES, title_case(kept)))


def tidy_title(title: Column) -> Column:
    """Title case, letters and white space only; null and unknown give ``Unknown``."""
    out = sub(title_case(F.trim(title)), r"[^a-zA-Z\s]", "")
    return F.when(title.isNull() | out.rlike(r"^(?i)Unknown\s*$"), F.lit("Unknown")).otherwise(out)


def title_bucket(title: Column) -> Column:
    low = F.trim(F.lower(text_of(title)))
    return F.when(low.isin("unknown", "na", "n/a", "none", ""), F.lit("Other Executive")).otherwise(first_match(low, BUCKET_RULES, F.lit("Other Executive")))


def title_category(bucket: Column) -> Column:
    return first_match(text_of(bucket), CATEGORY_RULES, F.lit("Other Executive"))
