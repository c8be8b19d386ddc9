"""Published figures of one real run: title categories, tickers of ambiguous companies, unmatched companies; and known values of the scorers."""

import pytest
from pyspark.sql import functions as F

from corpgraph.functions import companies, similarity, titles

# Standard titles with their categories and counts.
CATEGORIES = [
    ("Chief Executive Officer", "C-Suite: CEO", 2499),
    ("Director", "Director", 2097),
    ("Vice President", "VP/EVP/SVP", 1501),
    ("Chief Financial Officer", "C-Suite: CFO", 1447),
    ("President", "President", 1416),
    ("Other Executive", "Other Executive", 1260),
    ("Chief Technology Officer", "C-Suite: CTO", 443),
    ("General Counsel", "C-Suite: Legal", 330),
    ("Chief Operating Officer", "C-Suite: COO", 194),
    ("Corporate Secretary", "Corporate Secretary", 44),
    ("Treasurer / Controller", "Finance Officer", 43),
    ("Chief Marketing Officer", "C-Suite: CMO", 9),
]
TICKERS = [
    ("AG Mortgage Investment Trust, Inc.", "AG MORTGAGE INVESTMENT TRUST", "MITN|MITP|MITT|MITT.PRA|MITT.PRB|MITT.PRC", "MITN"),
    ("BANK OF AMERICA CORP /DE/", "BANK OF AMERICA", "BAC|BAC.PRB|BAC.PRE|BAC.PRK|BAC.PRL|BAC.PRM|BAC.PRN|BAC.PRO|BAC.PRP|BAC.PRQ|BAC.PRS|BACRP|BML.PRG|BML.PRH|BML.PRJ|BML.PRL|MER.PRK", "BAC"),
    ("FARMERS & MERCHANTS BANCORP", "FARMERS AND MERCHANTS BANCORP", "FMAO|FMCB", "FMAO"),
    ("Graf Global Corp.", "GRAF GLOBAL", "GRAF|GRAF.U", "GRAF"),
    ("Rigel Resource Acquisition Corp.", "RIGEL RESOURCE ACQUISITION", "RRAC.U|RRACF", "RRACF"),
]
UNMATCHED = [
    ("abrdn Gold ETF Trust", "ABRDN GOLD ETF TRUST", True),
    ("APPLIED MATERIALS INC /DE", "APPLIED MATERIALS INC DE", False),
    ("FIRST CITIZENS BANCSHARES INC /DE/", "FIRST CITIZENS BANCSHARES", False),
    ("Melar Acquisition Corp. I/Cayman", "MELAR ACQUISITION CORP I CAYMAN", False),
]


def test_categories(spark):
    rows = spark.createDataFrame(CATEGORIES, "title string, category string, n int")
    assert rows.where(titles.title_category(F.col("title")) != F.col("category")).count() == 0
    assert rows.where((F.col("title") != "Other Executive") & (titles.title_bucket(F.col("title")) != F.col("title"))).count() == 0
    assert sum(n for *_, n in CATEGORIES) == 11283


def test_company_norms_and_tickers(spark):
    rows = spark.createDataFrame(TICKERS, "company string, norm string, candidates string, common string")
    got = rows.select("norm", "common", companies.crosswalk_norm(F.col("company")).alias("n"), companies.common_ticker(F.split("candidates", r"\|")).alias("c")).collect()
    assert all((r.n, r.c) == (r.norm, r.common) for r in got)
    rows = spark.createDataFrame(UNMATCHED, "company string, norm string, fund boolean")
    got = rows.select("norm", "fund", companies.crosswalk_norm(F.col("company")).alias("n"), companies.looks_like_fund(F.col("norm")).alias("f")).collect()
    assert all((r.n, r.f) == (r.norm, r.fund) for r in got)


@pytest.mark.parametrize(
    "scorer,a,b,want",
    [
        ("ratio", "this is a test", "this is a test!", 96.55),
        ("partial_ratio", "this is a test", "this is a test!", 100),
        ("token_sort_ratio", "fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear", 100),
        ("token_sort_ratio", "fuzzy was a bear", "fuzzy fuzzy was a bear", 84.21),
        ("token_set_ratio", "fuzzy was a bear", "fuzzy fuzzy was a bear", 100),
        ("token_set_ratio", "fuzzy was a bear but not a dog", "fuzzy was a bear but not a cat", 92.31),
        ("ratio", "lewenstein", "levenshtein", 85.71),
        ("weighted_ratio", "this is a test", "this is a new test!!!", 85.5),
    ],
)
def test_known_scores(scorer, a, b, want):
    assert getattr(similarity, scorer)(a, b) == pytest.approx(want, abs=0.01)
