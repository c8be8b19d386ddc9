"""Text functions and scorers against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from corpgraph.functions import brands, companies, people, similarity, titles, web
from corpgraph.functions.alerts import events_in
from corpgraph.plans.bundles import names_in_exhibit
from corpgraph.streaming.ingest import plain_text


def apply(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


CASES = [
    (companies.crosswalk_norm, {"Acme Holdings Co Inc. The": "ACME", "AT&T Inc": "AT AND T", "Nestlés /DE/": "NESTLE S", None: "", "Inc": "INC"}),
    (companies.committee_norm, {"The Acme PAC of Employees": "acme", None: "", "X-Y Fund!": "x y"}),
    (companies.company_words_norm, {"Acme Co Ltd": "acme", "Corp of Corp": "of"}),
    (companies.match_norm, {"The Acme & Co. of Group": "ACME", "": "", None: ""}),
    (companies.subsidiary_norm, {"Acme L.L.C.": "acme llc", "co-op bank": "-op bank", None: None}),
    (companies.slug, {"Acme & Co.": "acme-co", "---": "unknown-company", None: "unknown-company"}),
    (companies.search_name, {"IBM CORP": "IBM Corp", "acme llc": "Acme LLC", "8X8 INC": "8x8 Inc", "Shop.COM": "shop.com", "COCA-COLA": "COCA-COLA", None: ""}),
    (companies.ten_digit_cik, {"123.0": "0000000123", None: None}),
    (titles.title_bucket, {"Executive Vice President": "Vice President", "President and CEO": "Chief Executive Officer", "svp": "Other Executive", "advice president": "Other Executive", "Company President": "President", None: "Other Executive"}),
    (titles.clean_title, {"<b>CFO</b>": "Chief Financial Officer", "N/A": "N/A", "none": None, "head of x": "Head Of X", None: None}),
    (people.best_name, {"JaneRoe Smith": "Jane Roe Smith", "Chief Officer": None, "Ludwig van Beethoven": "Ludwig van Beethoven", None: None}),
    (people.is_valid_name, {"Jane Roe": True, "Vincent Vega": False, "J 2": False, "IBM": False, "a b c d e f g": False, None: False}),
    (brands.trim_commentary, {"Acme in Ohio, yes": "Acme", "Acme: best": "Acme", "Acme Foods Int (x)": "Acme Foods Int"}),
    (brands.clean_candidate, {"is it good": None, "why? Acme": "Acme", "i think so. Acme": "Acme", "gas": None, "www.x.com": None, "Acme": "Acme"}),
    (brands.normalize_brand, {"domino's pizza!": "Domino'S Pizza", "H&M": "H&M", "7-eleven": "7-Eleven"}),
    (web.domain, {"https://a.b.co.uk/x": "b.co.uk", "http://www.acme.com:80": "acme.com", "nothing": None, None: None}),
    (web.is_noise, {"https://netflix.com": True, "https://acme.org": False, None: False}),
]


@pytest.mark.parametrize("f,cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_column_function(spark, f, cases):
    assert apply(spark, f, list(cases)) == list(cases.values())


def test_common_ticker(spark):
    rows = [(["ATH.PRA", "ATHS"], "ATHS"), (["RRAC.U", "RRACF"], "RRACF"), (["X.PRA"], "X.PRA"), (["ANSCU", "B"], "ANSCU"), ([], None), (None, None)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rows)], "i int, c array<string>")
    assert [r.t for r in df.select("i", companies.common_ticker(F.col("c")).alias("t")).orderBy("i").collect()] == [w for _, w in rows]


def test_brand_labels(spark):
    cases = {"": "empty", "Stop": "drop_exact", "x.com": "url_or_email", "Café": "weird_chars", "i think Acme": "commentary", "A " * 9: "too_long", "Acme": "ok"}
    assert [r.reason for r in apply(spark, brands.brand_label, list(cases))] == list(cases.values())


def test_split_brands():
    assert brands.split_one("Acme and Globex") == ["Acme", "Globex"]
    assert brands.split_one("Foods (Oat, Rye), X / Y. Based in Ohio") == ["Foods", "Oat", "Rye", "X", "Y"]
    assert brands.split_one("Wine and Spirits Shop, Rum and vodka") == ["Wine and Spirits Shop", "Rum and vodka"]
    assert brands.split_one(None) == []


def test_scorers():
    assert similarity.common_subsequence("abcbdab", "bdcaba") == 4
    assert similarity.token_set_ratio("ACME WORKERS", "WORKERS ACME X") == 100
    assert similarity.token_set_ratio("", "a") == 0
    assert round(similarity.ratio("this is a test", "this is a test!"), 2) == 96.55
    assert similarity.weighted_ratio("acme", "acme") == 100


def test_texts():
    assert names_in_exhibit("<table><tr><th>Name</th></tr><tr><td>Acme <b>LLC</b></td><td>DE</td></tr><tr><td>No</td></tr></table>") == ["Acme LLC"]
    assert names_in_exhibit("<p>Acme Inc<br>\nnothing</p>") == ["Acme Inc"]
    assert names_in_exhibit(None) == []
    assert plain_text('{"mimeType":"m","parts":[{"mimeType":"text/html","body":{"data":"eA"}},{"parts":[{"mimeType":"text/plain","body":{"data":"aGk"}}]}]}') == "hi"
    rows = events_in("Date: x\nAcme\nSoftware\nSubsidiary of G\nChanges\nA (posted on x).B (posted on y)\n\nView the new org chart of Acme\nrest")
    assert rows == [("Acme", "Software", "G", "Changes", "A (posted on x)."), ("Acme", "Software", "G", "Changes", "B (posted on y)")]
