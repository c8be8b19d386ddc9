"""Contacts from search tables, connectors, and functions registered for SQL."""

from __future__ import annotations

from corpgraph.catalog.base import values
from corpgraph.functions import registry, web
from corpgraph.plans import bundles, contacts
from corpgraph.sources import connectors
from pyspark.sql import functions as F

_SEARCHES = [
    ("Acme Tools Inc official website", "1", "https://en.wikipedia.org/wiki/Acme"),
    ("Acme Tools Inc official website", "2", "https://www.acmetools.com/about"),
    ("Acme Tools Inc homepage", "1", "https://acme.org"),
    ("Acme Tools Inc investor site:acmetools.com", "1", "https://acmetools.com/investors"),
    ("Acme Tools Inc help site:acmetools.com", "1", "https://acmetools.com/help"),
    ("Acme Tools Inc official twitter x", "1", "https://twitter.com/acme/status/1"),
    ("Acme Tools Inc official twitter x", "2", "https://twitter.com/acme"),
    ("Acme Tools Inc official bluesky", "1", "https://bsky.app/profile/acme"),
    ("Globex official website", "1", "https://www.amazon.com/globex"),
    ("globexinc.com", "3", "https://shop.globexinc.com/"),
]
_FETCHED = [("https://acmetools.com/investors", "ask a@acmetools.com or IR@acmetools.com"), ("https://acmetools.com/help", "none")]


def searched(spark):
    names = contacts.unique_companies(values(spark, "company", [("Acme TOOLS INC",), ("Globex",), ("Initech",), ("Globex",)]))
    return names, values(spark, "query rank url", _SEARCHES).withColumn("rank", F.col("rank").cast("int")), values(spark, "url html", _FETCHED)


def test_contact_details(spark):
    got = {r.company: tuple(r)[1:] for r in contacts.extract_contacts(*searched(spark)).drop("error").collect()}
    assert got == {
        "Acme TOOLS INC": ("Acme Tools Inc", "acmetools.com", "https://acmetools.com/investors", "IR@acmetools.com", "https://acmetools.com/help", None),
        "Globex": ("Globex", "globexinc.com", None, None, None, None),
        "Initech": ("Initech", None, None, None, None, None),
    }


def test_social_links(spark):
    names, found, _ = searched(spark)
    links = contacts.social_links(names, found)
    got = {r.company_clean: tuple(r)[1:] for r in links.collect()}
    assert got == {"Acme Tools Inc": ("https://twitter.com/acme", None, "https://bsky.app/profile/acme"), "Globex": (None, None, None), "Initech": (None, None, None)}
    assert contacts.complete_social(links).first().complete == 0


def test_repair(spark):
    _, found, pages = searched(spark)
    names = "company company_clean domain ir_page ir_email cs_page cs_email twitter_url facebook_url bluesky_url"
    old = [("Acme TOOLS INC", "Acme Tools Inc", "x", None, "old@acme.org", "https://own", "own@acme.org", " ", None, "own"), ("Globex", "Globex", *["kept"] * 8), ("Initech", "Initech", *[None] * 8)]
    got = {r.company: tuple(r)[2:] for r in contacts.repair(values(spark, names, old), found, pages).collect()}
    assert got["Acme TOOLS INC"] == ("acmetools.com", "https://acmetools.com/investors", "IR@acmetools.com", "https://own", "own@acme.org", "https://twitter.com/acme", None, "own")
    assert got["Globex"] == ("kept",) * 8
    assert got["Initech"] == (None,) * 8


def test_domain_names(spark):
    row = spark.range(1).select(web.brand_words(F.lit("The Acme Group, Inc")).alias("b"), web.brand_words(F.lit("Group Inc")).alias("all"), web.fallback_domains(F.lit("Acme Group")).alias("d"), web.fallback_domains(F.lit("A B")).alias("none")).first()
    assert row.b == ["the", "acme"] and row["all"] == ["group", "inc"] and row.none == []
    assert row.d == ["acme.com", "acmeinc.com", "acmecorp.com", "acmeco.com", "acmegroup.com", "acme.com"]
    score = spark.range(1).select(web.domain_score(F.lit("acme.com"), F.array(F.lit("acme")), F.lit("a")).alias("s")).first().s
    assert score == 3


def test_shop_domains_are_not_a_company_s_own(spark):
    hits = [("Acme official website", 1, "https://amazon.com/acme"), ("Acme official website", 2, "https://acme.net")]
    got = contacts.found_domains(spark.createDataFrame([("Acme",)], "company_clean string"), spark.createDataFrame(hits, "query string, rank int, url string"))
    assert got.first().domain == "acme.net"


def test_connectors(spark, tmp_path):
    def fetch(url):
        if "bad" in url:
            raise OSError("no route")
        return None if "none" in url else "<p>"

    urls = spark.createDataFrame([("a",), ("a",), ("bad",), ("none",), ("",), (None,)], "url string")
    got = {r.url: (r.html, r.error) for r in connectors.fetch_pages(urls, fetch).collect()}
    assert got == {"a": ("<p>", None), "bad": (None, "no route"), "none": (None, None)}

    folder = str(tmp_path)

    def connect():
        import json
        import pathlib

        return lambda path, record: pathlib.Path(folder, path.replace("/", "_")).write_text(json.dumps(record))

    people = spark.createDataFrame([("Acme", "ann"), ("Acme", "bob"), ("Zed", "cy")], "company string, name string")
    sides = people, people.where("name = 'bob'").withColumnRenamed("name", "sub")
    connectors.put_documents(bundles.documents(*sides), connect)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["companies_acme", "companies_acme_contacts_00000", "companies_acme_contacts_00001", "companies_acme_subsidiaries_00000", "companies_zed", "companies_zed_contacts_00000"]
    lines = connectors.preview(bundles.summaries(*sides), 1)
    assert lines[0] == "2 bundles" and "Acme" in lines[1] and lines[2] == "1 more"


def test_functions_in_sql(spark):
    names = registry.register(spark)
    assert {"committee_norm", "title_bucket", "common_ticker", "token_set_ratio"} <= set(names)
    row = spark.sql("SELECT slug('A & B') AS s, best_name('by JohnSmith today') AS n, title_bucket('svp president') AS t, common_ticker(array('A-PRB', 'ab')) AS c, token_set_ratio('a b', 'b a') AS r, ratio(NULL, 'a') AS x").first()
    assert tuple(row) == ("a-b", "John Smith", "Vice President", "AB", 100.0, None)
