"""Plans and building blocks on small invented tables."""

from pyspark.sql import functions as F

from corpgraph.operators import fuzzy
from corpgraph.plans import brands, bundles, contacts, pac, people
from corpgraph.sources import io
from corpgraph.streaming import ingest


def test_committee_files(spark, tmp_path):
    line = "{}|{}|t||||||P|Q||M|C|Órg Inc|\n"
    for y, rows in ((2020, [("C1", "ACME"), ("C2", "B")]), (2022, [("C1", "ACME NEW")])):
        (tmp_path / f"{y}.txt").write_bytes("".join(line.format(*r) for r in rows).encode("latin-1"))
    out = io.committees_of_cycles(spark, {y: str(tmp_path / f"{y}.txt") for y in (2020, 2022)}).orderBy("CMTE_ID").collect()
    assert [(r.CMTE_ID, r.CMTE_NM, r.ELECTION_CYCLE, r.CONNECTED_ORG_NM) for r in out] == [("C1", "ACME", 2020, "Órg Inc"), ("C2", "B", 2020, "Órg Inc")]


def test_status_fan_out_and_negative_amounts(spark):
    pacs = spark.createDataFrame([("C1", "Acme PAC", "Acme", "Q", "C"), ("C2", "Beta PAC", "Beta", "Q", "C"), ("C3", "x", "Some PAC", "Q", "C")], "CMTE_ID string, CMTE_NM string, CONNECTED_ORG_NM string, CMTE_TP string, ORG_TP string")
    act = spark.createDataFrame([("ACME", "5"), ("the acme fund", "7"), ("beta", "-1"), ("beta", "bad")], "COMMITTEE_NAME string, TOTAL_AMOUNT string")
    rows = {r.CONNECTED_ORG_NM: r for r in pac.company_status(pac.with_activity(pac.corporate_pacs(pacs), act)).collect()}
    assert set(rows) == {"Acme", "Beta"}
    assert (rows["Acme"].pac_count, rows["Acme"].active_pac_count, rows["Acme"].total_pac_amount) == (1, 2, 12.0)
    assert (rows["Beta"].has_pac_donations, rows["Beta"].total_pac_amount) == (False, -1.0)


def test_best_match_in_blocks(spark, monkeypatch):
    left = spark.createDataFrame([("alpha beta",), ("gamma",), ("",)], "k string")
    right = spark.createDataFrame([("beta alpha",), ("gamme",), ("delta",), ("zeta",)], "c string")
    whole = sorted(map(tuple, fuzzy.best_match(left, right, "k", "c").collect()))
    monkeypatch.setattr(fuzzy, "BLOCK_CHOICES", 1)
    monkeypatch.setattr(fuzzy, "BLOCK_KEYS", 1)
    assert sorted(map(tuple, fuzzy.best_match(left, right, "k", "c").collect())) == whole
    assert [(k, b) for k, b, _ in whole] == [("alpha beta", "beta alpha"), ("gamma", "gamme")]


def test_canonical_fold(spark):
    rows = [("m1", 0, "Acme Foods", 1), ("m2", 0, "acme foods", 2), ("m3", 0, "Foods Acme", 3), ("m4", 0, "Globex", 4), ("m5", 0, "Globexia", 5)]
    got = {r.message_id: (r.brand_canonical, r.suggested) for r in brands.canonical_brands(spark.createDataFrame(rows, "message_id string, position int, brand_clean string, date int")).collect()}
    assert got == {"m1": ("Acme Foods", None), "m2": ("Acme Foods", None), "m3": ("Acme Foods", None), "m4": ("Globex", None), "m5": ("Globexia", "Globex")}


def test_contacts_and_repair(spark):
    res = spark.createDataFrame([("A investor site:acme.com", 1, "https://acme.com/i"), ("A investor relations site:acme.com", 2, "https://acme.com/ir"), ("A investor relations site:acme.com", 1, "https://yahoo.com/acme.com")], "query string, rank int, url string")
    pages = spark.createDataFrame([("https://acme.com/ir", "a@x.com ir@acme.com")], "url string, html string")
    got = contacts.contact_pages(spark.createDataFrame([("A", "acme.com")], "company_clean string, domain string"), res, pages).first()
    assert (got.company_clean, got.ir_page, got.ir_email) == ("A", "https://acme.com/ir", "ir@acme.com")
    old = spark.createDataFrame([("A", None, "x"), ("B", "page", "")], "company string, page string, mail string")
    new = spark.createDataFrame([("A", "new", "n"), ("B", "other", None)], "company string, page string, mail string")
    assert sorted(map(tuple, bundles.repaired(old, new, "company", ["page"]).collect())) == [("A", "new", "x"), ("B", "page", "")]


def test_chunks_and_failures(spark):
    f = spark.createDataFrame([("A", "abcdefg"), ("B", None)], "c string, raw_text string")
    assert sorted(r.chunk for r in people.chunks(f, size=3).where("c = 'A'").collect()) == ["abc", "def", "g"]
    ev = people.change_events(spark.createDataFrame([("x",), ("A B, CFO, has left the company.",)], "line string"))
    assert people.failures(ev).count() == 1


def test_message_errors_are_values(spark):
    m = spark.createDataFrame([("m1", "1000", "{bad"), ("m2", "x", None)], "message_id string, internal_date_ms string, payload_json string")
    rows = {r.message_id: r for r in ingest.decoded(m.withColumn("payload_json", F.when(F.col("message_id") == "m1", F.lit('{"body": {"data": 5}}')))).collect()}
    assert rows["m1"].error and rows["m2"].error is None and rows["m2"].date is None


def test_baseline_rate_counts_the_joined_rows_without_making_them(spark):
    from corpgraph.operators.ops import share_where
    from corpgraph.plans import people

    execs = spark.createDataFrame([("a",), (" A ",), ("b",), (None,), ("c",)], "company string")
    cross = spark.createDataFrame([("a", "T"), ("A", None), ("a ", "U"), ("b", None), ("z", "Z")], "COMPANY_NAME string, TICKER string")
    rows = people.baseline_tickers(execs, cross)
    assert people.baseline_rate(execs, cross).first() == rows.agg(share_where(rows["TICKER"].isNull()).alias("null_rate"), F.count("*").alias("n")).first()
    many = spark.range(300_000).selectExpr("'x' AS company", "'X' AS COMPANY_NAME", "'T' AS TICKER")
    assert tuple(people.baseline_rate(many, many).first()) == (0.0, 300_000**2)
    assert tuple(people.baseline_rate(execs.limit(0), cross).first()) == (None, 0)
