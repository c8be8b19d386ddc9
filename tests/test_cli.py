"""Commands on tiny files, resume, and what readers and connectors do at the edges."""

import csv
import json

import pytest

from corpgraph import cli
from corpgraph.functions.similarity import SCORERS
from corpgraph.operators import fuzzy, ops
from corpgraph.plans import brands, bundles, contacts, people
from corpgraph.sources import connectors, io


def put(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)
    return str(path)


def got(spark, path):
    return [tuple(r) for r in io.read_csv(spark, str(path)).collect()]


def run(spark, *args):
    cli.main([str(a) for a in args], spark)


SIGNED = "By: /s/ {0}\nName: {0}\nTitle: Chief Financial Officer\nDate: today\n"


def test_executives_resume(spark, tmp_path):
    out = tmp_path / "out"
    one = put(tmp_path / "one.csv", [["company_name", "sec_filing_type", "raw_text"], ["Acme", "8-K", SIGNED.format("Ada Stone")], ["Acme", "8-K", SIGNED.format("Never Read")]])
    run(spark, "executives", "--input", one, "--output-dir", out)
    two = put(tmp_path / "two.csv", [["company_name", "sec_filing_type", "raw_text"], ["Acme", "8-K", SIGNED.format("Not Again")], ["Globex", "8-K", SIGNED.format("Ben Hill")]])
    run(spark, "executives", "--input", two, "--output-dir", out)
    names = {r[-4] for r in got(spark, out / "executive_final")}  # the plain tagger's spans may cross line ends
    assert {"Ada Stone", "Ben Hill"} <= names and not any(x in n for n in names for x in ("Never", "Again"))
    assert {r.value for r in spark.read.text(str(out / "executive_dataset_summary")).collect()} >= {f"total_rows: {len(names)}", "unique_companies: 2"}
    run(spark, "titles", "--input", out / "executive_final", "--output-dir", out)
    assert got(spark, out / "executive_titles_category") == [("Chief Financial Officer", "C-Suite: CFO", str(len(names)))]
    cross = put(tmp_path / "cross.csv", [["TICKER", "COMPANY_NAME"], ["AC", "Acme Inc"], ["NA", "Globex Corp"]])
    run(spark, "tickers", "--executives", out / "executive_final", "--crosswalk", cross, "--output-dir", out)
    rows = io.read_csv(spark, str(out / "executives_with_tickers")).collect()
    assert {(r.company, r.TICKER) for r in rows} == {("Acme", "AC"), ("Globex", "NA")}  # NA is a ticker, not a missing one


def test_committees(spark, tmp_path):
    line = "{}|{}|t||||||P|Q||M|C|{}|\n"
    for y, rows in ((2020, [("C1", "ACME PAC", "Acme Corp"), ("C2", "BETA FUND", "Beta")]), (2022, [("C3", "GLOBEX WORKERS PAC", "Globex")])):
        (tmp_path / f"{y}.txt").write_bytes("".join(line.format(*r) for r in rows).encode("latin-1"))
    act = put(tmp_path / "act.csv", [["COMMITTEE_NAME", "TOTAL_AMOUNT"], ["The Acme PAC", "5"]])
    cross = put(tmp_path / "cross.csv", [["TICKER", "COMPANY_NAME"], ["A", "ACME"], ["B", "Beta Inc"], ["Z", "Zed"]])
    out = tmp_path / "out"
    run(spark, "pac-superset", "--committees", tmp_path / "2020.txt", "--activity", act, "--universe", cross, "--crosswalk", cross, "--output-dir", out)
    assert {(r[0], r[-1]) for r in got(spark, out / "pac_superset")} == {("A", "PAC_DONATED"), ("B", "PAC_NO_DONATIONS"), ("Z", "NO_PAC")}
    assert [r[1] for r in got(spark, out / "zero_activity_pacs")] == ["C2"]
    run(spark, "build-master", "--input-dir", tmp_path, "--years", 2020, 2022, "--output-dir", out)
    rec = put(tmp_path / "rec.csv", [["TICKER", "ELECTION_CYCLE", "COMMITTEE_NAME", "COMMITTEE_TYPE_FULL", "PARTY_NAME_FULL", "RECEIPT_AMOUNT"], *[["t", c, n, "", "", "1"] for c, n in (("2020", "Acme Pac"), ("2022.0", "GLOBEX WORKER PAC"), ("2022", "Nobody"), ("1999", "Acme Pac"))]])
    run(spark, "validate", "--receipts", rec, "--master", out / "committee_master", "--output-dir", out)
    assert set(got(spark, out / "match_summary")) == {("NAME_EXACT", "1"), ("FUZZY_HIGH", "1"), ("NO_MATCH", "1")}
    assert got(spark, out / "top_unmatched") == [("Nobody", "1")]
    assert spark.read.text(str(out / "match_rate")).first().value.startswith("match_rate: 0.666")


def test_subsidiaries_and_bundle(spark, tmp_path, capsys):
    names = put(tmp_path / "names.csv", [["company_name", "cik"], ["Acme Corp", ""], ["Beta", "2.0"], ["Unknown Thing", ""]])
    (tmp_path / "index.json").write_text(json.dumps({"0": {"cik_str": 1, "ticker": "A", "title": "ACME CORP."}}))
    page = "<table><tr><td>Acme {} LLC</td></tr></table>"
    exhibits = put(tmp_path / "ex.csv", [["cik", "accession", "exhibit_url", "html", "error"], ["0000000001", "a", "u1", page.format("East"), ""], ["2", "", "", "", "timeout"]])
    out = tmp_path / "out"
    for _ in range(2):  # a second run finds everything done
        run(spark, "subsidiaries", "--company-file", names, "--index", tmp_path / "index.json", "--exhibits", exhibits, "--output-dir", out)
    assert {(r[0], r[4]) for r in got(spark, out / "companies_exhibit21_log")} == {("Acme Corp", "Exhibit-21 found"), ("Beta", "Error: timeout"), ("Unknown Thing", "Missing CIK")}
    assert [r[3] for r in got(spark, out / "ex21_full_output")] == ["Acme East LLC"]
    assert got(spark, out / "ex21_errors") == [("Beta", "2", "timeout")]
    people_ = put(tmp_path / "people.csv", [["company", "name"], [" Acme ", "ann"], ["Zed", "cy"]])
    subs = put(tmp_path / "subs.csv", [["parent_name", "sub"], ["Acme", "East"]])
    run(spark, "bundle", "--contacts", people_, "--subsidiaries", subs, "--output-dir", out, "--company", "ACME")
    assert {r.path for r in spark.read.json(str(out / "documents")).collect()} == {"companies/acme", "companies/acme/contacts/00000", "companies/acme/subsidiaries/00000"}
    run(spark, "bundle", "--contacts", people_, "--subsidiaries", subs, "--output-dir", out, "--limit", 1, "--dry-run")
    assert capsys.readouterr().out.startswith("1 bundles\n")


def test_contacts_resume(spark, tmp_path):
    res = put(tmp_path / "res.csv", [["query", "rank", "url"], ["Acme Tools official website", "1", "https://acmetools.com"], ["Acme Tools help site:acmetools.com", "1", "https://acmetools.com/help"], ["Acme Tools official bluesky", "1", "https://bsky.app/profile/acme"]])
    pages = put(tmp_path / "pages.csv", [["url", "html"], ["https://acmetools.com/help", "help@acmetools.com"]])
    out = tmp_path / "out"
    for names in (["Acme Tools"], ["Acme Tools", "Zed"]):
        run(spark, "contact-details", "--input", put(tmp_path / "names.csv", [["company"], *[[n] for n in names]]), "--results", res, "--pages", pages, "--output-dir", out, "--run-social", "--fix-missing")
    assert sorted(r[:2] for r in got(spark, out / "company_contacts")) == [("Acme Tools", "Acme Tools"), ("Zed", "Zed")]
    final = {r.company: r for r in io.read_csv(spark, str(out / "company_contacts_final")).collect()}
    assert (final["Acme Tools"].cs_email, final["Acme Tools"].bluesky_url, final["Zed"].domain) == ("help@acmetools.com", "https://bsky.app/profile/acme", None)


def test_mail_commands(spark, tmp_path):
    import base64

    def message(i, body, subject=""):
        data = base64.urlsafe_b64encode(body.encode()).decode()
        return json.dumps({"message_id": f"m{i}", "internal_date_ms": str(1704103200000 + i), "payload_json": json.dumps({"headers": [{"name": "Subject", "value": subject}], "body": {"data": data}})})

    mail = tmp_path / "mail"
    mail.mkdir()
    (mail / "a.json").write_text("\n".join(message(i, f"I'd like to know more details about: {b} thanks") for i, b in enumerate(["Acme and Globex", "acme", "Globexx", "www.x.com"])))
    out = tmp_path / "out"
    run(spark, "brands-extract", "--messages", mail, "--output-dir", out)
    run(spark, "brands-clean", "--output-dir", out)
    assert [r[:2] for r in got(spark, out / "brand_request_counts")] == [("Acme", "2"), ("Globex", "2")]
    assert {r[:2] for r in got(spark, out / "brand_request_counts_clean")} == {("Acme", "2"), ("Globex", "2")}
    alerts = tmp_path / "alerts"
    alerts.mkdir()
    (alerts / "a.json").write_text(message(1, "Acme\nSoftware\nChanges\nAl Poe, Head, has left the company. (posted on Jan 4, 2024)\nGibberish here\nView the new org chart of Acme"))
    run(spark, "alerts", "--messages", alerts, "--output-dir", out / "alerts")
    assert len(got(spark, out / "alerts" / "executive_changes")) == 2 and len(got(spark, out / "alerts" / "parse_failures")) == 1


def test_missing_files_and_mailboxes(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="crosswalk"):
        io.read_csv(spark, str(tmp_path / "no.csv"), label="crosswalk")
    assert io.if_there(spark, str(tmp_path / "no.csv")) is None
    pages = {None: (["a", "b"], "2"), "2": (["c", "d"], "3"), "3": (["e"], None)}
    assert list(connectors.list_messages(pages.get)) == list("abcde")
    assert list(connectors.list_messages(pages.get, 3)) == list("abc") and list(connectors.list_messages(pages.get, 0)) == []

    def connect():
        def get(i):
            if i == "c":
                raise OSError("gone")
            return {"internalDate": "5", "payload": {"x": i}}

        return get

    ids = spark.createDataFrame([(x,) for x in "abc"], "message_id string")
    rows = {r.message_id: (r.payload_json, r.error) for r in connectors.get_messages(ids, connect, seen=ids.where("message_id = 'a'")).collect()}
    assert rows == {"b": ('{"x": "b"}', None), "c": (None, "gone")}


def test_resume_and_limits(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, n int")
    done = spark.createDataFrame([("a",), (None,)], "d string")
    assert {r.n for r in ops.not_done(rows, done, "k", "d").collect()} == {2, 3} and ops.not_done(rows, None, "k") is rows
    assert [r.n for r in ops.capped(rows, 2, ["n"]).collect()] == [1, 2] and ops.capped(rows, None, ["n"]) is rows
    again = rows.unionByName(rows.where("k = 'b'"))
    assert [(r.k, r["count"]) for r in ops.most_common(again, "k", first="n").collect()] == [("b", 2), ("a", 1), (None, 1)]
    errors = spark.createDataFrame([("A official website", None, None, "down")], "query string, rank int, url string, error string")
    out = contacts.extract_contacts(spark.createDataFrame([("A", "A")], "company string, company_clean string"), errors, spark.createDataFrame([], "url string, html string")).first()
    assert (out.domain, out.error) == (None, "down")


def test_best_match_equals_brute_force(spark):
    import random

    r = random.Random(3)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 7))) for _ in range(40)]

    def name():
        w = [r.choice(words) for _ in range(r.randint(1, 4))]
        w[0] = w[0] + r.choice(["", "", "s", "x"])
        return " ".join(w)

    choices, keys = sorted({name() for _ in range(150)}), sorted({name() for _ in range(60)})
    block = fuzzy.Choices(choices)
    for scorer, score in SCORERS.items():
        for k in keys:
            scores = [score(k, c) for c in choices]
            for least in (0, 80, 90):
                want = (choices[scores.index(max(scores))], max(scores)) if max(scores) >= least else None
                assert block.best(k, scorer, least) == want
                assert block.every(k, scorer, least) == [(c, s) for c, s in zip(choices, scores) if s >= least]


def test_canonical_brands_equal_a_plain_fold(spark):
    """Names that come later are better matches for earlier ones' repeats: each mention sees only what was there."""
    import random

    r = random.Random(5)
    pool = ["Acme Foods", "Acme Food", "acme foods", "Acme Fooods", "Globex", "Globexx", "Globexxx", "Globexes", "Hooli Inc", "Inc Hooli", "Holi Inc", "Zed"]
    rows = [(f"m{i:03}", p, r.choice(pool), i // 3) for i in range(60) for p in range(r.randint(1, 2))]
    names, want = {}, {}
    for m, p, brand, _ in sorted(rows, key=lambda x: (x[3], x[0], x[1])):
        name, hint = names.get(brand.lower()), None
        if name is None:
            score, _, best = max(((SCORERS["token_set"](brand, n), -i, n) for i, n in enumerate(names.values())), default=(0, 0, None))
            name, hint = (best, None) if score >= 90 else (brand, best if score >= 80 else None)
            names.setdefault(name.lower(), name)
        want[m, p] = (name, hint)
    df = spark.createDataFrame(rows, "message_id string, position int, brand_clean string, date int")
    assert {(x.message_id, x.position): (x.brand_canonical, x.suggested) for x in brands.canonical_brands(df).collect()} == want


def test_filings_with_failures(spark):
    rows = [("A", "1.0", "u", "<table><tr><td>X Inc</td></tr></table>", None), ("B", "1", "v", "<table><tr><td>Y Inc</td></tr></table>", None), ("C", "nan", "w", "", None), ("D", "4", None, None, "no route"), ("E", "5", "x", "<table><tr><td>Z Inc</td></tr></table>", None)]
    df = spark.createDataFrame(rows, "parent_name string, parent_cik string, source_url string, html string, error string")
    made, failed = bundles.extract_all(df, spark.createDataFrame([("5",)], "parent_cik string"))
    assert [(r.parent_name, r.parent_cik, r.subsidiary_name_raw) for r in made.collect()] == [("A", "1", "X Inc")]
    assert [tuple(r) for r in failed.collect()] == [("D", "4", "no route")]
    assert [r.name for r in people.of_company(spark.createDataFrame([(" acme ", "x"), ("b", "y")], "company string, name string"), "ACME").collect()] == ["x"]
