"""The query exec_mentions reads every document, and each company's first filing only."""

from corpgraph import catalog
from corpgraph.plans import people


def test_every_document_is_read(spark, tmp_path):
    signed = "By: /s/ {0}\nName: {0}\nTitle: Chief Financial Officer\nDate: today\n"
    names = ["Ada Stone", "Ben Hill", "Cora Lake", "Dan Brook", "Eve Marsh"]
    rows = [(i, signed.format(n), "en", "one source", 1) for i, n in enumerate(names)] + [(9, None, "en", "one source", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalog.QUERIES["exec_mentions"](spark, str(tmp_path)).where("filing_type = 'doc'").collect()
    want = {(f"doc {i}", n.strip()) for i, text, *_ in rows for n, _, c in people.mentions_in(text or "", people.default_tagger) if c == "high"}
    assert len(want) == len(names) and {(r.company, r.executive_name) for r in got if r.confidence == "high"} == want


def test_first_filing_of_two(spark):
    filings = [("Acme", "8-K", "Ada Stone, Director. Ben Hill, President.", "1"), ("Acme", "8-K", "Cora Lake, Director.", "2"), ("Globex", "8-K", "Dan Brook, President.", "3")]
    got = people.raw_executives(spark.createDataFrame(filings, "company_name string, sec_filing_type string, raw_text string, ord string"), "ord").collect()
    want = {(c, n.lower()) for c, _, text, o in filings if o != "2" for n, *_ in people.mentions_in(text, people.default_tagger)}
    assert {(r.company, r.executive_name.strip().lower()) for r in got} == want
