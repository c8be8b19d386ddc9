"""Queries on time (as-of and overlap joins), the trained tagger over texts, and the Python data sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import cases, duck, folder, letters, query, stand_in
from corpgraph.operators.temporal import asof_join, overlap_join
from corpgraph.plans import people as execs
from corpgraph.plans.tagger import fit_tagger
from corpgraph.sources import mailbox

# --- change events with the last state before them; every third user is one and the same key ---------

_EVENTS = "SELECT event_id, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS k, ts, event_type FROM {events}"
_STATES = "SELECT CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS k, ts, event_id AS state_id, value FROM {events} WHERE event_type = 'purchase'"


@query(f"""WITH e AS ({duck(_EVENTS)}), s AS (SELECT k, ts, max(state_id) AS state_id, arg_max(value, state_id) AS value FROM ({duck(_STATES)}) GROUP BY k, ts)
SELECT event_id, e.event_type, s.state_id AS last_state_id, s.value AS last_value FROM e ASOF LEFT JOIN s ON e.k = s.k AND e.ts >= s.ts""")
def asof_state(spark, d):
    """Every event with its key's last purchase at or before it; one key holds a third of the rows."""
    out = asof_join(stand_in(spark, d, _EVENTS), stand_in(spark, d, _STATES), "k", "ts", ["state_id", "value"], ties=["state_id"])
    return out.select("event_id", "event_type", "last_state_id", "last_value")


# --- terms of office that overlap a filing's period ---------------------------------------------------

_TERMS = "SELECT o_custkey AS company, o_orderkey AS term, o_orderdate AS since, o_orderdate + CASE o_orderkey % 50 WHEN 0 THEN INTERVAL '2000' DAY WHEN 1 THEN INTERVAL '0' DAY ELSE INTERVAL '40' DAY END AS until FROM {orders}"
_PERIODS = "SELECT o_custkey AS company, l_orderkey AS filing, l_linenumber AS part, l_shipdate AS opened, l_shipdate + INTERVAL '30' DAY AS closed FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"


@query(f"WITH t AS ({duck(_TERMS)}), f AS ({duck(_PERIODS)}) SELECT t.company, term, filing, part FROM t JOIN f ON t.company = f.company AND since <= closed AND opened <= until")
def term_overlaps(spark, d):
    """Terms of a company's officers (of no day, 40 or 2,000 days) with the filings whose period they overlap."""
    return overlap_join(stand_in(spark, d, _TERMS), stand_in(spark, d, _PERIODS), "company", ("since", "until"), ("opened", "closed")).select("company", "term", "filing", "part")


# --- a tagger fitted on the customers' filings ----------------------------------------------------------


def _named(key: str, *firsts: str) -> str:
    a = letters(key)
    return f"{cases(key, *firsts)} || upper(substr({a}, 1, 1)) || substr({a}, 2) || 'son'"


def _said(key: str, name: str) -> str:
    return cases(key, f"'Chief Operating Officer ' || {name} || ' will leave the company.'", f"'The Board of Directors named ' || {name} || ' as President of it.'", f"'On May 2, 2024, ' || {name} || ', the General Counsel, signed it.'", f"'it was led by Vice President ' || {name}")


_SIGNER = _named("c_custkey", "'Jane '", "'Alan '", "'Mary '", "'Peter '", "'Ruth '")
_SIGNED = f"SELECT {_said('c_custkey', _SIGNER)} || '\\n\\nBy: /s/ ' || {_SIGNER} || '\\nName: ' || {_SIGNER} || '\\nTitle: Chief Operating Officer\\nDate: today\\n' AS raw_text FROM {{customer}}"
_OTHER = _named("o_orderkey", "'Cora '", "'Dan '", "'Lucía '")
_TITLE = "CASE o_orderkey % 4 WHEN 0 THEN 'Chief Operating Officer' WHEN 1 THEN 'Director' WHEN 2 THEN 'General Counsel' ELSE 'Vice President' END"
_IN_DOC = _named("doc_id", "'Omar '", "'Ines '", "'Zoë '")


@query(f"SELECT 'Firm ' || {letters('o_orderkey')} AS company, {_OTHER} AS executive_name, {_TITLE} AS executive_title, 'spacy' AS confidence FROM orders WHERE o_orderkey % 3 < 2")
def trained_mentions(spark, d):
    """People that the trained tagger finds in a filing an order, which hold no signature; names that the validity rules know only in ASCII go."""
    model = fit_tagger(stand_in(spark, d, _SIGNED))
    filings = stand_in(spark, d, f"SELECT 'Firm ' || {letters('o_orderkey')} AS company_name, '8-K' AS sec_filing_type, o_orderkey AS ord, {_said('o_orderkey', _OTHER)} AS raw_text FROM {{orders}}")
    found = execs.tagged_names(execs.clean_names(execs.raw_executives(filings, "ord", model)), model)
    return found.where("confidence = 'spacy'").select("company", "executive_name", "executive_title", "confidence")


@query(f"SELECT doc_id, {_IN_DOC} AS person, true AS found FROM documents")
def trained_people(spark, d):
    """All texts of documents, each with a person in its last line, and whether the trained tagger finds just that name."""
    model = fit_tagger(stand_in(spark, d, _SIGNED))
    texts = stand_in(spark, d, f"SELECT doc_id, {_IN_DOC} AS person, coalesce(text, '') || '\\n\\n' || {_said('doc_id', _IN_DOC)} AS text FROM {{documents}}")
    return texts.select("doc_id", "person", F.array_contains(execs.people_in(model)("text"), F.col("person")).alias("found"))


# --- a mailbox of all documents, and a store of documents ------------------------------------------------


def _mail(spark, d, path: str, rest: int, of: int = 2) -> None:
    """Every other document as a message, in pages of about 100 messages, behind those that are there."""
    made = stand_in(spark, d, "SELECT CAST(doc_id AS STRING) AS id, CAST(n_chars AS STRING) AS internalDate, named_struct('body', named_struct('data', text)) AS payload, doc_id FROM {documents}")
    have, pages = mailbox.FolderMailbox(path).pages(), made.count() // (100 * of) + 1
    paged = made.where(F.pmod("doc_id", F.lit(of)) == rest).withColumn("page", have + F.pmod(F.xxhash64("id"), F.lit(pages))).drop("doc_id")
    paged.repartition("page").write.mode("append").partitionBy("page").json(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS message_id, CAST(n_chars AS VARCHAR) AS sent, md5(coalesce(text, '')) AS body_md5, CAST(1 AS BIGINT) AS times FROM documents")
def mailbox_stream(spark, d):
    """All documents as messages of a paged mailbox, read as a stream that stops half-way and goes on from its offset when more pages are there."""
    mailbox.register(spark)
    base = folder(spark, "mailbox")
    for rest in range(2):
        _mail(spark, d, f"{base}/box", rest)
        run = spark.readStream.format("mailbox").option("path", f"{base}/box").load().writeStream.format("parquet").option("checkpointLocation", f"{base}/state").start(f"{base}/out")
        run.processAllAvailable()
        run.stop()
    got = spark.read.parquet(f"{base}/out").withColumn("body", F.coalesce(F.get_json_object("payload_json", "$.body.data"), F.lit("")))
    return got.groupBy("message_id", F.col("internal_date_ms").alias("sent"), F.md5("body").alias("body_md5")).agg(F.count("*").alias("times"))


_CUSTOMER = "SELECT concat('companies/', c_custkey) AS path, to_json(struct(c_name AS name, {}) ) AS json FROM {{customer}}"


@query("SELECT 'companies/' || c_custkey AS path, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS state FROM customer")
def stored_documents(spark, d):
    """Customers put into the document store, and a third of them again: each path shows its last commit's document."""
    mailbox.register(spark)
    base = folder(spark, "store")
    put = lambda rows: rows.write.format("documentstore").mode("append").option("path", base).save()
    put(stand_in(spark, d, _CUSTOMER.format("'old' AS state")))
    put(stand_in(spark, d, _CUSTOMER.format("'new' AS state") + " WHERE c_custkey % 3 = 0"))
    return mailbox.stored(spark, base).select("path", F.get_json_object("json", "$.name").alias("name"), F.get_json_object("json", "$.state").alias("state"))
