"""Queries over people: titles, names, filings, alerts and change events."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import TITLE_CASE, cases, duck, letters, query, stand_in
from corpgraph.functions import people, titles
from corpgraph.functions.events import FIELDS
from corpgraph.plans import people as execs

_A = letters("c_custkey")
_CAP = f"upper(substr({_A}, 1, 1)) || substr({_A}, 2)"

# --- titles: one a customer ----------------------------------------------------------

_TITLES = f"""SELECT c_custkey AS n, {cases("c_custkey", "'<b>Chief Risk Officer</b>'", f"'Head of ' || {_A}", "'vice pres. & cfo'", "'N/A'", "CAST(NULL AS STRING)", "'-'", "'managing director,  Europe'", "'EVP/President'", f"'board member ' || {_A}", "'chief exec officer'", "'Exec Dir 2'", "'chairwoman'", "'treasurer o''neil'")} AS title FROM {{customer}}"""


@query(f"""WITH v AS ({duck(_TITLES)}), k AS (SELECT n, title, trim(regexp_replace(regexp_replace(regexp_replace(title, '<.*?>', ' ', 'g'), '[^A-Za-z\\s&\\-./]', ' ', 'g'), '\\s+', ' ', 'g')) AS kept FROM v)
SELECT n, title, CASE WHEN kept IS NULL OR lower(kept) IN ('na', 'n a', 'none', 'null', '-', '', '0') THEN NULL {" ".join(f"WHEN regexp_matches(lower(kept), '{p}') THEN '{x}'" for p, x in titles.CLEAN_RULES)} ELSE {TITLE_CASE.format("kept")} END AS clean, regexp_matches(lower(title), '{titles.ROLE_WORDS}') AS executive FROM k""")
def title_cleaning(spark, d):
    return stand_in(spark, d, _TITLES).select("n", "title", titles.clean_title(F.col("title")).alias("clean"), titles.is_executive_title(F.col("title")).alias("executive"))


# --- names ---------------------------------------------------------------------------

_PEOPLE = f"""SELECT c_custkey AS n, {cases("c_custkey", f"'Jane Q. ' || {_CAP}", f"'John' || {_CAP} || ' Chief Officer Mary Major'", "'O''Neil, Pat Jr'", f"'IBM ' || upper({_A})", "CAST(NULL AS STRING)", "'de la Cruz, Ana III'", f"'Al ' || {_CAP} || ' Email '", "'Vincent Price'", f"'Bo ' || {_CAP} || ' Director'", f"{_CAP} || ' van der ' || {_CAP} || ' Bea Cole'", "'Lee 2 Ann'", "'A B C D E F G'", f"'  Zoe   ' || {_CAP} || ' '")} AS name FROM {{customer}}"""
_ROLES = "[" + ", ".join(f"'{x}'" for x in people.ROLE_TERMS) + "]"
_SMALL = "[" + ", ".join(f"'{x}'" for x in [*people.PARTICLES.split("|"), *people.SUFFIXES]) + "]"
_SPAN = people.NAME_SPAN.replace("'", "''")
_LIKE = f"""(regexp_replace({{0}}, '[^A-Za-z\\-'']', '', 'g') <> '' AND (regexp_full_match({{0}}, '[A-Z]\\.?') OR regexp_full_match({{0}}, '[A-Z][a-z]+(?:[-''][A-Z][a-z]+)+') OR (regexp_full_match({{0}}, '[A-Z][a-z]+') AND NOT list_contains({_ROLES}, lower({{0}}))) OR list_contains({_SMALL}, lower(regexp_replace({{0}}, '[^A-Za-z\\-'']', '', 'g')))))"""
_WORDS = "list_filter(string_split_regex(trim({}), '\\s+'), lambda z: z <> '')"
_GOOD = f"""len(list_filter({_WORDS.format("s")}, lambda y: {_LIKE.format("y")})) >= greatest(2, len({_WORDS.format("s")}) - 1) AND len(list_filter({_WORDS.format("s")}, lambda y: list_contains({_ROLES}, lower(trim(y, '.'))))) = 0"""
_BEST = f"""list_sort(list_transform(list_filter(list_transform(regexp_extract_all(replace(regexp_replace({{0}}, '([a-z])([A-Z])', '\\1 \\2', 'g'), '’', ''''), '{_SPAN}', 1), lambda g: trim(g)), lambda s: {_GOOD}), lambda s: struct_pack(a := abs(len({_WORDS.format("s")}) - 2), b := len(s), s := s)))[1].s"""
_VALID = f"""(trim(coalesce({{0}}, '')) <> '' AND NOT regexp_matches({{0}}, '(?i){people.NOT_PERSONS}') AND len({_WORDS.format("coalesce({0}, '')")}) <= 6 AND NOT regexp_matches({{0}}, '\\d') AND NOT (upper(trim({{0}})) = trim({{0}}) AND len(trim({{0}})) > 2))"""
_LOOKS = f"""(len({_WORDS.format("coalesce({0}, '')")}) >= 2 AND len(list_filter({_WORDS.format("coalesce({0}, '')")}, lambda y: NOT {_LIKE.format("y")})) = 0)"""
_UP = "trim(regexp_replace(regexp_replace(upper(replace(coalesce(name, ''), ',', ' ')), '\\b(JR|SR|II|III|IV|V)\\b\\.?', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH v AS ({duck(_PEOPLE)}) SELECT n, name, {_BEST.format("name")} AS best, coalesce({_VALID.format("name")}, false) AS valid, {_LOOKS.format("name")} AS looks, trim(regexp_replace(name, '\\b(Email|Phone)\\b', ' ', 'g')) AS scrubbed, trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g')) AS norm,
  {_UP} AS up, string_split({_UP}, ' ')[1] AS first, string_split({_UP}, ' ')[-1] AS last FROM v""")
def person_names(spark, d):
    """The name in a text, tests of names, and upper-case parts, of all customers."""
    n = F.col("name")
    return stand_in(spark, d, _PEOPLE).select("n", "name", people.best_name(n).alias("best"), people.is_valid_name(n).alias("valid"), people.looks_like_name(n).alias("looks"), people.drop_contact_words(n).alias("scrubbed"), people.person_norm(n).alias("norm"), people.name_parts(n)["up"].alias("up"), people.name_parts(n)["first"].alias("first"), people.name_parts(n)["last"].alias("last"))


# --- filings: two a supplier, of which the first counts ---------------------------------

_B = letters("s_suppkey")
_NAME = f"upper(substr({_B}, 1, 1)) || substr({_B}, 2)"
_FILINGS = f"""SELECT 'Firm ' || {_B} AS company_name, '8-K' AS sec_filing_type, 1 AS ord, 'By: /s/ Jane ' || {_NAME} || 'a\\nName: Jane ' || {_NAME} || 'b\\nTitle: Chief Financial Officer\\nDate: today\\n\\n' || CASE s_suppkey % 3 WHEN 0 THEN 'Alan ' || {_NAME} || 'ck, Vice President of it.' WHEN 1 THEN 'nothing more' ELSE 'Alan ' || {_NAME} || 'ck, director' END AS raw_text FROM {{supplier}}
UNION ALL SELECT 'Firm ' || {_B}, '8-K', 2, 'Late Comer' || {_NAME} || ', Director' FROM {{supplier}}"""
_FOUND = f"""SELECT 'Firm ' || {_B} AS company, 'Jane ' || {_NAME} || 'b' AS executive_name, 'Chief Financial Officer' AS executive_title_clean, 'high' AS confidence FROM supplier
UNION ALL SELECT 'Firm ' || {_B}, 'Alan ' || {_NAME} || 'ck', CASE s_suppkey % 3 WHEN 0 THEN 'Vice President' ELSE 'Director' END, 'low' FROM supplier WHERE s_suppkey % 3 <> 1"""


def _none(text: str) -> list[tuple[int, int]]:
    return []


def _executives(spark, d):
    filings = stand_in(spark, d, _FILINGS)
    return execs.final_executives(execs.raw_executives(filings, "ord", _none))


@query()
def exec_mentions(spark, d):
    """Executives in all texts of documents, each the one filing of a company of its own. Tested against the patterns one by one."""
    docs = stand_in(spark, d, "SELECT concat('doc ', doc_id) AS company_name, 'doc' AS sec_filing_type, text AS raw_text, lpad(CAST(doc_id AS STRING), 12, '0') AS ord FROM {documents}")
    return execs.final_executives(execs.raw_executives(docs, "ord"))


@query(_FOUND)
def filing_executives(spark, d):
    """Executives of each company's first filing by the patterns for signatures and titles; the tagger finds nobody."""
    return _executives(spark, d).select("company", "executive_name", "executive_title_clean", "confidence")


@query(f"WITH f AS ({_FOUND}) SELECT confidence, CAST(count(*) AS BIGINT) AS count FROM f GROUP BY 1")
def confidence_counts(spark, d):
    return execs.confidence_counts(_executives(spark, d))


@query(f"""SELECT 'Firm ' || {_B} AS company, 'Jane ' || {_NAME} || 'a' AS executive_name, 'Chief Operating Officer' AS executive_title FROM supplier""")
def tagged_mentions(spark, d):
    """The tagger's side alone: capitalised spans with a role word near by, one of each name a filing; names go through a second pass."""
    filings = stand_in(spark, d, f"SELECT 'Firm ' || {_B} AS company_name, '8-K' AS sec_filing_type, s_suppkey AS ord, 'it named Jane ' || {_NAME} || 'a as its chief operating officer. item one' AS raw_text FROM {{supplier}}")
    raw = execs.raw_executives(filings, "ord")
    return execs.final_executives(raw, execs.default_tagger).select("company", "executive_name", "executive_title")


@query("""SELECT doc_id, i AS chunk_no, substr(text, i * 700 + 1, 700) AS chunk FROM (SELECT doc_id, coalesce(text, '') AS text, unnest(range(0, greatest(1, CAST(ceil(len(coalesce(text, '')) / 700) AS INT)))) AS i FROM documents)""")
def text_chunks(spark, d):
    """Texts of all documents in stretches of 700 characters."""
    docs = stand_in(spark, d, "SELECT doc_id, coalesce(text, '') AS raw_text FROM {documents}")
    return execs.chunks(docs, size=700).select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "chunk")


# --- alerts and events: one message a supplier --------------------------------------------

_EVENTS = [
    ("'Jane ' || {c} || ' has joined the company as Chief Risk Officer (posted on Jan 3, 2024).'", "joined", ("'Jane ' || {c}", "''", "'Chief Risk Officer'"), "'Jan 3, 2024'", "'Jan 3, 2024'"),
    ("'Al ' || {c} || ', Head of Sales, has left the company.'", "left", ("'Al ' || {c}", "'Head of Sales'", "''"), "''", "''"),
    ("'Mary ' || {c} || ', who was VP, is promoted to President.'", "promoted", ("'Mary ' || {c}", "'VP'", "'President'"), "''", "''"),
    ("'Bo ' || {c} || ' will join the company as Director on May 2, 2024.'", "will_join", ("'Bo ' || {c}", "''", "'Director'"), "'May 2, 2024'", "''"),
    ("'Nothing happened to ' || {c}", "unparsed", ("''", "''", "''"), "''", "''"),
    ("'Sam ' || {c} || ', Treasurer, will retire on Jun 1, 2024.'", "will_retire", ("'Sam ' || {c}", "'Treasurer'", "''"), "'Jun 1, 2024'", "''"),
    ("'Ann ' || {c} || ' who was COO , becomes CEO. ( posted on Feb 1, 2024)'", "became", ("'Ann ' || {c}", "'COO'", "'CEO'"), "'Feb 1, 2024'", "'Feb 1, 2024'"),
    ("'Ed ' || {c} || ' who is CFO, will be promoted to CEO on Mar 1, 2024.'", "will_be_promoted", ("'Ed ' || {c}", "'CFO'", "'CEO'"), "'Mar 1, 2024'", "''"),
    ("'Flo ' || {c} || ' who is VP, will become SVP.'", "will_become", ("'Flo ' || {c}", "'VP'", "'SVP'"), "''", "''"),
    ("'Gus ' || {c} || ', Counsel, will leave the company on Apr 9, 2024.'", "will_leave", ("'Gus ' || {c}", "'Counsel'", "''"), "'Apr 9, 2024'", "''"),
]
_P = f"upper(substr({_A}, 1, 1)) || substr({_A}, 2)"
_LINES = f"SELECT c_custkey AS n, {cases('c_custkey', *[e[0].format(c=_P) for e in _EVENTS])} AS line FROM {{customer}}"
_PARSED = f"SELECT c_custkey AS n, {cases('c_custkey', *[repr(e[1]) for e in _EVENTS])} AS event_type, " + ", ".join(f"{cases('c_custkey', *[e[2][i].format(c=_P) for e in _EVENTS])} AS {f}" for i, f in enumerate(FIELDS)) + f", {cases('c_custkey', *[e[3] for e in _EVENTS])} AS effective_date, {cases('c_custkey', *[e[4] for e in _EVENTS])} AS posted_date FROM customer"


@query(_PARSED)
def exec_events(spark, d):
    """A change event a customer, of every kind."""
    return execs.change_events(stand_in(spark, d, _LINES)).select("n", "event_type", *FIELDS, "effective_date", "posted_date")


@query(f"WITH p AS ({_PARSED}) SELECT event_type, CAST(count(*) AS BIGINT) AS count, CAST(count(DISTINCT executive_name) AS BIGINT) AS people FROM p GROUP BY 1")
def exec_event_counts(spark, d):
    e = execs.change_events(stand_in(spark, d, _LINES))
    return e.groupBy("event_type").agg(F.count("*").alias("count"), F.count_distinct("executive_name").alias("people"))


@query("SELECT c_custkey AS n, 'Nothing happened to ' || upper(substr(a, 1, 1)) || substr(a, 2) AS raw_event_text FROM (SELECT c_custkey, translate(CAST(c_custkey AS STRING), '0123456789', 'abcdefghij') AS a FROM customer) WHERE c_custkey % 10 = 4")
def parse_failures(spark, d):
    return execs.failures(execs.change_events(stand_in(spark, d, _LINES))).select("n", "raw_event_text")


_BODY = f"""'THE OFFICIAL BOARD / MY ALERTS January 6, 2024 ' || 'Firm ' || {_B} || '\\r\\nSoftware\\nSubsidiary of Globex ' || {_B} || '\\nAppointments\\nJane Roe has joined the company as Chief Risk Officer (posted on Jan 3, 2024). Ann Poe has joined the company as CFO (posted on Jan 5, 2024).\\nChanges\\nAl Poe, Head of Sales, has left the company. (posted on Jan 4, 2024)\\nView the new  org chart of Firm ' || {_B} || '\\n/ Report  an error\\nBorealis ' || {_B} || '\\nRetail\\nChanges\\nMary Major, who was VP, is promoted to President. (posted on Jan 5, 2024)\\nView the new org chart of Borealis\\nNobody\\nUnknown industry\\nChanges\\nBo Li, VP, has left the company.\\nUnsubscribe to this alert now'"""
_ALERTS = f"SELECT CAST(s_suppkey AS STRING) AS message_id, '2024-01-06' AS date, 'alert' AS subject, CASE s_suppkey % 4 WHEN 3 THEN CAST(NULL AS STRING) WHEN 2 THEN 'nothing' ELSE {_BODY} END AS body FROM {{supplier}}"
_ROWS = [("'Firm ' || b", "'Software'", "'Globex ' || b", "'Appointments'", "'joined'", "'Jane Roe'", "''", "'Chief Risk Officer'", "'Jan 3, 2024'"), ("'Firm ' || b", "'Software'", "'Globex ' || b", "'Appointments'", "'joined'", "'Ann Poe'", "''", "'CFO'", "'Jan 5, 2024'"), ("'Firm ' || b", "'Software'", "'Globex ' || b", "'Changes'", "'left'", "'Al Poe'", "'Head of Sales'", "''", "'Jan 4, 2024'"), ("'Borealis ' || b", "'Retail'", "''", "'Changes'", "'promoted'", "'Mary Major'", "'VP'", "'President'", "'Jan 5, 2024'")]
_COLUMNS = ("company", "industry", "subsidiary_of", "section_type", "event_type", *FIELDS, "posted_date")


@query(f"WITH s AS (SELECT CAST(s_suppkey AS STRING) AS message_id, {_B} AS b FROM supplier WHERE s_suppkey % 4 < 2) " + " UNION ALL ".join("SELECT message_id, " + ", ".join(f"{v} AS {c}" for v, c in zip(r, _COLUMNS, strict=True)) + " FROM s" for r in _ROWS))
def alert_events(spark, d):
    """Alert messages, one a supplier: cleaned, cut into companies, sections and events, and parsed."""
    return execs.alert_events(stand_in(spark, d, _ALERTS)).select("message_id", *_COLUMNS)
