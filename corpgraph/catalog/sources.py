"""Queries through readers, writers and connectors, and over pages found by search."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import cases, duck, folder, letters, query, stand_in, t
from corpgraph.functions import companies
from corpgraph.plans import bundles, contacts
from corpgraph.schemas import strings
from corpgraph.sources import connectors, io
from corpgraph.streaming import ingest

# --- files -----------------------------------------------------------------------------

_QUOTED = "SELECT c_custkey AS n, CASE c_custkey % 4 WHEN 0 THEN 'a \"quoted\", name' WHEN 1 THEN 'NA' WHEN 2 THEN 'two\nlines' END AS name, c_acctbal AS bal FROM {customer}"


@query(duck(_QUOTED).replace("'two\n", "'two' || chr(10) || '"))
def csv_round_trip(spark, d):
    """All customers written as CSV and read again: quotes, line ends and the text NA stay, a missing name is null."""
    out = folder(spark, "csv")
    io.write_csv(stand_in(spark, d, _QUOTED.replace("\n", "\\n")), out, ["n", "name", "bal"])
    return io.read_csv(spark, out, strings("n name bal")).select(F.col("n").cast("long").alias("n"), "name", F.col("bal").cast("double").alias("bal"))


@query("SELECT o_orderkey AS n, o_totalprice AS price, o_orderpriority AS priority FROM orders")
def csv_inferred(spark, d):
    """All orders written as CSV, and read with inferred types."""
    out = folder(spark, "csv")
    io.write_csv(t(spark, d, "orders").select(F.col("o_orderkey").alias("n"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority")), out)
    return io.read_csv(spark, out, infer=True).withColumn("n", F.col("n").cast("long"))


_MASTERS = f"SELECT s_suppkey AS CMTE_ID, 'Señor ' || {letters('s_suppkey')} AS CMTE_NM, s_nationkey AS CONNECTED_ORG_NM FROM {{supplier}}"


@query(f"SELECT CAST(s_suppkey AS VARCHAR) AS cmte_id, CASE WHEN s_acctbal > 0 THEN '' ELSE 'old ' END || 'Señor ' || {letters('s_suppkey')} AS cmte_nm, CAST(CASE WHEN s_acctbal > 0 THEN 2024 ELSE 2020 END AS INT) AS cycle FROM supplier")
def committee_masters(spark, d):
    """Masters of two cycles in Latin-1 with pipes: all suppliers, and those with debts in an earlier one, whose rows count."""
    base = folder(spark, "masters")
    sup = t(spark, d, "supplier").select("s_suppkey", "s_acctbal", F.expr(f"'Señor ' || {letters('s_suppkey')}").alias("name"))
    for year, rows, lead in ((2020, sup.where("s_acctbal <= 0"), "old "), (2024, sup, "")):
        fields = [F.col("s_suppkey").alias("c0"), F.concat(F.lit(lead), "name").alias("c1"), *[F.lit(None).cast("string").alias(f"c{i}") for i in range(2, 15)]]
        rows.select(*fields).write.option("sep", "|").option("encoding", "ISO-8859-1").csv(f"{base}/{year}")
    out = io.committees_of_cycles(spark, {y: f"{base}/{y}" for y in (2020, 2024)})
    return out.select(F.col("CMTE_ID").alias("cmte_id"), F.col("CMTE_NM").alias("cmte_nm"), F.col("ELECTION_CYCLE").alias("cycle"))


@query("SELECT lpad(CAST(n_nationkey AS VARCHAR), 10, '0') AS cik, 'T' || n_nationkey AS ticker, n_name AS title FROM nation")
def company_index(spark, d):
    """An index of all nations, one JSON object of records."""
    out = folder(spark, "index")
    rows = t(spark, d, "nation").select(F.struct(F.col("n_nationkey").cast("string").alias("key"), F.struct(F.col("n_nationkey").alias("cik_str"), F.concat(F.lit("T"), "n_nationkey").alias("ticker"), F.col("n_name").alias("title")).alias("value")).alias("r"))
    rows.agg(F.to_json(F.map_from_entries(F.collect_list("r"))).alias("value")).coalesce(1).write.text(out)
    return io.read_company_index(spark, out)


@query("""WITH f AS (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F')
SELECT DISTINCT CAST(o.o_custkey AS VARCHAR) AS cik, CAST(f.o_orderkey AS VARCHAR) AS accession, f.o_orderpriority AS document FROM orders o LEFT JOIN f ON f.o_custkey = o.o_custkey AND r = 1""")
def latest_filings(spark, d):
    """Each customer's first finished order, out of parallel arrays of all its orders."""
    filed = t(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "o_orderpriority"))).alias("x"))
    recent = F.struct(F.col("x.o_orderstatus").alias("form"), F.col("x.o_orderkey").cast("array<string>").alias("accessionNumber"), F.col("x.o_orderpriority").alias("primaryDocument"))
    return io.latest_filing(filed.select(F.col("o_custkey").cast("string").alias("cik"), recent.alias("recent")), "F")


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, min(CASE WHEN l_returnflag = 'R' THEN 'EX-21' ELSE 'ex10' END) AS kind FROM lineitem GROUP BY 1, 2), f AS (SELECT l_orderkey, min(l_linenumber) AS m FROM l WHERE kind = 'EX-21' GROUP BY 1)
SELECT o AS cik, CASE WHEN m IS NOT NULL THEN 'Archives/edgar/data/' || ltrim(o, '0') || '/' || o || '/EX-21_' || m || '.htm' END AS exhibit_url FROM (SELECT DISTINCT l_orderkey, printf('%010d', l_orderkey) AS o FROM lineitem WHERE l_orderkey > 0) JOIN (SELECT DISTINCT l_orderkey FROM l) USING (l_orderkey) LEFT JOIN f USING (l_orderkey)""")
def exhibit_urls(spark, d):
    """The exhibit in each order's listing of its lines."""
    lines = t(spark, d, "lineitem").where("l_orderkey > 0").groupBy("l_orderkey", "l_linenumber").agg(F.min(F.when(F.col("l_returnflag") == "R", F.lit("EX-21")).otherwise("ex10")).alias("kind"))
    item = F.struct(F.col("l_linenumber"), F.concat("kind", F.lit("_"), "l_linenumber", F.lit(".htm")).alias("name"))
    listing = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("item"))
    cik = F.format_string("%010d", "l_orderkey")
    return io.exhibit_21(listing.select(cik.alias("cik"), F.concat(F.substring(cik, 1, 5), F.lit("-"), F.substring(cik, 6, 5)).alias("accession"), "item")).select("cik", "exhibit_url")


# --- pages and searches ------------------------------------------------------------------


def _fetch(url: str) -> str | None:
    if "utm_source" in url:
        raise ValueError("no tracking")
    return None if url.endswith("#top") else f"page of {url}"


@query("SELECT DISTINCT url, CASE WHEN contains(url, 'utm_source') OR ends_with(url, '#top') THEN NULL ELSE 'page of ' || url END AS html, CASE WHEN contains(url, 'utm_source') THEN 'no tracking' END AS error FROM pages WHERE url <> ''")
def fetched_pages(spark, d):
    """Every distinct page URL through a fetcher that fails on some: errors are values."""
    return connectors.fetch_pages(t(spark, d, "pages"), _fetch)


def _find(query: str, most: int) -> list[str]:
    if query.endswith("7"):
        raise ValueError("no answer")
    return [f"https://{query[-2:].lower()}.example.com/{i}" for i in range(most + 3)]


@query("""SELECT c_name AS query, CAST(i AS INT) AS rank, CASE WHEN i IS NOT NULL THEN 'https://' || lower(c_name[-2:]) || '.example.com/' || (i - 1) END AS url, CASE WHEN c_name[-1] = '7' THEN 'no answer' END AS error
FROM (SELECT DISTINCT c_name FROM customer) LEFT JOIN range(1, 6) r(i) ON c_name[-1] <> '7'""")
def searched(spark, d):
    """Five hits for each customer's name, asked once each; failures are rows."""
    twice = t(spark, d, "customer").select("c_name").union(t(spark, d, "customer").select("c_name"))
    return connectors.search(twice, _find, 5, column="c_name")


# --- contacts: each supplier is a company ------------------------------------------------

_W = letters("s_suppkey")
_COMPANY = f"SELECT s_suppkey AS n, 'Firm' || {_W} || ' Tools Inc' AS company FROM {{supplier}}"
_ROOT = f"'firm' || {_W}"
#: By the company's number modulo 5: 0 is found by its first search, 4 by a better second hit of another; the rest by a fallback that some of them searched.
_HITS = f"""SELECT q AS query, CAST(r AS INT) AS rank, u AS url FROM (
SELECT n, clean || ' official website' AS q, 1 AS r, 'https://en.wikipedia.org/wiki/' || root AS u FROM {{c}}
UNION ALL SELECT n, clean || ' official website', 2, 'https://www.' || root || 'tools.com/about' FROM {{c}} WHERE n % 5 = 0
UNION ALL SELECT n, clean || ' homepage', 1, 'https://tools.org' FROM {{c}} WHERE n % 5 IN (0, 4)
UNION ALL SELECT n, clean || ' homepage', 2, 'https://ww2.' || root || '.com/x' FROM {{c}} WHERE n % 5 = 4
UNION ALL SELECT n, 'tools.com', 3, 'https://shop.tools.com/' FROM {{c}} WHERE n % 5 = 1
UNION ALL SELECT n, clean || ' investor site:' || site, 1, 'https://' || site || '/investors' FROM {{c}} WHERE n % 5 IN (0, 4)
UNION ALL SELECT n, clean || ' ir site:' || site, 1, 'https://' || site || '/ir' FROM {{c}} WHERE n % 5 IN (0, 4)
UNION ALL SELECT n, clean || ' help site:' || site, 2, 'https://' || site || '/help' FROM {{c}} WHERE n % 5 = 0
UNION ALL SELECT n, clean || ' official twitter x', 1, 'https://twitter.com/' || root || '/status/1' FROM {{c}} WHERE n % 3 = 0
UNION ALL SELECT n, clean || ' official twitter x', 2, 'https://twitter.com/' || root FROM {{c}} WHERE n % 3 < 2
UNION ALL SELECT n, clean || ' official facebook page', 1, 'https://facebook.com/' || root FROM {{c}} WHERE n % 4 = 0
UNION ALL SELECT n, clean || ' official bluesky', 8, 'https://bsky.app/profile/' || root FROM {{c}} WHERE n % 2 = 0)"""
_C = f"SELECT s_suppkey AS n, 'Firm' || {_W} || ' Tools Inc' AS clean, 'firm' || {_W} AS root, CASE s_suppkey % 5 WHEN 0 THEN 'firm' || {_W} || 'tools.com' WHEN 4 THEN 'firm' || {_W} || '.com' ELSE 'tools.com' END AS site FROM {{supplier}}"
_HITS = _HITS.replace("{c}", f"({_C})")


def _world(spark, d):
    names = contacts.unique_companies(stand_in(spark, d, _COMPANY))
    hits = stand_in(spark, d, _HITS).distinct()
    site = stand_in(spark, d, _C).where("site is not null")
    page = lambda path, text: site.select(F.concat(F.lit("https://"), "site", F.lit(path)).alias("url"), text.alias("html"))
    pages = page("/investors", F.concat(F.lit("ask a@x.com or IR@"), "site")).unionByName(page("/help", F.lit("none"))).dropDuplicates(["url"])
    return names, hits, pages


_FOUND = f"""SELECT clean AS company_clean, site AS domain, CASE WHEN n % 5 IN (0, 4) THEN 'https://' || site || '/investors' END AS ir_page, CASE WHEN n % 5 IN (0, 4) THEN 'IR@' || site END AS ir_email, CASE WHEN n % 5 = 0 THEN 'https://' || site || '/help' END AS cs_page FROM ({duck(_C)})"""


@query(f"SELECT *, CAST(NULL AS VARCHAR) AS cs_email FROM ({_FOUND})")
def contact_details(spark, d):
    """Domain, pages and e-mails of all suppliers from search results and fetched pages."""
    return contacts.extract_contacts(*_world(spark, d)).select("company_clean", "domain", "ir_page", "ir_email", "cs_page", "cs_email")


_SOCIAL = f"""SELECT clean AS company_clean, CASE WHEN n % 3 < 2 THEN 'https://twitter.com/' || root END AS twitter_url, CASE WHEN n % 4 = 0 THEN 'https://facebook.com/' || root END AS facebook_url, CASE WHEN n % 2 = 0 THEN 'https://bsky.app/profile/' || root END AS bluesky_url FROM ({duck(_C)})"""


@query(_SOCIAL)
def social_links(spark, d):
    names, hits, _ = _world(spark, d)
    return contacts.social_links(names, hits)


@query(f"SELECT CAST(count_if(twitter_url IS NOT NULL AND facebook_url IS NOT NULL AND bluesky_url IS NOT NULL) AS BIGINT) AS complete FROM ({_SOCIAL})")
def complete_social(spark, d):
    names, hits, _ = _world(spark, d)
    return contacts.complete_social(contacts.social_links(names, hits))


_OLD = f"""SELECT clean AS company, clean AS company_clean, CASE n % 2 WHEN 0 THEN 'x' ELSE site END AS domain, CASE n % 3 WHEN 0 THEN 'https://own' END AS ir_page, CASE n % 3 WHEN 0 THEN 'own@x.org' WHEN 1 THEN 'old@x.org' END AS ir_email, ' ' AS cs_page, CAST(NULL AS STRING) AS cs_email, CASE n % 4 WHEN 0 THEN 'kept' END AS twitter_url, '' AS facebook_url, CAST(NULL AS STRING) AS bluesky_url FROM ({_C})"""


@query(f"""WITH o AS (SELECT *, row_number() OVER () AS r FROM ({duck(_OLD)})), j AS (SELECT o.*, f.domain AS d, f.ir_page AS p, f.ir_email AS e, f.cs_page AS c, s.twitter_url AS tw, s.facebook_url AS fb, s.bluesky_url AS bs FROM o JOIN ({_FOUND}) f USING (company_clean) JOIN ({_SOCIAL}) s USING (company_clean))
SELECT company, d AS domain, CASE WHEN ir_page IS NULL THEN p ELSE ir_page END AS ir_page, CASE WHEN ir_page IS NULL THEN coalesce(e, ir_email) ELSE ir_email END AS ir_email, coalesce(c, cs_page) AS cs_page, coalesce(twitter_url, tw) AS twitter_url, fb AS facebook_url, bs AS bluesky_url FROM j""")
def contacts_repaired(spark, d):
    """Rows with gaps of all suppliers: short domains found anew, blank pages and links filled, the rest kept."""
    _, hits, pages = _world(spark, d)
    return contacts.repair(stand_in(spark, d, _OLD), hits, pages).select("company", "domain", "ir_page", "ir_email", "cs_page", "twitter_url", "facebook_url", "bluesky_url")


# --- exhibits: one of each supplier ---------------------------------------------------------

_KIND = cases("s_suppkey", "'No 10-K found'", "'10-K found, but Exhibit-21 missing'", "'Exhibit-21 found'", "'Missing CIK'", "'Error: timeout'", "'Exhibit-21 found'", "'Exhibit-21 found'")
_LOG = f"""SELECT s_suppkey AS n, s_name AS company_name, CASE s_suppkey % 7 WHEN 3 THEN 'nan' ELSE CAST(s_suppkey AS STRING) || '.0' END AS cik, CASE WHEN s_suppkey % 7 IN (1, 2, 5, 6) THEN 'a' END AS accession, CASE WHEN s_suppkey % 7 IN (2, 5, 6) THEN 'https://x/' || s_suppkey END AS exhibit_url, CASE s_suppkey % 7 WHEN 4 THEN 'timeout' END AS error,
  {cases("s_suppkey", "''", "''", f"'<table><tr><th>Name</th></tr><tr><td> ' || {_W} || ' Holdings Inc </td><td>Bank of X</td></tr><tr><td>ab</td></tr><tr><td>' || {_W} || ' Ltd.</td></tr></table>'", "''", "''", f"'<p>none</p><div>' || {_W} || ' Group LLC</div><script>x</script>'", "'<p>nothing</p>'")} AS html FROM {{supplier}}"""


@query(f"SELECT s_name AS company_name, {_KIND} AS reason, s_suppkey % 7 IN (2, 5, 6) AS has_exhibit21 FROM supplier")
def exhibit_log(spark, d):
    return bundles.exhibit_reason(stand_in(spark, d, _LOG)).select("company_name", "reason", "has_exhibit21")


_NAMES = f"""SELECT CAST(s_suppkey AS VARCHAR) AS parent_cik, {_W} || ' Holdings Inc' AS subsidiary_name_raw, {_W} || ' holdings' AS subsidiary_name_clean FROM supplier WHERE s_suppkey % 7 = 2
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), {_W} || ' Ltd.', {_W} FROM supplier WHERE s_suppkey % 7 = 2
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), {_W} || ' Group LLC', {_W} || ' group' FROM supplier WHERE s_suppkey % 7 = 5"""


def _exhibits(spark, d):
    log = stand_in(spark, d, _LOG).select(F.col("company_name").alias("parent_name"), F.col("cik").alias("parent_cik"), F.col("exhibit_url").alias("source_url"), "html", "error")
    again = log.withColumn("parent_name", F.concat(F.lit("Z "), "parent_name")).withColumn("html", F.lit("<td>Other Inc</td>"))
    return log.unionByName(again)  # each cik under two names: the first counts


@query(_NAMES)
def exhibit_names(spark, d):
    """Subsidiaries in tables' first cells, or else in lines of text, once a cik; a suffix goes, a period after it too."""
    made, _ = bundles.extract_all(_exhibits(spark, d))
    return made.select("parent_cik", "subsidiary_name_raw", "subsidiary_name_clean")


@query(f"WITH n AS ({_NAMES}) SELECT parent_cik, CAST(count(*) AS BIGINT) AS subsidiary_count FROM n WHERE parent_cik NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 5000) GROUP BY 1")
def exhibits_resumed(spark, d):
    """Counts of the subsidiaries of companies that an earlier output (the suppliers with little money) lacks."""
    done = t(spark, d, "supplier").where("s_acctbal < 5000").select(F.col("s_suppkey").cast("string").alias("parent_cik"))
    made, _ = bundles.extract_all(_exhibits(spark, d), done)
    return made.groupBy("parent_cik").agg(F.count("*").alias("subsidiary_count"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS parent_cik, 'timeout' AS error FROM supplier WHERE s_suppkey % 7 = 4")
def exhibit_failures(spark, d):
    _, failed = bundles.extract_all(_exhibits(spark, d))
    return failed.select("parent_cik", "error")


@query("SELECT c_custkey AS n, 'customer-' || split_part(c_name, '#', 2) AS slug, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer")
def slugs_and_ciks(spark, d):
    c = t(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("n"), companies.slug(F.col("c_name")).alias("slug"), companies.ten_digit_cik(F.col("c_custkey")).alias("cik"))


# --- windows over events ---------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) + to_minutes(CAST(15 * (minute(ts) // 15 - k) AS INTEGER)) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events, range(0, 4) r(k) GROUP BY 1, 2")
def sliding_counts(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.sliding_counts(e).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT min(ts) AS start, max(ts) + INTERVAL '30 minutes' AS "end", user_id, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY user_id, k""")
def session_counts(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ingest.session_counts(e).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
