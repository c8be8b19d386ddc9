"""Queries whose stand-ins are plain projections of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import query, sql_values, t, values
from corpgraph.functions import brands as br
from corpgraph.functions import companies, titles, web
from corpgraph.operators import ops
from corpgraph.plans import brands, bundles, pac
from corpgraph.plans import people as execs
from corpgraph.streaming import ingest

# --- committees, companies, tickers -------------------------------------------------


def _committees(spark, d):
    """Every supplier is the committee of an organisation of its own number."""
    named = t(spark, d, "supplier").join(F.broadcast(t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    org = F.concat(F.lit("Organisation "), "s_suppkey", F.lit(" Corp."))
    return named.select(F.col("s_suppkey").alias("CMTE_ID"), F.col("s_name").alias("CMTE_NM"), org.alias("CONNECTED_ORG_NM"), F.lit("Q").alias("CMTE_TP"), F.lit("C").alias("ORG_TP"))


def _activity(spark, d):
    """What a supplier's committee gave: all its line items' prices, or nothing where its balance isn't positive."""
    per = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("spent"))
    joined = t(spark, d, "supplier").join(per, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(F.col("s_name").alias("COMMITTEE_NAME"), F.when(F.col("s_acctbal") > 0, F.col("spent")).otherwise(F.lit(0)).alias("TOTAL_AMOUNT"))


@query("""
WITH act AS (SELECT l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS spent FROM lineitem GROUP BY 1),
j AS (SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN coalesce(CAST(spent AS DOUBLE), 0) ELSE 0 END AS amount FROM supplier LEFT JOIN act ON l_suppkey = s_suppkey)
SELECT 'T' || c_custkey AS ticker, 'ORGANISATION ' || c_custkey || ' INC' AS company_name, s_suppkey IS NOT NULL AS has_pac, coalesce(amount > 0, false) AS has_pac_donations,
  CASE WHEN s_suppkey IS NOT NULL THEN CAST(1 AS BIGINT) END AS pac_count, CASE WHEN s_suppkey IS NOT NULL THEN CAST(amount > 0 AS BIGINT) END AS active_pac_count, round(amount, 2) AS total_pac_amount,
  CASE WHEN s_suppkey IS NULL THEN 'NO_PAC' WHEN amount > 0 THEN 'PAC_DONATED' ELSE 'PAC_NO_DONATIONS' END AS pac_status
FROM customer LEFT JOIN j ON s_suppkey = c_custkey""")
def pac_superset(spark, d):
    """Flagship: committees, activity, companies (the customers) and tickers to each ticker's PAC status."""
    crosswalk = t(spark, d, "customer").select(F.concat(F.lit("T"), "c_custkey").alias("TICKER"), F.concat(F.lit("ORGANISATION "), "c_custkey", F.lit(" INC")).alias("COMPANY_NAME"))
    status = pac.company_status(pac.with_activity(pac.corporate_pacs(_committees(spark, d)), _activity(spark, d)))
    out = pac.superset(crosswalk, crosswalk, status)
    return out.select(F.col("TICKER").alias("ticker"), F.col("COMPANY_NAME").alias("company_name"), "has_pac", "has_pac_donations", F.col("pac_count").cast("long").alias("pac_count"), F.col("active_pac_count").cast("long").alias("active_pac_count"), F.round("total_pac_amount", 2).alias("total_pac_amount"), "pac_status")


@query("SELECT o_orderkey AS cmte_id, o_orderstatus AS cmte_tp, CAST(o_custkey AS VARCHAR) AS org FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL")
def corporate_filter(spark, d):
    o = t(spark, d, "orders").select(F.col("o_orderkey").alias("CMTE_ID"), F.col("o_orderstatus").alias("CMTE_NM"), F.col("o_custkey").cast("string").alias("CONNECTED_ORG_NM"), F.when(F.col("o_orderstatus") == "O", "Q").otherwise("X").alias("CMTE_TP"), F.when(F.col("o_orderpriority") == "1-URGENT", "C").otherwise("X").alias("ORG_TP"))
    return pac.corporate_pacs(o).select(F.col("CMTE_ID").alias("cmte_id"), F.col("CMTE_NM").alias("cmte_tp"), F.col("CONNECTED_ORG_NM").alias("org"))


@query("SELECT c_custkey AS custkey FROM customer LEFT JOIN (SELECT o_custkey, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS s FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE coalesce(s, 0) = 0")
def zero_activity(spark, d):
    spent = t(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0)).alias("s"))
    joined = t(spark, d, "customer").join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    return pac.zero_activity(joined.withColumn("TOTAL_AMOUNT", ops.number_or_zero(F.col("s")))).select(F.col("c_custkey").alias("custkey"))


@query("""SELECT n_name || CASE WHEN n_nationkey % 5 = 0 THEN ' PAC' ELSE '' END AS org, count(DISTINCT c_custkey) AS pac_count, CAST(count_if(c_acctbal > 0) AS BIGINT) AS active_pac_count, bool_or(c_acctbal > 0) AS has_pac_donations, round(sum(c_acctbal), 2) AS total_pac_amount, true AS has_pac
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 5 <> 0 GROUP BY 1""")
def org_rollup(spark, d):
    """Committees are customers; every fifth nation's organisation is itself a PAC and stays out."""
    j = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    org = F.concat("n_name", F.when(F.col("n_nationkey") % 5 == 0, F.lit(" PAC")).otherwise(""))
    rows = j.select(F.col("c_custkey").alias("CMTE_ID"), org.alias("CONNECTED_ORG_NM"), F.col("c_acctbal").alias("TOTAL_AMOUNT"), (F.col("c_acctbal") > 0).alias("HAS_DONATED"))
    return pac.company_status(rows).select(F.col("CONNECTED_ORG_NM").alias("org"), "pac_count", "active_pac_count", "has_pac_donations", F.round("total_pac_amount", 2).alias("total_pac_amount"), "has_pac")


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IN (1, 2, 3) GROUP BY 1")
def cycle_filter(spark, d):
    e = t(spark, d, "events").withColumn("ELECTION_CYCLE", F.get_json_object("props", "$.k"))
    return ops.frequencies(pac.in_cycles(e, [1, 2, 3]), "event_type", name="n")


@query("SELECT avg(CASE WHEN s_nationkey IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate, CAST(count(*) AS BIGINT) AS n FROM customer LEFT JOIN (SELECT s_nationkey FROM supplier) ON s_nationkey = c_nationkey")
def baseline_match_rate(spark, d):
    cross = t(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("COMPANY_NAME"), F.lit("x").alias("TICKER"))
    return execs.baseline_rate(t(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("company")), cross)


@query("SELECT p_name AS committee_name, CAST(count(*) AS BIGINT) AS rows FROM part WHERE p_size > 10 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def top_unmatched(spark, d):
    m = t(spark, d, "part").select(F.col("p_name").alias("COMMITTEE_NAME"), F.when(F.col("p_size") > 10, "NO_MATCH").otherwise("NAME_EXACT").alias("match_method"))
    return pac.top_unmatched(m).withColumnRenamed("COMMITTEE_NAME", "committee_name")


_NAMES = [("Acme Holdings, Inc.",), ("The Acme Co",), ("A & B Corp /DE/",), ("Globex Group Holdings Ltd",), ("Initech L.L.C.",), ("PAC for the People",), ("", ), (None,), ("co-op bank",), ("  Spaced   Out LLC ",), ("Company",)]
_NV = sql_values("v", "name", _NAMES)


@query(f"""WITH {_NV}, a AS (SELECT name FROM v UNION ALL SELECT p_name FROM part),
n AS (SELECT name, trim(regexp_replace(regexp_replace(replace(upper(trim(coalesce(name, ''))), '&', ' AND '), '/[A-Z]{{2,3}}/', ' ', 'g'), '[^A-Z0-9]+', ' ', 'g')) AS s FROM a)
SELECT name, regexp_replace(s, '(?: (?:{companies.TRAILING}))+$', '') AS norm FROM n""")
def company_norm(spark, d):
    a = values(spark, "name", _NAMES).union(t(spark, d, "part").select("p_name"))
    return a.select("name", companies.crosswalk_norm(F.col("name")).alias("norm"))


def _dropped(words: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9\\s]', ' ', 'g'), '\\b({words})\\b', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"WITH {_NV}, a AS (SELECT name FROM v UNION ALL SELECT p_name FROM part) SELECT name, {_dropped(companies.COMMITTEE_WORDS)} AS committee, {_dropped(companies.COMPANY_WORDS)} AS company FROM a")
def committee_norm(spark, d):
    a = values(spark, "name", _NAMES).union(t(spark, d, "part").select("p_name"))
    return a.select("name", companies.committee_norm(F.col("name")).alias("committee"), companies.company_words_norm(F.col("name")).alias("company"))


@query(f"""WITH {_NV}, a AS (SELECT name FROM v UNION ALL SELECT c_name FROM customer)
SELECT name, array_to_string(list_filter(string_split_regex(trim(regexp_replace(upper(coalesce(name, '')), '[^A-Z0-9 ]+', ' ', 'g')), '\\s+'), lambda x: x <> '' AND NOT list_contains({companies.MATCH_STOPWORDS}, x)), ' ') AS key,
  CASE WHEN trim(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g'), '-') = '' THEN 'unknown-company' ELSE trim(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g'), '-') END AS slug,
  trim(replace(replace(replace(lower(coalesce(name, '')), '&', 'and'), ',', ''), '.', '')) AS clean,
  trim(regexp_replace(regexp_replace(regexp_replace(trim(lower(name)), '\\b({companies.SUBSIDIARY_WORDS})\\b', '', 'g'), '[.,]', '', 'g'), '\\s+', ' ', 'g')) AS subsidiary,
  regexp_matches(lower(coalesce(name, '')), '\\b(pac|political action committee)\\b') AS pac
FROM a""")
def match_norm(spark, d):
    n = F.col("name")
    a = values(spark, "name", _NAMES).union(t(spark, d, "customer").select("c_name"))
    return a.select("name", companies.match_norm(n).alias("key"), companies.slug(n).alias("slug"), companies.match_name(n).alias("clean"), companies.subsidiary_norm(n).alias("subsidiary"), companies.looks_like_pac(n).alias("pac"))


# --- titles -------------------------------------------------------------------------

_TITLES = ["Chief Executive Officer", "Executive Vice President", "vice president, sales", "President and CEO", "President", "CFO", "chief operating officer", "Chief Information Officer", "cmo", "General Counsel", "Director", "Treasurer", "Corporate Secretary", "Unknown", "SVP", None, "n/a"]
_TV = sql_values("v", "i title", [(i, x) for i, x in enumerate(_TITLES)])
_TIDY = "array_to_string(list_transform(regexp_extract_all(trim(title), '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '')"


def _case(column: str, rules: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p}') THEN '{v}'" for p, v in rules) + " ELSE 'Other Executive' END"


_BUCKETS = [(p.replace(r"(?<!vice\s)(?<!svp\s)(?<!evp\s)", ""), v) for p, v in titles.BUCKET_RULES]


@query(f"""WITH {_TV}, p AS (SELECT CASE WHEN title IS NULL THEN 'Unknown' ELSE regexp_replace({_TIDY}, '[^a-zA-Z\\s]', '', 'g') END AS tidy FROM part JOIN v ON CAST(i AS INT) = p_partkey % {len(_TITLES)}),
b AS (SELECT CASE WHEN trim(lower(tidy)) IN ('unknown', 'na', 'n/a', 'none', '') THEN 'Other Executive' ELSE {_case("trim(lower(tidy))", _BUCKETS)} END AS title_standard FROM p)
SELECT title_standard, {_case("title_standard", titles.CATEGORY_RULES)} AS category, CAST(count(*) AS BIGINT) AS count FROM b GROUP BY 1, 2""")
def title_bucket_counts(spark, d):
    v = values(spark, "i title", [(i, x) for i, x in enumerate(_TITLES)])
    p = t(spark, d, "part").join(F.broadcast(v), (F.col("p_partkey") % len(_TITLES)) == v.i.cast("long"))
    return execs.title_summary(p, "title")


@query("SELECT p_brand AS category, CAST(count(*) AS BIGINT) AS count, count(*) / sum(count(*)) OVER () AS share FROM part GROUP BY 1")
def category_share(spark, d):
    return execs.category_share(ops.frequencies(t(spark, d, "part").withColumnRenamed("p_brand", "category"), "category", "p_type"))


@query("""WITH r AS (SELECT CAST(p_size AS DOUBLE) AS x FROM part), s AS (SELECT min(x) AS lo, max(x) AS hi FROM r)
SELECT CAST(least(floor((x - lo) / ((hi - lo) / 15)) + 1, 15) AS INT) AS bin, CAST(count(*) AS BIGINT) AS count FROM r, s GROUP BY 1""")
def freq_histogram(spark, d):
    return ops.histogram(t(spark, d, "part"), "p_size", 15).select("bin", "count")


@query("SELECT CAST(count(*) AS BIGINT) AS total_rows, count(DISTINCT text) AS unique_executives, count(DISTINCT lang) AS unique_titles, count(DISTINCT source) AS unique_companies FROM documents")
def dataset_summary(spark, d):
    return execs.executive_summary(t(spark, d, "documents").select(F.col("text").alias("executive_name"), F.col("lang").alias("executive_title"), F.col("source").alias("company")))


# --- deduplication, nulls, sets ------------------------------------------------------


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1")
def first_per_key(spark, d):
    return ops.first_per(t(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 EXCEPT SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0")
def union_diff_processed(spark, d):
    k = t(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    return ingest.unseen(k.where("k % 2 = 0").unionByName(k.where("k % 3 = 0")).distinct(), k.where("k % 5 = 0"), "k")


_FLAG = "CASE event_id % 7 WHEN 0 THEN 'yes' WHEN 1 THEN ' True ' WHEN 2 THEN '1' WHEN 3 THEN 'no' WHEN 4 THEN CAST(value AS STRING) WHEN 5 THEN 'T' END"


@query(f"SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(TRY_CAST(f AS DOUBLE), 0) AS coerced, TRY_CAST(f AS DOUBLE) AS kept_null, coalesce(lower(trim(f)) IN ('1', 'true', 'yes', 'y', 't'), false) AS truthy FROM (SELECT *, {_FLAG} AS f FROM events)")
def json_prop(spark, d):
    f = F.expr(_FLAG)
    return t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), ops.number_or_zero(f).alias("coerced"), ops.number(f).alias("kept_null"), ops.truthy(f).alias("truthy"))


@query("SELECT conv_id, text AS first_text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'user') WHERE r = 1")
def conversation_first_text(spark, d):
    return ops.first_per(t(spark, d, "conversations").where("role = 'user'"), ["conv_id"], ["turn"]).select("conv_id", F.col("text").alias("first_text"))


@query("""SELECT n_name AS company_name, coalesce(c_name, '') AS subsidiary_name_raw, n_nationkey % 2 = 0 AS has_exhibit21 FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey""")
def master_left_join(spark, d):
    log = t(spark, d, "nation").select(F.col("n_name").alias("company_name"), F.col("n_nationkey").cast("string").alias("cik"), (F.col("n_nationkey") % 2 == 0).alias("has_exhibit21"))
    subs = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("parent_name"), F.col("n_nationkey").cast("string").alias("parent_cik"), F.col("c_name").alias("subsidiary_name_raw"))
    return bundles.master(log, subs).select("company_name", "subsidiary_name_raw", "has_exhibit21")


@query("""WITH c AS (SELECT n_name AS k, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), s AS (SELECT n_name AS k, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT coalesce(c.k, s.k) AS company_name, CAST(coalesce(c.n, 0) AS INT) AS contacts_count, CAST(coalesce(s.n, 0) AS INT) AS subsidiaries_count FROM c FULL JOIN s ON c.k = s.k""")
def bundle_counts(spark, d):
    return bundles.summaries(*_sides(spark, d))


def _sides(spark, d):
    nat = t(spark, d, "nation")
    contacts = t(spark, d, "customer").join(nat, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("company"), "c_name")
    return contacts, t(spark, d, "supplier").join(nat, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("company"), "s_name")


@query("""WITH c AS (SELECT n_name AS k, c_name AS x, row_number() OVER (PARTITION BY n_name ORDER BY c_name) - 1 AS pos FROM customer JOIN nation ON c_nationkey = n_nationkey), s AS (SELECT n_name AS k, s_name AS x, row_number() OVER (PARTITION BY n_name ORDER BY s_name) - 1 AS pos FROM supplier JOIN nation ON s_nationkey = n_nationkey),
n AS (SELECT k, CAST(sum(c) AS INT) AS c, CAST(sum(s) AS INT) AS s FROM (SELECT k, 1 AS c, 0 AS s FROM c UNION ALL SELECT k, 0, 1 FROM s) GROUP BY 1),
r AS (SELECT k, 'companies/' || trim(regexp_replace(lower(k), '[^a-z0-9]+', '-', 'g'), '-') AS root FROM n)
SELECT root AS path, printf('{"company_name":"%s","contacts_count":%d,"subsidiaries_count":%d}', k, c, s) AS json FROM n JOIN r USING (k)
UNION ALL SELECT printf('%s/contacts/%05d', root, pos), printf('{"c_name":"%s"}', x) FROM c JOIN r USING (k)
UNION ALL SELECT printf('%s/subsidiaries/%05d', root, pos), printf('{"s_name":"%s"}', x) FROM s JOIN r USING (k)""")
def bundle_paths(spark, d):
    return bundles.documents(*_sides(spark, d))


@query("""WITH c AS (SELECT n_name AS k, list(c_name ORDER BY c_name) AS x FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), s AS (SELECT n_name AS k, list(s_name ORDER BY s_name) AS x FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT coalesce(c.k, s.k) AS company_name, coalesce(array_to_string(c.x, '|'), '') AS contacts, coalesce(array_to_string(s.x, '|'), '') AS subsidiaries, CAST(coalesce(len(c.x), 0) AS INT) AS contacts_count, CAST(coalesce(len(s.x), 0) AS INT) AS subsidiaries_count FROM c FULL JOIN s ON c.k = s.k""")
def bundle_arrays(spark, d):
    joined = lambda side, c: F.coalesce(F.array_join(F.transform(side, lambda x: x[c]), "|"), F.lit(""))
    return bundles.bundles(*_sides(spark, d)).select("company_name", joined("contacts", "c_name").alias("contacts"), joined("subsidiaries", "s_name").alias("subsidiaries"), "contacts_count", "subsidiaries_count")


@query(f"""WITH w AS (SELECT c_custkey, list_filter(regexp_split_to_array(lower(trim(c_name)), '\\W+'), lambda x: len(x) > 2) AS ws FROM customer),
a AS (SELECT c_custkey, list_concat(list_transform([{", ".join(f"'{e}'" for e in web.ROOT_ENDINGS)}], lambda e: ws[1] || e), list_transform(ws, lambda x: x || '.com')) AS ds FROM w)
SELECT c_custkey AS custkey, CAST(i AS INTEGER) AS position, ds[i + 1] AS domain FROM a, range(0, 50) r(i) WHERE i < len(ds)""")
def fallback_domains(spark, d):
    return t(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.posexplode(web.fallback_domains(F.col("c_name"))).alias("position", "domain"))


_SUBS = ["Acme Co., Ltd.", "acme l.l.c.", "Globex Corporation (Delaware)", "", "The Bank Group", None, "Umbrella Holdings plc"]


@query(f"""WITH {sql_values("x", "name", [(v,) for v in _SUBS])}, y AS (SELECT c_custkey AS n, c_name AS name FROM customer UNION ALL SELECT -1, name FROM x)
SELECT n, name, coalesce(nullif(trim(regexp_replace(lower(coalesce(name, '')), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown-company') AS slug FROM y""")
def slug_names(spark, d):
    names = t(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("n"), F.col("c_name").alias("name")).unionByName(values(spark, "name", [(v,) for v in _SUBS]).select(F.lit(-1).cast("long").alias("n"), "name"))
    return names.withColumn("slug", companies.slug(F.col("name")))


# --- brands, web, mail, events -------------------------------------------------------

_PHRASES = ["Acme", "Acme thanks a lot", "Stop", "www.acme.com", "Café Noir", "Acme: the best", "Acme Foods (all of them)", "i think Acme", "Globex website is nice", "A B C D E F G H I J", "", "Humanna", "Acme based in Ohio", "parent company Globex", "Globex in Texas now"]
_PV = sql_values("v", "i phrase", [(i, x) for i, x in enumerate(_PHRASES)])
_TRIM = "trim(regexp_replace(phrase, '\\s+', ' ', 'g'))"
for _p in br.TAILS:
    _TRIM = f"trim(regexp_replace(regexp_replace({_TRIM}, '(?i){_p}', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"""WITH {_PV}, a AS (SELECT i, trim(split_part({_TRIM}, ':', 1)) AS x FROM v), b AS (SELECT i, CASE WHEN contains(x, '(') AND length(x) > 12 THEN trim(split_part(x, '(', 1)) ELSE x END AS x FROM a),
c AS (SELECT i, CASE x WHEN 'Humanna' THEN 'Humana' ELSE x END AS candidate FROM b),
l AS (SELECT i, candidate, CASE WHEN candidate IN ('', 'Stop', 'Out', 'Wings', 'Cooling', 'Etc') THEN 'drop' WHEN regexp_matches(candidate, '(?i)(https?://|www\\.|\\.(com|net|org|io|co)\\b)') THEN 'drop' WHEN NOT regexp_matches(candidate, '^[A-Za-z0-9&''’\\-\\.\\s]+$') THEN 'drop' WHEN length(candidate) > 55 OR len(string_split(candidate, ' ')) > 8 THEN 'review' ELSE 'keep' END AS label FROM c)
SELECT label, candidate, CAST(count(*) AS BIGINT) AS count FROM orders JOIN l ON CAST(i AS INT) = o_orderkey % {len(_PHRASES)} GROUP BY 1, 2""")
def brand_post_clean(spark, d):
    v = values(spark, "i brand_canonical", [(i, x) for i, x in enumerate(_PHRASES)])
    seen = t(spark, d, "orders").groupBy((F.col("o_orderkey") % len(_PHRASES)).alias("m")).agg(F.count("*").alias("count"))
    rows = brands.labelled(seen.join(v, F.col("m") == v.i.cast("long")).select("brand_canonical", "count"))
    return rows.groupBy("label", "candidate").agg(F.sum("count").alias("count"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))), '|') AS emails FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')")
def email_extract(spark, d):
    # Behind a generator the addresses are extracted once, and not again for the filter.
    e = t(spark, d, "documents").select("doc_id", F.explode_outer(F.array(web.emails(F.col("text")))).alias("e"))
    return e.where(F.size("e") > 0).select("doc_id", F.array_join("e", "|").alias("emails"))


@query("""WITH e AS (SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}'))) AS e FROM documents)
SELECT doc_id, coalesce(list_filter(e, lambda x: regexp_matches(lower(x), 'support@|service@|help@|info@|care@'))[1], e[1]) AS email FROM e WHERE len(e) > 0""")
def email_preferred(spark, d):
    e = t(spark, d, "documents").select("doc_id", web.emails(F.col("text")).alias("e"))
    return e.where(F.size("e") > 0).select("doc_id", web.preferred_email(F.col("e"), web.SERVICE_TAGS).alias("email"))


_NOISE_SQL = " OR ".join(f"contains(lower(url), '{x}')" for x in web.NOISE)


@query(f"SELECT page_id, {_NOISE_SQL} AS noise, contains(lower(url), 'bsky.app/profile/') AS bluesky, array_to_string(string_split(regexp_extract(lower(url), '://([^/?#]+)', 1), '.')[-2:], '.') AS domain FROM pages")
def url_noise(spark, d):
    u = F.col("url")
    return t(spark, d, "pages").select("page_id", web.is_noise(u).alias("noise"), web.is_social(u, "bluesky").alias("bluesky"), web.domain(u).alias("domain"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    return ingest.windowed_counts(t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))).withColumn("start", F.col("start").cast("timestamp_ntz"))
