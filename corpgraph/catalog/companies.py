"""Queries over names of companies, committees and tickers: normalisers, exact and fuzzy joins, logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import cases, duck, letters, query, stand_in, t
from corpgraph.functions import companies, web
from corpgraph.operators import ops
from corpgraph.plans import bundles, pac
from corpgraph.plans import people as execs

_A = letters("c_custkey")
_COMPANIES = f"""SELECT c_custkey AS n, {cases("c_custkey", f"upper({_A}) || ' CORP'", f"'8X8 ' || {_A} || ' INC'", f"{_A} || '.COM'", f"'COCA-' || upper({_A}) || ' LLC'", f"'  ' || {_A} || '   plc '", "CAST(NULL AS STRING)", f"'the ' || {_A} || '-based IBM Group'", f"'3M ' || upper({_A})", "''", f"'overstock.COM ' || {_A} || ' Holdings'", f"'-' || {_A} || ' & Co.'")} AS name FROM {{customer}}"""
_PART = """CASE WHEN regexp_full_match({0}, '\\d+[A-Za-z]\\d+') THEN lower({0}) WHEN regexp_full_match({0}, '[A-Z]{{2,4}}') AND NOT list_contains({1}, {0}) THEN {0} WHEN regexp_full_match({0}, '\\d[A-Z]') THEN {0} WHEN upper({0}) IN ('LLC', 'PLC') THEN upper({0}) ELSE upper({0}[1]) || lower({0}[2:]) END"""
_DOMAIN = companies.DOMAIN.replace("(?i)", "").strip("^$")


@query(f"""WITH c AS ({duck(_COMPANIES)}), w AS (SELECT n, name, trim(coalesce(name, '')) AS x FROM c)
SELECT n, name, CASE WHEN regexp_full_match(x, '{_DOMAIN}', 'i') THEN lower(x) ELSE array_to_string(list_transform(list_filter(string_split_regex(x, '\\s+'), lambda y: y <> ''),
  lambda w: CASE WHEN regexp_full_match(w, '{_DOMAIN}', 'i') THEN lower(w) WHEN contains(w, '-') AND w[1] <> '-' AND w[-1] <> '-' THEN array_to_string(list_transform(string_split(w, '-'), lambda p: {_PART.format("p", companies.LEGAL_SUFFIXES)}), '-') ELSE {_PART.format("w", companies.LEGAL_SUFFIXES)} END), ' ') END AS search_name,
  CASE WHEN list_contains({companies.LEGAL_SUFFIXES}, upper(x)) THEN '' ELSE lower(x) END AS low, trim(regexp_replace(lower(coalesce(name, '')), '[^\\w\\s]', '', 'g')) AS index_title, lpad(n || '', 10, '0') AS cik FROM w""")
def search_names(spark, d):
    """Names cased for web search, index titles and ten-digit numbers of all customers."""
    c = stand_in(spark, d, _COMPANIES)
    x = F.trim(F.coalesce("name", F.lit("")))
    low = F.when(F.upper(x).isin(companies.LEGAL_SUFFIXES), F.lit("")).otherwise(F.lower(x))
    return c.select("n", "name", companies.search_name(F.col("name")).alias("search_name"), low.alias("low"), companies.index_title(F.col("name")).alias("index_title"), companies.ten_digit_cik(F.concat(F.col("n").cast("string"), F.lit(".0"))).alias("cik"))


_MARKED = f"SELECT c_custkey AS n, {cases('c_custkey', f"'Nestlé ' || {_A} || ' Holdings Co'", f"'ÀÇÉ-' || {_A} || ' L.L.C.'", f"'Señor & Søn ' || {_A}", f"{_A} || ' Group /DE/ The'")} AS name FROM {{customer}}"


@query(f"""WITH c AS ({duck(_MARKED)}), u AS (SELECT n, name, upper(trim(name)) AS x FROM c),
m AS (SELECT n, name, replace(array_to_string(list_transform(string_split(x, ''), lambda ch: CASE WHEN unicode(ch) > 127 AND strip_accents(ch) <> ch THEN strip_accents(ch) || ' ' ELSE ch END), ''), '&', ' AND ') AS x FROM u)
SELECT n, name, regexp_replace(trim(regexp_replace(regexp_replace(x, '/[A-Z]{{2,3}}/', ' ', 'g'), '[^A-Z0-9]+', ' ', 'g')), '(?: (?:{companies.TRAILING}))+$', '') AS norm FROM m""")
def marked_company_norm(spark, d):
    """Letters with marks come apart, and the mark becomes a space."""
    return stand_in(spark, d, _MARKED).select("n", "name", companies.crosswalk_norm(F.col("name")).alias("norm"))


# --- tickers: each customer is a company, with one to three tickers -------------------

_TICKERS = f"""SELECT 'Firm ' || {_A} || CASE c_custkey % 2 WHEN 0 THEN ' Inc' ELSE ' Holdings Co' END AS COMPANY_NAME, {cases("c_custkey", f"upper({_A})", f"upper({_A}) || '.PRA'", f"upper({_A}) || ' W'", "CAST(NULL AS STRING)")} AS TICKER FROM {{customer}}
UNION ALL SELECT 'FIRM ' || {_A}, {cases("c_custkey", f"upper({_A}) || '-PRB'", f"'Z' || upper({_A})", f"upper({_A}) || ' WS'")} FROM {{customer}} WHERE c_acctbal > 0"""
_HOLDERS = f"SELECT {cases('c_custkey', f"'The Firm ' || {_A}", f"'Firm ' || {_A} || ' Corp.'", f"'Trust ' || {_A} || ' Fund'", f"'firm ' || {_A} || ' group, ltd'")} AS company FROM {{customer}}"
_NORM = lambda x: f"regexp_replace(trim(regexp_replace(upper({x}), '[^A-Z0-9]+', ' ', 'g')), '(?: (?:{companies.TRAILING}))+$', '')"
_ENRICHED = f"""x AS ({duck(_TICKERS)}), h AS ({duck(_HOLDERS)}),
m AS (SELECT {_NORM("COMPANY_NAME")} AS norm, list_sort(list_distinct(list(TICKER) FILTER (TICKER IS NOT NULL))) AS c FROM x GROUP BY 1),
e AS (SELECT company, k AS norm, coalesce(c, []) AS c FROM (SELECT company, {_NORM("company")} AS k FROM h) LEFT JOIN m ON m.norm = k)"""
_COMMON = f"coalesce(list_sort(list_filter(list_transform(c, lambda x: upper(trim(x))), lambda x: NOT regexp_matches(x, '{companies.PREFERRED}')))[1], list_sort(list_transform(c, lambda x: upper(trim(x))))[1])"


def _enriched(spark, d):
    return execs.with_tickers(stand_in(spark, d, _HOLDERS), stand_in(spark, d, _TICKERS))


@query(f"WITH {_ENRICHED} SELECT company, norm AS company_norm, coalesce(array_to_string(c, '|'), '') AS candidates, c[1] AS ticker, len(c) > 1 AS ambiguous, {_COMMON} AS ticker_common FROM e")
def ticker_candidates(spark, d):
    """Companies with all their tickers, the least, and the common share's."""
    e = _enriched(spark, d)
    return e.select("company", "company_norm", F.coalesce(F.array_join("ticker_candidates", "|"), F.lit("")).alias("candidates"), F.col("TICKER").alias("ticker"), F.col("ticker_ambiguous").alias("ambiguous"), F.col("TICKER_COMMON").alias("ticker_common"))


@query(f"WITH {_ENRICHED} SELECT DISTINCT company, norm AS company_norm, regexp_matches(norm, '{companies.FUND}') AS looks_like_fund_or_etf FROM e WHERE c[1] IS NULL")
def ticker_unmatched_log(spark, d):
    return execs.triage(execs.unmatched(_enriched(spark, d)))


@query(f"WITH {_ENRICHED} SELECT DISTINCT company, norm AS company_norm, array_to_string(c, '|') AS ticker_candidates_str, {_COMMON} AS ticker_common FROM e WHERE len(c) > 1")
def ticker_ambiguous_log(spark, d):
    return execs.ambiguous(_enriched(spark, d)).withColumnRenamed("TICKER_COMMON", "ticker_common")


@query(f"WITH {_ENRICHED} SELECT norm AS company_norm, min(company) AS company, any_value(array_to_string(c, '|')) AS ticker_candidates_str FROM e WHERE len(c) > 1 GROUP BY 1")
def ticker_ambiguous_norms(spark, d):
    return execs.ambiguous_norms(_enriched(spark, d)).drop("TICKER_COMMON")


# --- receipts and committees: parts --------------------------------------------------

_MASTER = """SELECT CAST(min(p_partkey) AS STRING) AS CMTE_ID, upper(p_name) || ' ' || p_type || ' Committee' AS CMTE_NM FROM {part} GROUP BY p_name, p_type UNION ALL SELECT 'Z' || min(p_partkey), 'The ' || p_name || ' ' || lower(p_type) || ' committee, Inc' FROM {part} GROUP BY p_name, p_type"""
_RECEIPTS = f"""SELECT p_partkey AS n, {cases("p_partkey", "p_name || ' ' || p_type || ' committee'", "p_type || 's ' || p_name || ' commitee'", "'Group ' || p_name || ' of ' || p_type", f"{letters('p_partkey')} || ' ' || p_brand", "''", "p_name || ' widgets ' || p_type || ' COMMITTEE'", "substr(p_name, 2) || ' ' || p_type || ' committe'", "CAST(NULL AS STRING)")} AS COMMITTEE_NAME FROM {{part}}"""
_KEY = lambda x: f"array_to_string(list_filter(string_split_regex(trim(regexp_replace(upper(coalesce({x}, '')), '[^A-Z0-9 ]+', ' ', 'g')), '\\s+'), lambda w: w <> '' AND NOT list_contains({companies.MATCH_STOPWORDS}, w)), ' ')"
_RATIO = """tok AS (SELECT a, b, list_sort(list_distinct(string_split(a, ' '))) AS x, list_sort(list_distinct(string_split(b, ' '))) AS y FROM pair),
cut AS (SELECT a, b, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS s, array_to_string(list_filter(x, lambda w: NOT list_contains(y, w)), ' ') AS l, array_to_string(list_filter(y, lambda w: NOT list_contains(x, w)), ' ') AS r FROM tok),
sized AS (SELECT *, CAST(s <> '' AS INT) AS gap, len(s) + CAST(s <> '' AS INT) + len(l) AS n, len(s) + CAST(s <> '' AS INT) + len(r) AS m FROM cut),
dp(a, b, l, r, i, row) AS (SELECT DISTINCT a, b, l, r, 0, list_transform(range(0, len(r) + 1), lambda j: CAST(0 AS BIGINT)) FROM sized WHERE s = '' OR (l <> '' AND r <> '')
  UNION ALL SELECT a, b, l, r, i + 1, list_prepend(CAST(0 AS BIGINT), list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda q: greatest(row[q + 1], CASE WHEN r[q] = l[i + 1] THEN row[q] + 1 ELSE 0 END))))) FROM dp WHERE i < len(l)),
lcs AS (SELECT a, b, row[-1] AS c FROM dp WHERE i = len(l)),
token_set AS (SELECT a, b, CASE WHEN s <> '' AND (l = '' OR r = '') THEN 100.0 ELSE greatest(100 - 100.0 * (len(l) + len(r) - 2 * c) / (n + m), CASE WHEN gap = 1 THEN greatest(100 - 100.0 * (1 + len(l)) / (len(s) + n), 100 - 100.0 * (1 + len(r)) / (len(s) + m)) ELSE 0 END) END AS score FROM sized LEFT JOIN lcs USING (a, b))"""
#: SQL: whether the characters that two texts have in common allow a score.
_ALIKE = "200 * list_sum(list_transform(string_split('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 ', ''), lambda ch: least(len({1}) - len(replace({1}, ch, '')), len({2}) - len(replace({2}, ch, ''))))) >= {0} * (len({1}) + len({2}))"
#: Pairs whose lengths and characters alone allow a score of 90: by the strings, or by one side's shared words.
_MATCHED = f"""WITH RECURSIVE f0 AS ({duck(_MASTER)}), f AS (SELECT *, {_KEY("CMTE_NM")} AS k FROM f0), master AS (SELECT k, min(CMTE_ID) AS CMTE_ID FROM f WHERE k <> '' GROUP BY 1),
r0 AS ({duck(_RECEIPTS)}), r AS (SELECT *, {_KEY("COMMITTEE_NAME")} AS k FROM r0), lost AS (SELECT DISTINCT k FROM r WHERE k <> '' AND k NOT IN (SELECT k FROM master)),
met AS (SELECT lost.k AS a, master.k AS b, list_sort(list_distinct(string_split(lost.k, ' '))) AS x, list_sort(list_distinct(string_split(master.k, ' '))) AS y FROM lost, master),
bound AS (SELECT a, b, array_to_string(x, ' ') AS u, array_to_string(y, ' ') AS v, len(array_to_string(x, ' ')) AS n, len(array_to_string(y, ' ')) AS m, len(array_to_string(list_intersect(x, y), ' ')) AS s FROM met),
pair AS (SELECT a, b FROM bound WHERE 200 * s >= 90 * (s + least(n, m)) OR (200 * least(n, m) >= 90 * (n + m) AND {_ALIKE.format(90, "u", "v")})),
{_RATIO},
best AS (SELECT a, min(struct_pack(s := -score, b := b)) AS z FROM token_set WHERE score >= 90 GROUP BY 1),
j AS (SELECT r.n, r.k, e.CMTE_ID AS exact_id, best.z.b AS best_norm, -best.z.s AS fuzzy_score, g.CMTE_ID AS fuzzy_id FROM r LEFT JOIN master e ON e.k = r.k LEFT JOIN best ON best.a = r.k LEFT JOIN master g ON g.k = best.z.b WHERE r.k <> ''),
o AS (SELECT n, k AS cmte_norm, coalesce(exact_id, fuzzy_id) AS cmte_id, best_norm, fuzzy_score, CASE WHEN exact_id IS NOT NULL THEN 'NAME_EXACT' WHEN fuzzy_score >= 95 THEN 'FUZZY_HIGH' WHEN fuzzy_score >= 90 THEN 'FUZZY_REVIEW' ELSE 'NO_MATCH' END AS match_method, CASE WHEN exact_id IS NOT NULL THEN 100 ELSE fuzzy_score END AS match_score FROM j)"""


def _matches(spark, d):
    master = stand_in(spark, d, _MASTER).withColumns({"CONNECTED_ORG_NM": F.lit("x"), "CMTE_TP": F.lit("Q"), "ORG_TP": F.lit("C")})
    return pac.match_receipts(stand_in(spark, d, _RECEIPTS), master)


@query(f"{_MATCHED} SELECT n, cmte_norm, cmte_id, best_norm, round(fuzzy_score, 6) AS fuzzy_score, match_method, round(match_score, 6) AS match_score FROM o")
def fuzzy_match_residuals(spark, d):
    """Receipts of all parts against the committees of their names: exact, else the best token-set score from 90 on."""
    return _matches(spark, d).select("n", "cmte_norm", F.col("CMTE_ID").alias("cmte_id"), "best_norm", F.round("fuzzy_score", 6).alias("fuzzy_score"), "match_method", F.round("match_score", 6).alias("match_score"))


@query(f"{_MATCHED} SELECT match_method, CAST(count(*) AS BIGINT) AS rows FROM o GROUP BY 1")
def match_summary(spark, d):
    return pac.match_summary(_matches(spark, d))


@query(f"{_MATCHED} SELECT count_if(match_method <> 'NO_MATCH') / count(*) AS match_rate FROM o")
def match_rate(spark, d):
    return pac.match_rate(_matches(spark, d))


_ORDERED = """SELECT o_orderkey AS n, 'Customer ' || (o_custkey % 100) || ' PAC' AS COMMITTEE_NAME FROM {orders}"""
_BUYERS = """SELECT CAST(c_custkey AS STRING) AS CMTE_ID, 'CUSTOMER ' || (c_custkey * 2) || ' Pac, Inc.' AS CMTE_NM, 'x' AS CONNECTED_ORG_NM, 'Q' AS CMTE_TP, 'C' AS ORG_TP FROM {customer}"""


@query("""WITH m AS (SELECT c_custkey * 2 AS k, CAST(c_custkey AS STRING) AS id FROM customer)
SELECT CASE WHEN id IS NULL THEN 'other' ELSE 'NAME_EXACT' END AS method, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT id) AS BIGINT) AS committees FROM orders LEFT JOIN m ON k = o_custkey % 100 GROUP BY 1""")
def exact_match_summary(spark, d):
    """Receipts of all orders; committees have even numbers, so half of the receipts find their name."""
    m = pac.match_receipts(stand_in(spark, d, _ORDERED), stand_in(spark, d, _BUYERS), review=101)
    return m.groupBy(F.when(F.col("match_method") == "NAME_EXACT", F.col("match_method")).otherwise("other").alias("method")).agg(F.count("*").alias("rows"), F.count_distinct("CMTE_ID").alias("committees"))


# --- ciks: suppliers against an index of their own names -------------------------------

_B = letters("s_suppkey")
_INDEX = f"""SELECT CAST(s_suppkey AS STRING) AS cik, 'energy ' || {_B} || ' partners' AS title FROM {{supplier}}"""
_ASKED = f"""SELECT s_suppkey AS n, {cases("s_suppkey", f"'Energy ' || {_B} || ' Partners'", f"'Partners Energy ' || {_B}", f"'Energies ' || {_B} || ' Partner,'", f"'Qqqqqq ' || {_B} || ' zzzzzz'")} AS company_name FROM {{supplier}}"""


@query(f"""WITH RECURSIVE i AS ({duck(_INDEX)}), q AS (SELECT *, trim(replace(replace(lower(company_name), '&', 'and'), ',', '')) AS k FROM ({duck(_ASKED)})),
pair AS (SELECT a, b FROM (SELECT DISTINCT k AS a, title AS b FROM q, i) WHERE {_ALIKE.format(85, "a", "b")}), {_RATIO},
w(a, b, p, u, v) AS (SELECT a, b, 'ratio', a, b FROM pair UNION ALL SELECT a, b, 'sorted', array_to_string(list_sort(string_split(a, ' ')), ' '), array_to_string(list_sort(string_split(b, ' ')), ' ') FROM pair),
d2(a, b, p, u, v, i, row) AS (SELECT a, b, p, u, v, 0, list_transform(range(0, len(v) + 1), lambda j: CAST(0 AS BIGINT)) FROM w
  UNION ALL SELECT a, b, p, u, v, i + 1, list_prepend(CAST(0 AS BIGINT), list_transform(range(1, len(v) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda q: greatest(row[q + 1], CASE WHEN v[q] = u[i + 1] THEN row[q] + 1 ELSE 0 END))))) FROM d2 WHERE i < len(u)),
e AS (SELECT a, b, max(CASE p WHEN 'ratio' THEN 1.0 ELSE 0.95 END * 200.0 * row[-1] / (len(u) + len(v))) AS s FROM d2 WHERE i = len(u) GROUP BY 1, 2),
best AS (SELECT a, min(struct_pack(s := -greatest(e.s, 0.95 * score), b := b)) AS z FROM e JOIN token_set USING (a, b) GROUP BY 1)
SELECT n, company_name, cik, CASE WHEN cik IS NOT NULL THEN round(-z.s, 6) END AS fuzzy_score FROM q LEFT JOIN best ON a = k AND -z.s >= 85 LEFT JOIN i ON title = z.b""")
def cik_match(spark, d):
    """Names of all suppliers with the cik of the most similar index title. All lengths are alike, so whole, sorted and token-set ratios decide."""
    return bundles.with_ciks(stand_in(spark, d, _ASKED), stand_in(spark, d, _INDEX)).select("n", "company_name", "cik", F.round("fuzzy_score", 6).alias("fuzzy_score"))


# --- resume -----------------------------------------------------------------------------


@query("SELECT c_custkey AS n, c_name AS company FROM customer WHERE c_name NOT IN (SELECT c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F')")
def resumed_companies(spark, d):
    """Companies that an earlier output (the customers with a finished order) lacks."""
    c = t(spark, d, "customer").select(F.col("c_custkey").alias("n"), F.col("c_name").alias("company"))
    done = c.join(t(spark, d, "orders").where("o_orderstatus = 'F'"), F.col("n") == F.col("o_custkey")).select(F.col("company").alias("done"))
    return ops.not_done(c, done, "company", "done")


@query("SELECT c_custkey AS n, c_name AS company FROM customer WHERE lower(trim(c_name)) = 'customer#000000007'")
def one_company(spark, d):
    return execs.of_company(t(spark, d, "customer").select(F.col("c_custkey").alias("n"), F.col("c_name").alias("company")), "  CUSTOMER#000000007 ")


@query(f"WITH s AS (SELECT s_suppkey AS n, 'Energy ' || {_B} || ' partners' AS name FROM supplier), x AS (SELECT n, list_filter(string_split_regex(lower(trim(name)), '\\W+'), lambda w: len(w) > 2) AS w, name FROM s) SELECT n, CAST(i AS INT) AS position, name || ' ' || q AS ask, array_to_string(list_transform(w, lambda y: y[1]), '') AS initials FROM x, (SELECT unnest(range(0, {len(web.DOMAIN_QUERIES)})) AS i, unnest({web.DOMAIN_QUERIES}) AS q)")
def domain_asks(spark, d):
    """Searches that may find a supplier's site, and the initials of its words."""
    s = stand_in(spark, d, f"SELECT s_suppkey AS n, 'Energy ' || {_B} || ' partners' AS name FROM {{supplier}}")
    return s.select("n", F.posexplode(web.domain_queries(F.col("name"))).alias("position", "ask"), web.initials(web.brand_words(F.col("name"))).alias("initials"))
