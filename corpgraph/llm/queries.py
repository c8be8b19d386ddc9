"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.llm import align, bpe, chat, divergence, exact_dedup, lm, mixing, near_dedup, quality_model, quality_rules, token_store, url_filter, warc
from corpgraph.llm.work import WorkArea

#: Host and path rules of op1, and the hosts whose pages are listed one by one.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
LISTED_HOSTS = r"(^|\.)(spam-farm|cheap-pills|adult-x|ads-track)\."


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URL of every page on a listed host, so it grows with the table."""
    pages = _table(spark, sf_dir, "pages")
    listed = pages.where(url_filter.host_of(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.filter_urls(pages, url_filter.rule_rows(spark, URL_RULES), listed)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = WorkArea(spark, "op2").path
    token_store.write_tokens(_table(spark, sf_dir, "documents"), store, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_store.read_tokens(spark, store).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), keep="largest")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_model.score(docs, quality_model.fit(docs, quality_model.graded(labels)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(_table(spark, sf_dir, "documents"))


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(_table(spark, sf_dir, "conversations"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, repeats=2.0).drop("source")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), full=False)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), full=False)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least_docs=3, top_terms=200)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = WorkArea(spark, "op13").path
    warc.write_warc(_table(spark, sf_dir, "pages"), archive, least_bytes=0)
    return warc.read_warc(spark, archive, full=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_ALL = (op1_url_filter, op2_token_output, op3_exact_dedup, op4_near_dedup, op5_quality_model, op6_quality_rules, op7_lm_scores, op8_chat_repair, op9_mixing, op10_bpe, op11_token_alignment, op12_source_divergence, op13_warc)
QUERIES = {f.__name__: f for f in _ALL}

_RULES = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in URL_RULES)
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op1_url_filter": f"""
WITH rules(verdict, rule, rhost, rpath) AS (VALUES {_RULES}),
p AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
q AS (SELECT page_id, {_ASCII_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_replace(regexp_extract(rest, '^[^?#]*(\\?[^#]*)', 1), '^\\?$', '') AS query FROM p),
c AS (SELECT *, regexp_replace(host, '^www\\.|:\\d*$', '', 'g') || regexp_replace(path, '/+$', '') || query AS canonical FROM q),
listed AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '{LISTED_HOSTS}')),
fit AS (SELECT c.page_id, c.host, c.path, max(struct_pack(n := length(rule), rule := rule, verdict := verdict)) AS best
  FROM c JOIN rules ON (c.host = rhost OR ends_with(c.host, '.' || rhost)) AND starts_with(c.path, rpath) GROUP BY ALL)
SELECT c.page_id, c.host, c.path, fit.best.rule AS rule, l.canonical IS NOT NULL AS listed, coalesce(fit.best.verdict, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fit USING (page_id, host, path) LEFT JOIN listed l ON l.canonical = c.canonical AND c.host <> ''""",
    "op3_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_ASCII_LOWER.format("coalesce(text, '')")}) AS h FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)""",
    "op4_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) END) AS sh FROM w),
x AS (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * c >= 80 * (len(sa.sh) + len(sb.sh) - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, label) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(label) AS label FROM r GROUP BY 1)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, label AS component_id, doc_id = label AS kept FROM s JOIN m ON node = doc_id""",
}

_TERMS = f"regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '{divergence.TERM}')"
ORACLES["op12_source_divergence"] = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS ts FROM documents),
o AS (SELECT doc, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS all_n FROM o GROUP BY 1, 2 HAVING count(DISTINCT doc) >= 3),
c AS (SELECT o.lang, o.source, o.term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY 1, 2, 3),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(all_n)::HUGEINT AS total FROM k GROUP BY 1),
s AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + l.v) AS p, 1 + (1000000000::HUGEINT * (k.all_n + 1)) // (l.total + l.v) AS q
  FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r) WHERE part = 'pair' OR rank <= 200"""
_BITS = "array_to_string(list_transform(string_split(sha1(html), ''), lambda x: right(bin(strpos('123456789abcdef', x) + 16), 4)), '')"
_BASE32 = "array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, 5 * i + j + 1, 1) = '1' THEN CAST(pow(2, 4 - j) AS BIGINT) ELSE 0 END))::BIGINT, 1)), '')"
ORACLES["op13_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS keep FROM p GROUP BY 1),
b AS (SELECT page_id, strlen(html) AS payload_bytes, keep, {_BITS} AS bits FROM p JOIN g USING (html))
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> keep THEN keep END AS refers_to FROM b"""


def _rules_sql() -> str:
    """SQL of op6: words, lines and n-grams one row each."""
    blank, n_all = r"[\x20\x09-\x0D]", [quality_rules.BASE_WINDOW, *quality_rules.MOST_COVERED]
    parts = [
        f"w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{blank.replace('[', '[^', 1)}+') AS ws FROM documents)",
        "p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w)",
        f"f AS (SELECT doc_id, line, count(*) AS c, length(regexp_replace(line, '{blank}', '', 'g')) AS k FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) GROUP BY 1, 2)",
        "l AS (SELECT doc_id, sum(c - 1) AS dup, sum(CASE WHEN c > 1 THEN c * k ELSE 0 END) AS chars FROM f WHERE k > 0 GROUP BY 1)",
    ]
    for n in n_all:
        parts += [
            f"g{n} AS (SELECT doc_id, i, array_to_string(ws[i : i + {n - 1}], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM w WHERE len(ws) >= {n}))",
            f"d{n} AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g{n}) WHERE c > 1)",
            f"c{n} AS (SELECT doc_id, sum(length(x)) AS chars, count(*) AS words FROM (SELECT DISTINCT d.doc_id, d.i + k AS i FROM d{n} d, range(0, {n}) r(k)) JOIN p USING (doc_id, i) GROUP BY 1)",
        ]
    cols = ["doc_id", "CAST(len(ws) AS BIGINT) AS n_words", f"CAST(length(regexp_replace(t, '{blank}', '', 'g')) AS BIGINT) AS word_chars", "CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols"]
    cols += ["CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines", f"CAST(coalesce(c{n_all[0]}.words, 0) AS BIGINT) AS n_repeat_words", "CAST(coalesce(l.chars, 0) AS BIGINT) AS line_chars"]
    cols += [f"CAST(coalesce(c{n}.chars, 0) AS BIGINT) AS chars_{n}" for n in quality_rules.MOST_COVERED]
    joins = "LEFT JOIN l USING (doc_id) " + " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in n_all)
    parts.append(f"o AS (SELECT {', '.join(cols)} FROM w {joins})")
    base = f"(n_words < {quality_rules.BASE_WORDS} OR 100 * n_repeat_words > {quality_rules.BASE_PERCENT} * n_words)"
    over = [f"chars_{n} > CAST({most} AS DOUBLE) * word_chars" for n, most in quality_rules.MOST_COVERED.items()] + [f"line_chars > CAST({quality_rules.MOST_LINES} AS DOUBLE) * word_chars"]
    return f"WITH {', '.join(parts)} SELECT *, {base} AS base_failed, NOT ({base} OR {' OR '.join(over)}) AS kept FROM o"


ORACLES["op6_quality_rules"] = _rules_sql()
