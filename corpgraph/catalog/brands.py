"""Queries over brand requests: mail payloads, blocks, candidates, canonical names and counts."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from corpgraph.catalog.base import TITLE_CASE, cases, duck, folder, letters, query, stand_in, t
from corpgraph.functions import brands as br
from corpgraph.plans import brands
from corpgraph.schemas import strings
from corpgraph.streaming import ingest

_A = letters("o_orderkey")
_N = "upper(substr({0}, 1, 1)) || substr({0}, 2)".format(letters("(o_orderkey % 97)"))

# --- blocks and candidates: one an order -----------------------------------------------

_BLOCKS = f"""SELECT o_orderkey AS n, {cases("o_orderkey", f"{_N} || ', Globex and Initech'", f"'Umbrella ' || {_N} || ' (Red, White)'", f"{_N} || '/Hooli /  '", "''", "CAST(NULL AS STRING)", f"'Oil and Gas ' || {_N} || ' And Bo. Based in Ohio, x'", f"'Absolut (A, B) more, ' || {_N} || ' and vodka'", f"'((' || {_N} || ', b), c'")} AS block FROM {{orders}}"""
_NAMED = {
    0: ["{N}", "'Globex'", "'Initech'"],
    1: ["'Umbrella ' || {N}", "'Red'", "'White'"],
    2: ["{N}", "'Hooli'"],
    5: ["'Oil and Gas ' || {N} || ' And Bo'"],
    6: ["'Absolut (A, B) more'", "{N} || ' and vodka'"],
    7: ["'((' || {N} || ', b), c'"],
}


@query(" UNION ALL ".join(f"SELECT o_orderkey AS n, {i} AS position, {x.format(N=_N)} AS brand FROM orders WHERE o_orderkey % 8 = {k}" for k, xs in _NAMED.items() for i, x in enumerate(xs)))
def brand_split(spark, d):
    """Brands named in request blocks: slashes, commas, brackets, one ``and``, protected names, nested brackets."""
    return stand_in(spark, d, _BLOCKS).select("n", F.posexplode(br.split_brands("block")).alias("position", "brand"))


_RAW = f"""SELECT o_orderkey AS n, {cases("o_orderkey", f"{_N} || ' foods'", "'www.acme.com'", f"'does it sell? ' || {_N}", "'are they good'", "'i think it is. Acme Co'", "'toilet paper'", f"'kHOLS  ' || {_N} || '!!'", "'IBM'", "'a b c d e f g h i'", "''", "'Cosco'", "'Jersy Mikes.'", "'support them i think'", f"'ACME ' || {_N} || ' â€“ Cafe'")} AS raw FROM {{orders}}"""
_FIXED = "CASE {0} " + " ".join("WHEN '" + k.replace("'", "''") + "' THEN '" + v.replace("'", "''") + "'" for k, v in br.ALIASES.items()) + " ELSE {0} END"


@query(f"""WITH v AS ({duck(_RAW)}), a AS (SELECT n, raw, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS x FROM v),
q AS (SELECT *, CASE WHEN NOT contains(x, '?') THEN x WHEN len(trim(string_split(x, '?')[-1])) BETWEEN 2 AND 60 THEN trim(string_split(x, '?')[-1]) END AS v1 FROM a),
c AS (SELECT *, CASE WHEN regexp_matches(lower(v1), '{br.COMMENT}') THEN CASE WHEN contains(v1, '.') AND len(trim(string_split(v1, '.')[-1])) BETWEEN 2 AND 60 AND NOT regexp_matches(lower(trim(string_split(v1, '.')[-1])), '{br.COMMENT}') THEN trim(string_split(v1, '.')[-1]) END ELSE v1 END AS v2 FROM q),
k AS (SELECT n, raw, CASE WHEN raw <> '' AND NOT regexp_matches(x, '{br.WEBSITE}') AND NOT regexp_matches(lower(v1), '{br.QUESTION}') AND NOT list_contains({br.GENERIC}, lower(v1)) AND len(v2) <= 80 AND len(string_split(v2, ' ')) <= 8 THEN v2 END AS candidate FROM c),
m AS (SELECT n, raw, candidate, trim(regexp_replace(regexp_replace(trim(replace(candidate, 'â€“', '–')), '[.!?;:\\-]+$', ''), '\\s+', ' ', 'g')) AS f FROM k),
b AS (SELECT n, raw, candidate, CASE WHEN candidate IS NULL THEN '' WHEN regexp_full_match(f, '[A-Z0-9&]{{2,}}') THEN f ELSE {TITLE_CASE.format("f")} END AS brand FROM m)
SELECT n, raw, candidate, brand, {_FIXED.format("brand")} AS known FROM b""")
def brand_candidates(spark, d):
    """The brand in a phrase, its normal form, and its usual name, for a phrase of each order."""
    c = br.clean_candidate(F.col("raw"))
    brand = F.when(c.isNull(), F.lit("")).otherwise(br.normalize_brand(c))
    return stand_in(spark, d, _RAW).select("n", "raw", c.alias("candidate"), brand.alias("brand"), br.apply_alias(brand).alias("known"))


_REPAIRED = functools.reduce(lambda x, p: f"replace({x}, '{p[0]}', '{p[1]}')", br.MOJIBAKE, "coalesce(replace(replace(text, 'é', 'Ã©'), 'ü', 'Ã¼') || 'â€™', '')")


@query(f"SELECT doc_id, {_REPAIRED} AS fixed FROM documents")
def mojibake_repair(spark, d):
    """Texts of all documents with broken letters put in, and repaired."""
    docs = t(spark, d, "documents").select("doc_id", F.concat(F.replace(F.replace("text", F.lit("é"), F.lit("Ã©")), F.lit("ü"), F.lit("Ã¼")), F.lit("â€™")).alias("text"))
    return docs.select("doc_id", br.fix_mojibake(F.col("text")).alias("fixed"))


# --- mail: one message an order ----------------------------------------------------------

_ASKS = f"""SELECT o_orderkey AS n, printf('%08d', o_orderkey) AS message_id, {cases("o_orderkey", f"'Hello, I''d like to know more details about: ' || {_N} || ' Foods and Globex Thanks!'", f"'I’d like to know more details about: ' || {_N} || 'w foods / Cosco. Based in Ohio thanks'", "'none'", "''", f"'hi I''d like to know more details about:  thanks'")} AS body, {cases("o_orderkey", "'hi'", "'details about: Acme'", f"'Details about: ' || {_N} || ' Food thanks'", "'hello'")} AS subject FROM {{orders}}"""
_MAIL = _ASKS.replace("SELECT o_orderkey AS n, printf(", "SELECT o_orderkey AS n, format_string(")


def _messages(spark, d):
    """message_id, internal_date_ms, payload_json: multipart bodies in base64 for URLs, a date header on every other one."""
    m = stand_in(spark, d, _MAIL)
    data = F.regexp_replace(F.translate(F.base64(F.encode("body", "UTF-8")), "+/", "-_"), "[=\\s]", "")
    at = F.timestamp_seconds(F.lit(1_704_103_200) + F.col("n"))
    dated = F.when(F.col("n") % 2 == 0, F.array(F.struct(F.lit("DATE").alias("name"), F.concat(F.lit("Mon, "), F.date_format(at, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("value")))).otherwise(F.array())
    headers = F.concat(F.array(F.struct(F.lit("Subject").alias("name"), F.col("subject").alias("value"))), dated)
    plain = F.struct(F.lit("text/plain").alias("mimeType"), F.struct(data.alias("data")).alias("body"))
    html = F.struct(F.lit("text/html").alias("mimeType"), F.struct(F.lit("eA").alias("data")).alias("body"))
    payload = F.to_json(F.struct(F.lit("multipart/mixed").alias("mimeType"), headers.alias("headers"), F.array(html, plain).alias("parts")))
    return m.select("message_id", F.format_string("%d", (F.lit(1_704_103_200) + F.col("n")) * 1000).alias("internal_date_ms"), payload.alias("payload_json"))


_DECODED = f"SELECT message_id, make_timestamp(CAST((1704103200 + n) * 1000000 AS BIGINT)) AS date, subject, body FROM ({duck(_ASKS)})"


@query(_DECODED)
def mail_decoding(spark, d):
    """Body, subject and date of all messages."""
    return ingest.decoded(_messages(spark, d)).select("message_id", F.col("date").cast("timestamp_ntz").alias("date"), "subject", "body")


def _mentioned() -> str:
    """Expected mentions, straight from how the messages are made: message, position, raw, clean, source."""
    rows = []
    body = {0: [(f"{_N} || ' Foods'",) * 2, ("'Globex'",) * 2], 1: [(f"{_N} || 'w foods'", f"{_N} || 'w Foods'"), ("'Cosco'", "'Costco'")]}
    for k, names in body.items():
        rows += [f"SELECT o_orderkey AS n, {i} AS position, {raw} AS brand_raw, {clean} AS brand_clean, 'body' AS source FROM orders WHERE o_orderkey % 5 = {k}" for i, (raw, clean) in enumerate(names)]
    # In the other messages the subject decides; a body whose block is empty gives nothing.
    rows.append("SELECT o_orderkey, 0, 'Acme', 'Acme', 'subject' FROM orders WHERE o_orderkey % 5 IN (2, 3) AND o_orderkey % 4 = 1")
    rows.append(f"SELECT o_orderkey, 0, {_N} || ' Food', {_N} || ' Food', 'subject' FROM orders WHERE o_orderkey % 5 IN (2, 3) AND o_orderkey % 4 = 2")
    return " UNION ALL ".join(rows)


@query(f"WITH m AS ({_mentioned()}) SELECT printf('%08d', n) AS message_id, CAST(position AS INT) AS position, brand_raw, brand_clean, source FROM m")
def brand_mentions(spark, d):
    return brands.mentions(ingest.decoded(_messages(spark, d))).select("message_id", "position", "brand_raw", "brand_clean", "source")


# --- canonical names: requests of twelve spellings in order -----------------------------

_SEEN = f"""SELECT o_orderkey AS n, {cases("o_orderkey", "'Acme Foods'", "'ACME FOODS'", "'Foods Acme'", "'Globex'", "'Globexx'", "'Globexes'", "'Initech'", "'globex'", "'Acme Food'", "'Umbrella Holdings'", "'Umbrela Holdings'")} AS brand FROM {{orders}}"""
#: What each spelling becomes, whatever its message: Globexes is too far from Globex (80), and Globexx (92) merges.
_CANON = {"ACME FOODS": "Acme Foods", "Foods Acme": "Acme Foods", "Globexx": "Globex", "globex": "Globex", "Acme Food": "Acme Foods", "Umbrela Holdings": "Umbrella Holdings"}
_CANONICAL = f"SELECT n, brand, CASE brand {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _CANON.items())} ELSE brand END AS name FROM ({duck(_SEEN)})"


def _found(spark, d):
    return stand_in(spark, d, _SEEN).select(F.format_string("%08d", "n").alias("message_id"), F.lit(0).alias("position"), F.col("brand").alias("brand_clean"), F.timestamp_seconds(F.lit(1_704_103_200) + F.col("n")).alias("date"))


@query(f"WITH c AS ({_CANONICAL}) SELECT printf('%08d', n) AS message_id, name AS brand_canonical, CASE WHEN brand = 'Globexes' AND n = (SELECT min(n) FROM c WHERE brand = 'Globexes') THEN 'Globex' END AS suggested FROM c")
def canonical_brands(spark, d):
    found = _found(spark, d)
    return brands.canonical_brands(found).select("message_id", "brand_canonical", "suggested")


#: Three spellings of a name for each customer, all alike at 90 and unlike those of other customers.
_SPELLED = """SELECT o_orderkey AS n, o_custkey AS c, CASE o_orderkey % 3 WHEN 0 THEN upper(md5(CAST(o_custkey AS STRING))) || ' Foods' WHEN 1 THEN 'Foods ' || upper(md5(CAST(o_custkey AS STRING))) ELSE upper(md5(CAST(o_custkey AS STRING))) || 'X Foods' END AS brand FROM {orders}"""


@query(f"SELECT arg_min(brand, n) AS name, make_timestamp(CAST((1704103200 + min(n)) * 1000000 AS BIGINT)) AS added FROM ({duck(_SPELLED)}) GROUP BY c")
def canonical_spellings(spark, d):
    """Each customer's first spelling, out of three for each customer with orders."""
    found = stand_in(spark, d, _SPELLED).select(F.format_string("%08d", "n").alias("message_id"), F.lit(0).alias("position"), F.col("brand").alias("brand_clean"), F.timestamp_seconds(F.lit(1_704_103_200) + F.col("n")).alias("date"))
    return brands.canonical_names(found).select("name", F.col("added.date").cast("timestamp_ntz").alias("added"))


_COUNTS = f"SELECT name AS brand_canonical, CAST(count(*) AS BIGINT) AS count, make_timestamp(CAST((1704103200 + min(n)) * 1000000 AS BIGINT)) AS first_seen, make_timestamp(CAST((1704103200 + max(n)) * 1000000 AS BIGINT)) AS last_seen FROM ({_CANONICAL}) GROUP BY 1"


def _counts(spark, d):
    found = _found(spark, d)
    counts = brands.brand_counts(found, brands.canonical_brands(found))
    return counts.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_seen", "last_seen")})


@query(_COUNTS)
def brand_counts(spark, d):
    return _counts(spark, d)


@query(f"SELECT brand_canonical AS brand_canonical_clean, count, first_seen, last_seen FROM ({_COUNTS})")
def clean_brands(spark, d):
    """All these names are kept as they are."""
    return brands.clean_brands(brands.labelled(_counts(spark, d)))


# --- streams ---------------------------------------------------------------------------


@query(_DECODED)
def stream_ingest_equals_batch(spark, d):
    """All messages as files, read by a stream that runs twice over them with one checkpoint."""
    base = folder(spark, "ingest")
    _messages(spark, d).write.json(f"{base}/in")
    for _ in range(2):
        ingest.ingest(spark, f"{base}/in", f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("message_id", F.col("date").cast("timestamp_ntz").alias("date"), "subject", "body")


@query(f"SELECT message_id, body FROM ({duck(_ASKS)})")
def stream_append_once(spark, d):
    """The same files through micro-batches that append rows and log their ids; then all of them again under other file names."""
    base = folder(spark, "append")
    schema = strings("message_id body")
    m = stand_in(spark, d, _MAIL).select("message_id", "body")
    for name in ("one", "two"):
        m.write.mode("append").json(f"{base}/in/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).json(f"{base}/in")
        ingest.append_batches(stream, f"{base}/out", f"{base}/log", f"{base}/state").awaitTermination()
    return ingest.committed(spark, f"{base}/out", schema)
