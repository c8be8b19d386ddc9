"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed entries are *rules* (host with all its subdomains, and a path prefix) or
*pages* (one canonical URL). Both become canonical keys. A URL has few candidate
keys: one for each pair of host suffix and path prefix whose sizes occur among
the rules, and its own canonical form. Candidates that the Bloom filter passes go
to an exact join with the listed keys, which removes its false positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import bloom
from corpgraph.llm.work import WorkArea, left_join

#: Filters and lists of at most so many rows are broadcast (32 and about 100 bytes a row); larger ones are shuffled.
BROADCAST_BLOCKS, BROADCAST_KEYS = 1_000_000, 200_000
#: Distinct (host labels, path length) pairs that rules may have; each costs a candidate key a URL.
MAX_SHAPES = 4096
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def query_of(url: Column) -> Column:
    """The query with its question mark; empty where there is none or nothing after the mark."""
    query = F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))
    return F.when(query == "?", F.lit("")).otherwise(query)


def canonical(host: Column, path: Column, query: Column) -> Column:
    """Host without ``www.`` and port, path without trailing slashes, and the query."""
    return F.concat(F.regexp_replace(host, r"^www\.|:\d*$", ""), F.regexp_replace(path, "/+$", ""), query)


def rule_rows(spark, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, ``host/path``) pairs as rows of verdict, rule, host, path."""
    rows = [(v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in rules]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(k) for k in ("verdict", "rule", "host", "path")])
    made = [F.struct(*[F.lit(x).alias(k) for k, x in zip(("verdict", "rule", "host", "path"), r, strict=True)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*made)).alias("r")).select("r.*")


def url_rows(spark, urls: Sequence[str]) -> DataFrame:
    """URLs as rows of a column url."""
    if not urls:
        return spark.range(0).select(F.lit("").alias("url"))
    return spark.range(1).select(F.explode(F.array(*[F.lit(u) for u in urls])).alias("url"))


def _small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url", listed_verdict: str = "block", default_verdict: str = "allow") -> DataFrame:
    """One row for each row of ``pages``: page_id, host, path, rule, verdict, listed.

    ``rules``: verdict, rule, host, path (see ``rule_rows``). The longest rule that
    fits decides; of equally long ones that with the longer host, then the lesser
    rule. ``listed``: a column ``url`` of URLs that get ``listed_verdict`` where no
    rule fits; all others get ``default_verdict``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case. Path: from there up to ``?``, ``#`` or the end. Null and URLs without
    ``://`` have empty host and path and fit nothing. A listed URL means one page: its
    scheme, ``www.``, port, trailing slashes and fragment are of no account, its query is. Repeated rows and null ids
    give one row each. Empty tables give no rows; an empty list lists nothing.
    Other columns of ``pages`` are not read, whatever their names. A URL of any
    length has at most ``MAX_SHAPES`` + 1 candidates.
    """
    rules = rules.where("host <> ''").dropDuplicates(["verdict", "host", "path"])
    keyed = rules.select(F.concat(F.lit("r "), "host", "path").alias("key"), "verdict", "rule", F.length("host").alias("host_len"), F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("path_len"))
    shapes = sorted((r.labels, r.path_len) for r in keyed.select("labels", "path_len").distinct().limit(MAX_SHAPES + 1).collect())
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"rules have more than {MAX_SHAPES} pairs of host labels and path length")
    keyed = keyed.drop("labels", "path_len")
    if listed is not None:
        exact = listed.select(canonical(host_of(F.col("url")), path_of(F.col("url")), query_of(F.col("url"))).alias("c"), host_of(F.col("url")).alias("host")).where("host <> ''").select("c").distinct()
        keyed = keyed.unionByName(exact.select(F.concat(F.lit("p "), "c").alias("key"), F.lit(listed_verdict).alias("verdict"), F.lit(None).cast("string").alias("rule"), F.lit(0).alias("host_len")))
    n_keys = keyed.count()

    base = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), query_of(F.col(url_col)).alias("query"))
    labels = F.split("host", r"\.")
    made = [F.when((F.size(labels) >= n) & (F.length("path") >= m), F.concat(F.lit("r "), F.substring_index("host", ".", -n), F.substring("path", 1, m))) for n, m in shapes]
    if listed is not None:
        made.append(F.concat(F.lit("p "), canonical(F.col("host"), F.col("path"), F.col("query"))))
    if not made:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default_verdict).alias("verdict"), F.lit(False).alias("listed"))

    # Verdicts belong to (host, path, query): each distinct place is judged once, then joined back. URLs without a host need none.
    spot = ["host", "path", "query"]
    places = base.where("host <> ''").groupBy(*spot).agg(F.count("*").alias("rows"))
    blocks = bloom.block_count(n_keys)
    bits = _small(bloom.build(keyed, "key", blocks), blocks, BROADCAST_BLOCKS)
    probes = places.select(*spot, "rows", F.explode(F.array_compact(F.array(*made))).alias("key")).withColumn("block", bloom.block_of(F.col("key"), blocks))
    maybe = probes.join(bits, "block").where(bloom.passes(F.col("key"))).select(*spot, "rows", "key")
    hits = maybe.join(_small(keyed, n_keys, BROADCAST_KEYS), "key")
    best = hits.groupBy(*spot).agg(
        F.first("rows").alias("rows"),
        F.min(F.when(F.col("rule").isNotNull(), F.struct((-F.length("rule")).alias("a"), (-F.col("host_len")).alias("b"), F.col("rule"), F.col("verdict")))).alias("best"),
        F.max(F.col("rule").isNull()).alias("listed"),
    )
    area = WorkArea(pages.sparkSession, "url-filter")
    out = left_join(base.where("host <> ''"), area.save(best, "verdicts"), spot, "rows", pages.count())
    bare = base.where("host = ''").select("*", F.lit(None).cast(best.schema["best"].dataType).alias("best"), F.lit(False).alias("listed"))
    out = out.unionByName(bare)
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.when(F.col("listed"), F.lit(listed_verdict)), F.lit(default_verdict)).alias("verdict"), F.coalesce("listed", F.lit(False)).alias("listed"))
