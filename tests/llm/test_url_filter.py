import random

from corpgraph.llm import bloom, url_filter

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def brute(url, rules, listed, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(r), v, r) for v, r in rules if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    if fit:
        _, verdict, rule = max(fit)
        return host, path, rule, verdict
    query = rest.split("#")[0].partition("?")[2]
    name = (host.removeprefix("www.") + path.rstrip("/") + ("?" + query if query else "")) if host else None
    return host, path, None, "block" if name in listed else default


def test_equal_to_brute_force(spark):
    r = random.Random(1)
    hosts = ["org", "example.org", "a.example.org", "notexample.org", "x.com", "WWW.Shop.Net", "com", "ünï.com", ""]
    paths = ["", "/", "/es/", "/en/1", "/en/12/x", "/en/2", "/fr/a", "/de/", "/DE/", "/a/b//"]
    urls = [r.choice(["http://", "https://", "//", "x://y://"]) + r.choice(hosts) + r.choice(paths) + r.choice(["", "?q=/es/", "#f", "?a#b"]) for _ in range(600)]
    urls += [None, "", "://", "no scheme", "http://" + "a." * 5000 + "org/" + "p" * 20000, "http://x.com\n/fr/ü"]
    listed = ["http://www.shop.net/a/b/#x", "http://shop.net/a/b?q=/es/#y", "https://y://z"]
    names = {"shop.net/a/b", "shop.net/a/b?q=/es/"}
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[0], "h")], "page_id long, url string, host string")
    got = url_filter.filter_urls(df.repartition(3), url_filter.rule_rows(spark, RULES), url_filter.url_rows(spark, listed)).collect()
    assert len(got) == len(urls) + 1
    for x in got:
        if x.page_id is not None and not (urls[x.page_id] or "").startswith("x://"):
            assert (x.host, x.path, x.rule, x.verdict) == brute(urls[x.page_id], RULES, names), urls[x.page_id]
    again = url_filter.filter_urls(df.repartition(9), url_filter.rule_rows(spark, RULES), url_filter.url_rows(spark, listed)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and any(x.listed for x in got)
    assert url_filter.filter_urls(df.limit(0), url_filter.rule_rows(spark, RULES)).count() == 0
    assert {x.verdict for x in url_filter.filter_urls(df, url_filter.rule_rows(spark, [])).collect()} == {"allow"}


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    blocks = bloom.block_count(5000)
    bits = bloom.build(keys, "key", blocks)
    probe = spark.range(20000).selectExpr("id", "concat('k', id) AS key")
    from pyspark.sql import functions as F

    hit = {r.id for r in probe.withColumn("block", bloom.block_of(F.col("key"), blocks)).join(bits, "block").where(bloom.passes(F.col("key"))).collect()}
    assert set(range(5000)) <= hit
    assert len(hit) - 5000 < 0.01 * 15000
