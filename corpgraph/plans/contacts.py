"""Contacts of companies: domain, investor and service pages with e-mails, social links, and repair of gaps.

The search engine and the page fetcher are outside. What they return are tables:
``results`` (query, rank from 1, url) and ``pages`` (url, html), one row a url. Every
look-up is an equi-join on the text of the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpgraph.functions import companies, web
from corpgraph.functions.common import text_of
from corpgraph.operators.ops import not_done
from corpgraph.schemas import require_columns

# Search words of contact pages in order with the preferred e-mail tags, and of social sites.
CONTACT_PAGES = {
    "ir": (["investor relations", "investor", "ir"], web.INVESTOR_TAGS),
    "cs": (["customer service", "contact", "support", "help"], web.SERVICE_TAGS),
}
SOCIAL_SEARCHES = {"twitter": "official twitter x", "facebook": "official facebook page", "bluesky": "official bluesky"}
#: Hits that are looked at: of searches for sites and pages, for fallback domains, for social links.
SITE_HITS, FALLBACK_HITS, SOCIAL_HITS = 10, 3, 8


def blank(value: Column) -> Column:
    return F.trim(text_of(value)) == ""


def unique_companies(rows: DataFrame) -> DataFrame:
    """company, in order, with company_clean for searching."""
    names = require_columns(rows, ["company"]).select("company").distinct().orderBy("company")
    return names.withColumn("company_clean", companies.search_name(F.col("company")))


def hits(results: DataFrame, most: int) -> DataFrame:
    """The first ``most`` results of each query without empty urls and advertisers' redirects."""
    url = text_of(F.col("url"))
    return results.where((F.col("rank") <= most) & (url != "") & ~web.has_any(url, web.AD_REDIRECTS))


def found_domains(names: DataFrame, results: DataFrame) -> DataFrame:
    """company_clean, domain of those whose site was found.

    The best-scoring domain above 0 of the site searches counts, the earliest hit of
    equals; without one, the first fallback domain that a search for it confirms.
    """
    c = F.col("company_clean")
    named = names.select("company_clean").distinct().where(F.size(web.name_words(c)) > 0).withColumn("tokens", web.brand_words(c))

    def kind(queries: Column, spare: int) -> Column:
        return F.transform(queries, lambda q: F.struct(F.lit(spare).alias("spare"), q.alias("query")))

    asks = [kind(web.domain_queries(c), 0), kind(web.fallback_domains(c), 1)]
    asked = named.select("company_clean", "tokens", F.posexplode(F.concat(*asks)).alias("query_no", "q")).select("company_clean", "tokens", "query_no", "q.*")
    seen = asked.join(hits(results, SITE_HITS), "query").withColumn("domain", web.domain(F.col("url"))).where("domain is not null")
    own = ~web.is_noise(F.col("url")) & ~F.col("domain").isin(web.BAD_DOMAINS)
    score = F.when(F.col("spare") == 0, F.when(own, web.domain_score(F.col("domain"), F.col("tokens"), web.initials(F.col("tokens"))))).when((F.col("rank") <= FALLBACK_HITS) & (F.col("domain") == F.col("query")), F.lit(1))
    best = seen.withColumn("score", score).where("score > 0").groupBy("company_clean").agg(F.min(F.struct("spare", (-F.col("score")).alias("s"), "query_no", "rank", "domain")).alias("b"))
    return best.select("company_clean", "b.domain")


def contact_pages(named: DataFrame, results: DataFrame, pages: DataFrame) -> DataFrame:
    """company_clean, ir_page, ir_email, cs_page, cs_email of companies (company_clean, domain).

    A page is the first keyword's first hit on the company's own domain that isn't
    noise; it stays where it has no e-mail.
    """
    asks = [F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("at"), F.lit(k).alias("keyword")) for kind, (keywords, _) in CONTACT_PAGES.items() for i, k in enumerate(keywords)]
    asked = named.where("domain is not null").select("company_clean", "domain", F.explode(F.array(*asks)).alias("a")).select("company_clean", "domain", "a.*")
    asked = asked.withColumn("query", F.concat("company_clean", F.lit(" "), "keyword", F.lit(" site:"), "domain"))
    good = asked.join(hits(results, SITE_HITS), "query").where(F.contains(F.lower("url"), F.col("domain")) & ~web.is_noise(F.col("url")))
    page = good.groupBy("company_clean", "kind").agg(F.min(F.struct("at", "rank", "url")).alias("b")).select("company_clean", "kind", F.col("b.url").alias("url"))
    mail = page.join(pages.select("url", "html"), "url", "left").withColumn("e", web.emails(F.col("html")))
    out = []
    for kind, (_, tags) in CONTACT_PAGES.items():
        out += [F.max(F.when(F.col("kind") == kind, v)).alias(f"{kind}_{name}") for name, v in (("page", F.col("url")), ("email", web.preferred_email(F.col("e"), tags)))]
    return mail.groupBy("company_clean").agg(*out)


def extract_contacts(names: DataFrame, results: DataFrame, pages: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """One row for each of ``names`` (company, company_clean) not among ``done``; what wasn't found is null.

    error: the least error of the company's failed searches and page fetches, where
    ``results`` or ``pages`` say so in a column error.
    """
    names = not_done(names, done, "company")
    found = found_domains(names, results)
    out = names.join(found, "company_clean", "left").join(contact_pages(found, results, pages), "company_clean", "left")
    failed = F.lit(None).cast("string")
    if "error" in results.columns:
        asks = names.select("company_clean").distinct().withColumn("query", F.explode(F.concat(web.domain_queries(F.col("company_clean")), web.fallback_domains(F.col("company_clean")))))
        errors = asks.join(results.where("error is not null").select("query", "error"), "query").groupBy("company_clean").agg(F.min("error").alias("_searching"))
        out, failed = out.join(errors, "company_clean", "left"), F.col("_searching")
    if "error" in pages.columns:
        lost = pages.where("error is not null").groupBy("url").agg(F.min("error").alias("e"))
        for kind in CONTACT_PAGES:
            out = out.join(lost.select(F.col("url").alias(f"{kind}_page"), F.col("e").alias(f"_{kind}")), f"{kind}_page", "left")
            failed = F.coalesce(failed, f"_{kind}")
    return out.select("company", "company_clean", "domain", "ir_page", "ir_email", "cs_page", "cs_email", failed.alias("error"))


def social_links(names: DataFrame, results: DataFrame) -> DataFrame:
    """company_clean, twitter_url, facebook_url, bluesky_url: the first fitting hit of each site's search, else null."""
    own = names.select("company_clean").distinct()
    each = F.array(*[F.struct(F.lit(s).alias("site"), F.concat("company_clean", F.lit(f" {q}")).alias("query")) for s, q in SOCIAL_SEARCHES.items()])
    seen = own.select("company_clean", F.explode(each).alias("s")).select("company_clean", "s.*").join(hits(results, SOCIAL_HITS), "query")
    fits = {s: (F.col("site") == s) & web.is_social(F.col("url"), s) for s in SOCIAL_SEARCHES}
    links = seen.groupBy("company_clean").agg(*[F.min(F.when(ok, F.struct("rank", "url"))).alias(s) for s, ok in fits.items()])
    return own.join(links.select("company_clean", *[F.col(f"{s}.url").alias(f"{s}_url") for s in SOCIAL_SEARCHES]), "company_clean", "left")


def with_social(contacts: DataFrame, results: DataFrame) -> DataFrame:
    """``contacts`` with its social links, found anew."""
    return contacts.drop(*[f"{s}_url" for s in SOCIAL_SEARCHES]).join(social_links(contacts, results), "company_clean", "left")


def complete_social(contacts: DataFrame) -> DataFrame:
    """complete: rows that have all three social links."""
    whole = F.lit(True)
    for s in SOCIAL_SEARCHES:
        whole = whole & F.col(f"{s}_url").isNotNull()
    return contacts.agg(F.count_if(whole).alias("complete"))


def incomplete() -> Column:
    """Whether a row lacks its domain (or has one of under three letters), a page or a social link."""
    out = F.coalesce(F.length("domain") < 3, F.lit(True))
    for c in ("ir_page", "cs_page", *[f"{s}_url" for s in SOCIAL_SEARCHES]):
        out = out | F.col(c).isNull()
    return out


def repair(contacts: DataFrame, results: DataFrame, pages: DataFrame) -> DataFrame:
    """``contacts`` with what incomplete rows lacked, as far as it is found.

    A short or missing domain is discovered again. Where a page is blank, a new page
    and its e-mail replace the old ones if they are found; blank social links are
    searched again. Complete rows stay as they are. Rows of the same company_clean
    share the least of their domains for page searches.
    """
    for s in SOCIAL_SEARCHES:
        if f"{s}_url" not in contacts.columns:
            contacts = contacts.withColumn(f"{s}_url", F.lit(None).cast("string"))
    need = incomplete()
    columns = contacts.columns
    rows = contacts.withColumn("_need", need)
    short = F.coalesce(F.length("domain") < 3, F.lit(True))
    again = found_domains(rows.where(F.col("_need") & short), results).withColumnRenamed("domain", "_domain")
    rows = rows.join(again, "company_clean", "left").withColumn("domain", F.when(F.col("_need") & short, F.col("_domain")).otherwise(F.col("domain")))
    named = rows.where("_need and domain is not null").groupBy("company_clean").agg(F.min("domain").alias("domain"))
    new = [f"{kind}_{name}" for kind in CONTACT_PAGES for name in ("page", "email")]
    rows = rows.join(contact_pages(named, results, pages).withColumnsRenamed({c: f"_{c}" for c in new}), "company_clean", "left")
    open_ = {kind: F.col("_need") & blank(F.col(f"{kind}_page")) & F.col("domain").isNotNull() for kind in CONTACT_PAGES}
    rows = rows.withColumns({c: F.when(open_[c[:2]], F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in new})
    links = social_links(contacts.where(need), results).withColumnsRenamed({f"{s}_url": f"_{s}" for s in SOCIAL_SEARCHES})
    rows = rows.join(links, "company_clean", "left")
    rows = rows.withColumns({f"{s}_url": F.when(F.col("_need") & blank(F.col(f"{s}_url")), F.col(f"_{s}")).otherwise(F.col(f"{s}_url")) for s in SOCIAL_SEARCHES})
    return rows.select(*columns)
