"""E-mails, URLs, domains and pages found by search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpgraph.functions.common import text_of

# Patterns and site lists.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
NOISE = ["wikipedia.org", "yahoo.com", "news.yahoo.com", "bloomberg.com", "reuters.com", "marketwatch.com", "techcrunch.com", "crunchbase.com", "linkedin.com", "dwinnex.com", "wordpress.com", "blogspot.com", "medium.com", "zoominfo.com", "herokuapp.com", "sourceforge.net", "sec.gov", "bsky.app", "facebook.com", "twitter.com", "x.com", "duckduckgo.com/y.js", "bing.com/aclick", "ad_domain=", "ad_provider=", "utm_", "doubleclick.net"]
INVESTOR_TAGS = ["ir@", "investor@", "investors@", "shareholder"]
SERVICE_TAGS = ["support@", "service@", "help@", "info@", "care@"]
BAD_DOMAINS = ["microsoft.com", "amazon.com", "google.com", "bing.com", "duckduckgo.com", "yahoo.com", "reddit.com", "facebook.com", "instagram.com", "walmart.com", "bestbuy.com", "newegg.com", "lenovo.com"]
AD_REDIRECTS = ["duckduckgo.com/y.js", "aclick?"]
GENERIC_WORDS = ["inc", "corp", "company", "group", "ltd", "co", "holdings", "plc", "sa", "nv"]
DOMAIN_QUERIES = ["official website", "corporate site", "homepage", "investor relations"]
ROOT_ENDINGS = [".com", "inc.com", "corp.com", "co.com", "group.com"]
#: Public suffixes of two labels; all others count as one label.
LONG_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "com.mx", "co.in", "com.cn", "com.sg", "co.za", "co.kr", "com.tr"]


def has_any(text: Column, parts: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(text, p))


def emails(html: Column) -> Column:
    """Distinct e-mail addresses in code-point order."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text_of(html), F.lit(EMAIL), F.lit(0))))


def preferred_email(found: Column, tags: list[str]) -> Column:
    return F.coalesce(F.get(F.filter(found, lambda e: has_any(F.lower(e), tags)), F.lit(0)), F.get(found, F.lit(0)))


def is_noise(url: Column) -> Column:
    """Substring test, so ``x.com`` also covers hosts that end with it."""
    return has_any(F.lower(text_of(url)), NOISE)


def domain(url: Column) -> Column:
    """Registered domain: one label before the public suffix; null without a host that has one."""
    host = F.lower(F.regexp_extract(text_of(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(two.isin(LONG_SUFFIXES) & (two != three), three).when(host.contains(".") & ~two.isin(LONG_SUFFIXES), two)


def is_social(url: Column, site: str) -> Column:
    low = F.lower(text_of(url))
    if site == "twitter":
        return (low.contains("twitter.com/") | low.contains("x.com/")) & ~has_any(low, ["/status/", "/intent/", "/share", "/hashtag", "/search"])
    if site == "facebook":
        return low.contains("facebook.com/") & ~has_any(low, ["sharer", "php", "story.php", "l.php"])
    return low.contains("bsky.app/profile/")


def name_words(company: Column) -> Column:
    """Lower-case words of three letters or more."""
    return F.filter(F.split(F.trim(F.lower(text_of(company))), r"(?U)\W+"), lambda w: F.length(w) > 2)


def brand_words(company: Column) -> Column:
    """Words of the name that aren't generic; all of them if none is left."""
    every = name_words(company)
    own = F.filter(every, lambda w: ~w.isin(GENERIC_WORDS))
    return F.when(F.size(own) > 0, own).otherwise(every)


def initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")


def domain_queries(company: Column) -> Column:
    """Searches that may find a company's site, in order."""
    return F.array(*[F.concat(company, F.lit(f" {q}")) for q in DOMAIN_QUERIES])


def fallback_domains(company: Column) -> Column:
    """Domains to try in order where no search found one: the first word with usual endings, then each brand word."""
    root = F.get(name_words(company), F.lit(0))
    return F.array_compact(F.concat(F.array(*[F.concat(root, F.lit(e)) for e in ROOT_ENDINGS]), F.transform(brand_words(company), lambda w: F.concat(w, F.lit(".com")))))


def domain_score(site: Column, brand_tokens: Column, initials: Column) -> Column:
    """Brand words contained, one more for the initials, one more for .com."""
    return F.size(F.filter(brand_tokens, lambda t: F.contains(site, t))) + (F.contains(site, initials) & (initials != "")).cast("int") + site.endswith(".com").cast("int")
