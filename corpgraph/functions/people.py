"""Person names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpgraph.functions.common import collapse, decomposed, sub, text_of, words

# Words of roles, name particles and suffixes, and of what isn't a person.
ROLE_TERMS = """officer officers president vice-president vicepresident vice chair chairman chairperson
director directors partner partners trustee trustees member members stockholder stockholders shareholder shareholders
advisor advisers adviser consultants consultant manager managers employee employees employer
counsel secretary treasurer controller comptroller attorney
affiliates affiliate subsidiary subsidiaries principal principals owner owners
board committee corporation corp inc llc ltd plc co company companies association
executive operating financial legal accounting compliance general corporate administrative
svp evp avp vp cfo ceo coo cto clo cso cio cro cmo cao gc""".split()
PARTICLES = "da|de|del|de la|di|du|la|le|van|von|der|den|dos|das|mac|mc|bin|ibn|al"
SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v"]
WORD = r"[A-Z][a-z]+|[A-Z]\.?|[A-Z][a-z]+[-'][A-Z][a-z]+|O['’][A-Z][a-z]+"
NAME_SPAN = rf"((?:{WORD})(?:\s+(?:{WORD}|(?:{PARTICLES})))+)"
NOT_PERSONS = (
    "Prepared Remarks|Good Standing|Qualified Transferee|Diligence|Milestones|Retirement|Witness|Indemnifying|Securities|"
    "Transfer Restricted|Baton Rouge|Ganado Advocates|Due Diligence|Mutual Acknowledgment|Hasche Sigle|Dykema Gossett|"
    "Gunderson Dettmer|Advocates|Consulting|LLP|LLC|Group|Corp|Holdings|Capital|Incorporated|Partners|PLC|Advisors|"
    "Associates|Inc|Company|Enterprises|Legal|Strategy|Bank|Investments|Management|Services"
)


def token_is_name_like(token: Column) -> Column:
    tok = F.replace(token, F.lit("’"), F.lit("'"))
    plain = sub(tok, r"[^A-Za-z\-']", "")
    low = F.lower(plain)
    return (plain != "") & (
        tok.rlike(r"^[A-Z]\.?$")
        | tok.rlike(r"^[A-Z][a-z]+(?:[-'][A-Z][a-z]+)+$")
        | (tok.rlike(r"^[A-Z][a-z]+$") & ~low.isin(ROLE_TERMS))
        | low.isin([*PARTICLES.split("|"), *SUFFIXES])
    )


def best_name(text: Column) -> Column:
    """The name-like span nearest to two words, then the shortest, then the first; null if none."""
    spaced = F.replace(F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2"), F.lit("’"), F.lit("'"))
    spans = F.transform(F.regexp_extract_all(spaced, F.lit(NAME_SPAN), F.lit(1)), lambda s: F.trim(s))

    def good(span: Column) -> Column:
        toks = words(span)
        n = F.size(F.filter(toks, token_is_name_like))
        role = F.exists(toks, lambda t: F.lower(sub(t, r"^\.+|\.+$", "")).isin(ROLE_TERMS))
        return (n >= F.greatest(F.lit(2), F.size(toks) - 1)) & ~role

    ranked = F.transform(F.filter(spans, good), lambda s, i: F.struct(F.abs(F.size(words(s)) - 2).alias("a"), F.length(s).alias("b"), i.alias("i"), s.alias("s")))
    return F.array_min(ranked)["s"]


def looks_like_name(name: Column) -> Column:
    toks = words(F.trim(text_of(name)))
    return (F.size(toks) >= 2) & F.forall(toks, token_is_name_like)


def is_valid_name(name: Column) -> Column:
    n = F.trim(text_of(name))
    return (n != "") & ~n.rlike(f"(?i){NOT_PERSONS}") & (F.size(words(n)) <= 6) & ~n.rlike(r"\p{Nd}") & ~((F.upper(n) == n) & n.rlike(r"\p{L}") & (F.length(n) > 2))


def drop_contact_words(name: Column) -> Column:
    return F.trim(sub(name, r"\b(Email|Phone)\b", ""))


def person_norm(name: Column) -> Column:
    """Decomposed, with single spaces."""
    return collapse(decomposed(text_of(name)))


def name_parts(name: Column) -> Column:
    """struct(up, first, last): upper case without commas and generation suffixes."""
    up = F.upper(F.replace(text_of(name), F.lit(","), F.lit(" ")))
    up = collapse(sub(up, r"\b(JR|SR|II|III|IV|V)\b\.?", " "))
    toks = words(up)
    return F.struct(up.alias("up"), F.coalesce(F.get(toks, F.lit(0)), F.lit("")).alias("first"), F.coalesce(F.try_element_at(toks, F.lit(-1)), F.lit("")).alias("last"))
