"""Source divergence audit: how far the term distributions of a language's sources lie apart.

Shares are whole numbers: p = 1 + floor(UNIT (count + 1) / (N + V)) for a term's count
in a source, where V terms of the language are kept and N is the source's count of
them. The divergence of p from q is the sum over all V terms of floor((p - q)^2 / q).

It comes from an inverted index with baseline correction. Each ordered pair of sources
starts at V times the value of two zero counts. Terms that one side alone has correct
that by their counts only, so terms of equal count are corrected together; terms that
both sides have are corrected one by one, from the term's postings. No term that a
pair lacks on both sides costs anything.

Sums are decimals of 38 digits, so they are exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.work import WorkArea, releasing

UNIT = 1_000_000_000
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of text whose terms are counted at once, and rows of a batch that leaves the worker.
SLICE_BYTES, OUT_ROWS = 8 << 20, 100_000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of names and counts of all groups up to which that table is broadcast; beyond it is shuffled.
BROADCAST_BYTES = 8 << 20
_SUM = "decimal(38,0)"


def _terms(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each slice: terms get codes in Arrow, (group, term) and (text, term) are counted as numbers."""
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text", SLICE_BYTES):
            inside = _LETTER[raw]
            opens = inside.copy()
            opens[1:] &= ~inside[:-1]
            filled = offsets[:-1][offsets[:-1] < offsets[1:]]
            opens[filled] = inside[filled]
            start = np.flatnonzero(opens)
            if len(start) == 0:
                continue
            upto = np.append(0, np.cumsum(inside))
            edges = np.append(upto[start], upto[-1]).astype(np.int64)
            found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(_LOWER[raw[inside]])]).dictionary_encode()
            code, k = found.indices.to_numpy().astype(np.int64), len(found.dictionary)
            text = np.repeat(np.arange(part.num_rows), np.diff(np.searchsorted(start, offsets)))
            langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            keys, n = np.unique(group[text] * k + code, return_counts=True)
            once = np.unique(text * k + code)
            df = np.unique(group[once // k] * k + once % k, return_counts=True)[1]
            for at in range(0, len(keys), OUT_ROWS):
                key = keys[at : at + OUT_ROWS]
                names = [langs.dictionary.take(pa.array(key // k // len(sources.dictionary))), sources.dictionary.take(pa.array(key // k % len(sources.dictionary))), pc.cast(found.dictionary.take(pa.array(key % k)), pa.string())]
                yield pa.RecordBatch.from_arrays([*names, pa.array(n[at : at + OUT_ROWS]), pa.array(df[at : at + OUT_ROWS])], ["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, df: occurrences, and documents with the term; summed by slice and by task before the shuffle."""
    rows = docs.select("lang", "source", "text").mapInArrow(releasing(_terms), "lang string, source string, term string, n long, df long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (count + 1) / (total + kept)); the product may pass 64 bits."""
    return F.lit(1).cast("long") + F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + F.lit(1)).cast("decimal(20,0)"), (total + kept).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _attach(rows: DataFrame, groups: DataFrame, small: bool, *keys: str) -> DataFrame:
    return rows.join(F.broadcast(groups) if small else groups, list(keys))


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = 3, top_terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank for each (lang, source) of ``docs``.

    Part ``pair``: each other source of the language, and the divergence of the source
    from it, all ranks. Part ``term``: terms whose share in the source is above their share
    in the language, by their part of the divergence from it, ranks to ``top_terms``.
    Rank 1 is the highest value; ties go by the item's bytes.

    Terms are runs of letters, A-Z lower-cased; those in fewer than ``least_docs``
    documents of the language are left out. Null texts, languages and sources count as ''.
    Sources without kept terms take part with zero counts; a language without kept
    terms has divergence 0. Repeated rows are documents like others; an empty table gives no
    rows; other columns are not read; whole texts count, of any length.
    """
    spark = docs.sparkSession
    area = WorkArea(spark, "divergence")
    blank = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    texts = docs.select(blank(lang_col, "lang"), blank(source_col, "source"), blank(text_col, "text"))
    counts = area.save(term_counts(texts), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("df").alias("df")).where(F.col("df") >= least_docs).drop("df")
    postings = area.save(counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "postings")
    # Every group, those without kept terms too; N of each group and of its language, V of the language.
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_n").alias("lang_total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("total"), zero("v"), zero("lang_total"))
    groups = area.save(groups, "groups")
    size = groups.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + 32)).first()[0] or 0
    small = size <= BROADCAST_BYTES
    p = lambda n: F.when(F.col("v") > 0, share(n, F.col("total"), F.col("v")))
    known = _attach(postings, groups, small, "lang", "source").withColumn("p", p(F.col("n")))

    # Terms above their language's share.
    over = known.withColumn("q", share(F.col("all_n"), F.col("lang_total"), F.col("v"))).where("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    best_terms = over.withColumn("rank", F.expr("row_number() over (partition by lang, source order by value desc, item)")).where(F.col("rank") <= top_terms)

    # Ordered pairs of sources: s the group, t the other.
    side = lambda frame, k, *names: frame.select("lang", *[F.col(n).alias(f"{k}_{n}") for n in names])
    zeros = groups.withColumn("p0", p(F.lit(0)))
    sides = [side(zeros, k, "source", "p0") for k in ("s", "t")]
    pairs = sides[0].join(F.broadcast(sides[1]) if small else sides[1], "lang").where("s_source <> t_source")
    base = pairs.join(F.broadcast(langs.select("lang", "v")) if small else langs.select("lang", "v"), "lang", "left")
    base_value = F.coalesce(F.col("v"), F.lit(0)).cast("decimal(18,0)") * F.coalesce(distance(F.col("s_p0"), F.col("t_p0")), F.lit(0)).cast("decimal(19,0)")
    base = base.select("lang", "s_source", "t_source", base_value.cast(_SUM).alias("value"))

    def corrections(rows: DataFrame, value: Column, times: Column) -> DataFrame:
        return rows.where(value != 0).select("lang", "s_source", "t_source", (value.cast("decimal(19,0)") * times.cast("decimal(18,0)")).cast(_SUM).alias("value"))

    zero_zero = distance(F.col("s_p0"), F.col("t_p0"))
    # One side has the term: its groups' counts alone matter, and how many terms have each.
    by_count = known.groupBy("lang", "source", "p").agg(F.count("*").alias("times"))
    held = [pairs.join(x, ["lang", f"{k}_source"]) for k, x in (("s", side(by_count, "s", "source", "p", "times")), ("t", side(by_count, "t", "source", "p", "times")))]
    one = corrections(held[0], distance(F.col("s_p"), F.col("t_p0")) - zero_zero, F.col("s_times")).unionByName(corrections(held[1], distance(F.col("s_p0"), F.col("t_p")) - zero_zero, F.col("t_times")))
    # Both have it: what is left beside the two corrections for one side.
    with_zero = known.withColumn("p0", p(F.lit(0))).select("lang", "term", "source", "p", "p0")
    left, right = (with_zero.select("lang", "term", *[F.col(n).alias(f"{k}_{n}") for n in ("source", "p", "p0")]) for k in ("s", "t"))
    met = left.join(right, ["lang", "term"]).where("s_source <> t_source")
    two = corrections(met, distance(F.col("s_p"), F.col("t_p")) - distance(F.col("s_p"), F.col("t_p0")) - distance(F.col("s_p0"), F.col("t_p")) + zero_zero, F.lit(1))
    value = base.unionByName(one).unionByName(two).groupBy("lang", "s_source", "t_source").agg(F.sum("value").cast("long").alias("value"))
    ranked = value.select("lang", F.col("s_source").alias("source"), F.lit("pair").alias("part"), F.col("t_source").alias("item"), "value")
    ranked = ranked.withColumn("rank", F.expr("row_number() over (partition by lang, source order by value desc, item)"))
    return ranked.unionByName(best_terms)
