"""Decomposition of every character against Python's own, and plans in which each pattern stands once."""

import sys
import unicodedata

from pyspark.sql import functions as F

from corpgraph.catalog import QUERIES
from corpgraph.functions import common, companies, people
from corpgraph.functions.common import decomposed


def test_every_character_decomposes_as_in_python(spark):
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    chars = [c for c in chars if unicodedata.normalize("NFKD", c) != c] + chars[:3000]
    rows = [(f"x{''.join(chars[i : i + 7])}y",) for i in range(0, len(chars), 7)]
    for r in spark.createDataFrame(rows, "s string").repartition(4).select("s", decomposed(F.col("s")).alias("d")).collect():
        assert r.d == "".join(unicodedata.normalize("NFKD", c) for c in r.s)


def test_no_letter_is_lost(spark):
    rows = [("Ņikola Ķ", "N IKOLA K"), ("Ｆｕｌｌ Corp", "FULL"), ("ﬁve № 1", "FIVE N 1"), ("Ａ＆Ｂ", "A AND B"), ("Đakovo", "AKOVO")]
    got = spark.createDataFrame([(a,) for a, _ in rows], "s string").select("s", companies.crosswalk_norm(F.col("s")).alias("n")).collect()
    assert [(r.s, r.n) for r in got] == rows
    assert spark.range(1).select(people.person_norm(F.lit(" Zoë  Ｓ ")).alias("x")).first().x == unicodedata.normalize("NFKD", "Zoë Ｓ")


def test_patterns_stand_once_in_the_plans(spark):
    for name, mark, most in (("email_extract", "A-Za-z0-9._%+", 1), ("brand_mentions", "website", 1)):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count(mark) <= most, name


def test_a_character_looks_through_a_short_part_of_the_table():
    parts = common._decompositions()[0].split("\x02")
    assert len(parts) > 1000 and max(map(len, parts)) < 2000
