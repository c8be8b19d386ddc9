"""Readers and writers. Every CSV field is read as text and cast where a plan needs it."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpgraph.schemas import COMMITTEE


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, *, label: str = "input", infer: bool = False) -> DataFrame:
    """A CSV with header; quoted fields may hold line ends, and a field of ``NA`` is text.

    Columns are those of the schema; without one, those of the header, all text, or of
    inferred types. A missing file is an error that names the table.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "").option("inferSchema", infer and schema is None)
    try:
        return (reader if schema is None else reader.schema(schema)).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{label}: no file at {path}") from e


def if_there(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """An earlier run's CSV, or None where there is none."""
    try:
        return read_csv(spark, path, schema)
    except FileNotFoundError:
        return None


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows that a scan meets."""
    return df.limit(n)


def read_committees(spark: SparkSession, path: str) -> DataFrame:
    """The committee master: pipe-separated, no header, Latin-1."""
    return spark.read.schema(COMMITTEE).option("sep", "|").option("header", False).option("encoding", "ISO-8859-1").csv(path)


def committees_of_cycles(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    """Masters of several cycles in one table with ELECTION_CYCLE; of a committee's rows the first listed cycle's stays."""
    from corpgraph.operators.ops import first_per

    parts = [read_committees(spark, p).withColumn("ELECTION_CYCLE", F.lit(y)).withColumn("_order", F.lit(i)) for i, (y, p) in enumerate(paths.items())]
    return first_per(functools.reduce(DataFrame.unionByName, parts), ["CMTE_ID"], ["_order", "CMTE_NM"]).drop("_order")


def read_company_index(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of records, as rows: cik (ten digits), ticker, title."""
    raw = spark.read.text(path, wholetext=True)
    records = F.explode(F.map_values(F.from_json("value", "map<string,struct<cik_str:bigint,ticker:string,title:string>>"))).alias("r")
    return raw.select(records).select(F.lpad(F.col("r.cik_str").cast("string"), 10, "0").alias("cik"), "r.ticker", "r.title")


def latest_filing(submissions: DataFrame, form: str = "10-K") -> DataFrame:
    """cik, accession, document of each company's first filing of a form; null if it has none. ``recent`` is a struct of parallel arrays."""
    zipped = F.arrays_zip("recent.form", "recent.accessionNumber", "recent.primaryDocument")
    found = F.get(F.filter(zipped, lambda x: x["form"] == form), F.lit(0))
    return submissions.withColumn("f", found).select("cik", F.col("f.accessionNumber").alias("accession"), F.col("f.primaryDocument").alias("document"))


def exhibit_21(index: DataFrame) -> DataFrame:
    """cik, accession, exhibit_url from a filing's directory listing; null if it has no such exhibit."""
    name = F.get(F.filter("item", lambda x: F.lower(x["name"]).rlike("ex-?21")), F.lit(0))["name"]
    url = F.concat(F.lit("Archives/edgar/data/"), F.regexp_replace("cik", "^0+", ""), F.lit("/"), F.replace("accession", F.lit("-"), F.lit("")), F.lit("/"), name)
    return index.select("cik", "accession", url.alias("exhibit_url"))


def write_csv(df: DataFrame, path: str, fields: Sequence[str] | None = None, *, mode: str = "overwrite") -> None:
    (df.select(*fields) if fields else df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row table of figures as lines ``name: value``."""
    lines = F.array(*[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in row.columns])
    row.limit(1).select(F.explode(lines).alias("value")).coalesce(1).write.mode("overwrite").text(path)
